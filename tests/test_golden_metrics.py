"""Golden cases of the weekly roll-up and the scoring rules (FIXTURES.md section 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from curbwise.functions import dates as D
from curbwise.plans import scoring, weekly

AS_OF = "2022-06-01 00:00:00"


def test_daily_count(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 8),), (dt.datetime(2024, 1, 1, 20),), (None,)],
                               "created timestamp_ntz")
    rows = weekly.daily_counts(df, "created").collect()
    assert [(r.date, r.count_permits) for r in rows] == [(dt.date(2024, 1, 1), 2)]


def test_week_label(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 6),), (dt.date(2024, 1, 7),)], "d date")
    got = [r.w for r in df.select(D.week_ending_saturday("d").alias("w")).collect()]
    assert got == [dt.date(2024, 1, 6), dt.date(2024, 1, 13)]


def test_gap_weeks(spark):
    apps = spark.createDataFrame([("DS", "2024-01-06", 2), ("DS", "2024-01-28", 3)],
                                 "foldertype string, received_date string, issuedrowpermits long")
    issued = spark.createDataFrame([("EX", "2024-02-24", 1)],
                                   "foldertype string, issued_date string, issuedrowpermits long")
    empty = spark.createDataFrame([], "date date, count_permits long")
    out = weekly.weekly_summary(apps, issued, empty, empty, empty)
    rows = {r.date[:10]: r for r in out.collect()}
    assert sorted(rows) == ["2024-01-06", "2024-01-13", "2024-01-20", "2024-01-27", "2024-02-03", "2024-02-24"]
    assert [rows[d].ds_applications_received for d in sorted(rows)] == [2.0, 0.0, 0.0, 0.0, 3.0, 0.0]
    assert rows["2024-02-24"].ex_permits_issued == 1.0
    assert rows["2024-01-06"].date == "2024-01-06T00:00:00.000"


def test_ds_requests_added_to_applications(spark):
    apps = spark.createDataFrame([("DS", "2024-01-06", 2)],
                                 "foldertype string, received_date string, issuedrowpermits long")
    issued = spark.createDataFrame([], "foldertype string, issued_date string, issuedrowpermits long")
    req = spark.createDataFrame([(dt.date(2024, 1, 5), 4)], "date date, count_permits long")
    ext = spark.createDataFrame([(dt.date(2024, 1, 5), 7)], "date date, count_permits long")
    (row,) = weekly.weekly_summary(apps, issued, req, ext, req).collect()
    assert row.ds_applications_received == 10.0
    assert row.extension_requests == 7.0
    assert "count_permits_commercial_ds_permit_requests" not in row.asDict()


def _points(spark, fn, values, typ="double"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r.p for r in df.select(fn(F.col("v")).alias("p")).collect()]


def test_segment_count_points(spark):
    assert _points(spark, scoring.segment_count_points, [0, 1, 2], "long") == [5, 5, 10]


def test_duration_points(spark):
    got = _points(spark, scoring.duration_points, [6.0, 7.0, 15.0, 16.0, 30.0, 31.0, None, -2.0])
    assert got == [10, 5, 5, 3, 3, 1, 1, 10]


def test_floor_days(spark):
    df = spark.createDataFrame([(dt.datetime(2022, 1, 2, 6), dt.datetime(2022, 1, 1))],
                               "s timestamp_ntz, e timestamp_ntz")
    assert df.select(D.floor_days("s", "e").alias("d")).first().d == -2


def test_road_class_points(spark):
    got = _points(spark, scoring.road_class_points, [1, 2, 4, 5, 8, 3, None], "int")
    assert got == [10, 10, 10, 7, 5, 3, 3]


def _permits(spark, rows):
    schema = ("permit_type string, foldertype string, permit string, folderrsn long, folder_name string,"
              " property_name string, expiry_date timestamp_ntz, issue_date timestamp_ntz, contractor string,"
              " phone string, rw_work_description string, wz_duration int, total_days string,"
              " event_start_date string, start_date string, extension_start_date string,"
              " extension_end_date string, end_date string, count_deficiencies long,"
              " most_recent_inspection timestamp_ntz")
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def _segments(spark, rows):
    return spark.createDataFrame(rows, "folderrsn long, propertyrsn long, is_primary string")


def _road(spark, rows):
    return spark.createDataFrame(
        rows, "segment_id long, full_street_name string, road_class int, inspector_zone double, dapcz_zone string")


def test_recent_inspection_points(spark):
    asof = dt.datetime(2022, 6, 1)
    cases = {1: asof - dt.timedelta(days=7.9), 2: asof - dt.timedelta(days=8), 3: asof + dt.timedelta(days=1),
             4: None}
    permits = _permits(spark, [{"folderrsn": k, "foldertype": "DS", "wz_duration": 3,
                                "count_deficiencies": 0, "most_recent_inspection": v} for k, v in cases.items()])
    out = scoring.score_permits(permits, _segments(spark, []), _road(spark, []), AS_OF)
    got = {r.folderrsn: r.recent_inspection_scoring for r in out.collect()}
    assert got == {1: -5, 2: 0, 3: -5, 4: 0}


def test_total_best_and_worst(spark):
    best = {"folderrsn": 1, "foldertype": "DS", "wz_duration": 2, "count_deficiencies": 3}
    worst = {"folderrsn": 2, "foldertype": "RW", "total_days": "n/a", "count_deficiencies": 0,
             "most_recent_inspection": dt.datetime(2022, 5, 31)}
    segs = _segments(spark, [(1, 10, "TRUE"), (1, 11, "FALSE")])
    road = _road(spark, [(10, "A", 1, 3.0, "D1"), (11, "B", 9, 4.0, None)])
    out = {r.folderrsn: r for r in scoring.score_permits(_permits(spark, [best, worst]), segs, road, AS_OF).collect()}
    assert out[1].total_score == 45 and out[1].row_inspector_zone == 4.0
    assert out[2].total_score == 1
    assert out[2].duration is None and out[2].road_class_scoring == 0


def test_ex_duration_fallback_and_literal(spark):
    ex = {"folderrsn": 1, "foldertype": "EX", "start_date": "2022-01-01", "end_date": "2022-01-10",
          "extension_start_date": None, "extension_end_date": "2022-03-01", "count_deficiencies": 0}
    p = _permits(spark, [ex])
    fb = scoring.with_duration(p, "fallback").first()
    lit = scoring.with_duration(p, "literal").first()
    assert (fb.duration, fb.duration_scoring) == (9.0, 5)
    assert fb.start_date == dt.datetime(2022, 1, 1)
    assert (lit.duration, lit.duration_scoring, lit.start_date) == (None, 1, None)


def test_timestamp_text(spark):
    p = _permits(spark, [{"folderrsn": 1, "foldertype": "DS", "issue_date": dt.datetime(2022, 5, 1, 10, 20, 33),
                          "event_start_date": "2022-05-01 10:20:33"}])
    r = scoring.normalize_timestamps(p).first()
    assert r.issue_date == "2022-05-01T10:20:00.000"
    assert r.event_start_date == "2022-05-01T10:20:00.000"
    assert r.end_date is None


def test_active_snapshot(spark):
    df = spark.createDataFrame([("DS", 3), ("RW", 5)], "foldertype string, activepermits long")
    r = weekly.active_snapshot(df, "2022-06-01T00:00:00.000").first()
    assert (r.ds, r.ex, r.rw, r.published_date) == (3.0, None, 5.0, "2022-06-01T00:00:00.000")


@pytest.mark.parametrize("mode", ["bad"])
def test_duration_mode_checked(spark, mode):
    with pytest.raises(ValueError):
        scoring.with_duration(_permits(spark, []), mode)
