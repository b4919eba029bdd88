"""Laid-out data: joins of bucketed tables without a shuffle, pruned read-back, balanced JDBC ranges."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from curbwise.plans import reports
from curbwise.sources import jdbc, sinks
from curbwise.sources.tables import PermitTables

SF = "/root/testdata/sf0.001"
TABLES = ["folder", "folderprocess", "folderinfo", "folderpeople", "people", "folderproperty", "property", "folderprocessattempt",
          "folderprocessdeficiency", "validsub", "validstatus", "validwork"]


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    spark.sql(f"CREATE DATABASE permits LOCATION '{tmp_path_factory.mktemp('db')}'")
    jdbc.extract_to_tables(PermitTables.from_fixture(spark, SF), "permits", 4, TABLES)
    yield PermitTables.from_tables(spark, "permits")
    spark.sql("DROP DATABASE permits CASCADE")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_folder_joins_of_bucketed_tables_need_no_exchange(spark, bucketed):
    t = bucketed
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = t.folder.filter("foldertype = 'RW'").select("folderrsn", "foldername")
        joined = (f.join(t.folderprocess.select("folderrsn", "processrsn"), "folderrsn").join(
            t.folderproperty.select("folderrsn", "propertyrsn"), "folderrsn").join(t.folderpeople.select("folderrsn"), "folderrsn", "left_semi"))
        plan = _plan(joined)
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3
        grouped = _plan(t.folderinfo.filter("infocode = 75390").groupBy("folderrsn").agg(F.max("infovalue")))
        assert "Exchange" not in grouped
        links = _plan(reports.row_inspector_segment_list(t))
        plain = _plan(reports.row_inspector_segment_list(PermitTables.from_fixture(spark, SF)))
        assert links.count("hashpartitioning(folderrsn") == 0 < plain.count("hashpartitioning(")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("report", ["license_agreements_timeline", "row_inspector_permit_list", "row_inspector_segment_list"])
def test_bucketed_tables_give_the_same_rows(spark, bucketed, report):
    rows = lambda t: sorted(map(str, getattr(reports, report)(t).collect()))
    assert rows(bucketed) == rows(PermitTables.from_fixture(spark, SF))


def test_readers_of_a_few_keys_open_a_few_files(spark, tmp_path):
    root, keys = str(tmp_path / "d"), list(range(4000))
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(k, f"street {k}") for k in keys], "segment_id long, name string").repartition(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keeps the number of files
    try:
        sinks.replace(spark, df, root, ["segment_id"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    got = sinks.read_latest(spark, root)
    ranges = []
    for f in got.inputFiles():
        meta = pq.read_metadata(f.removeprefix("file://"))
        stats = [meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups)]
        ranges.append((min(s.min for s in stats), max(s.max for s in stats)))
    ranges.sort()
    assert len(ranges) >= 4 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))  # each file a range of its own
    assert sum(lo <= 1234 <= hi for lo, hi in ranges) == 1
    few = got.filter("segment_id in (1234, 1240)")
    assert few.count() == 2 and "In(segment_id, [1234,1240])" in _plan(few)


def test_balanced_ranges_of_skewed_keys():
    rng = random.Random(2)
    keys = [rng.randrange(1000) for _ in range(9000)] + [rng.randrange(10**7) for _ in range(900)] + [555] * 3000
    low, high = min(keys), max(keys)
    for bins, parts in ((10**6, 16), (4096, 8), (10**6, 1)):
        width = max(1, -(-(high - low + 1) // bins))
        counts = {}
        for k in keys:
            counts[(k - low) // width] = counts.get((k - low) // width, 0) + 1
        bounds = jdbc.balanced_bounds(counts, low, width, parts)
        conditions = jdbc.range_predicates("k", bounds)
        held = [sum(1 for k in [*keys, None] if _holds(c, k)) for c in conditions]
        assert sum(held) == len(keys) + 1  # every row once
        assert len(conditions) <= 2 * parts + 1
        heaviest = max(counts.values())
        assert max(held) <= heaviest + 1.5 * len(keys) / parts + 1
    equal_widths = max(sum(1 for k in keys if (k - low) * 16 // (high - low + 1) == i) for i in range(16))
    assert equal_widths > 11_000  # what equal widths give


def _holds(condition, k):
    if k is None:
        return "IS NULL" in condition or condition == "1 = 1"
    return eval(condition.replace(" OR k IS NULL", "").replace("AND", "and").replace("1 = 1", "True"), {"k": k})


def test_histogram_query_and_rows_without_a_key():
    query = jdbc.histogram_query("s.folder", "folderrsn", 100, 100 + 4096 * 10 - 1)
    assert "FLOOR((folderrsn - 100) / 10)" in query and query.startswith("(SELECT") and "GROUP BY" in query
    assert jdbc.balanced_bounds({0: 5}, 1, 10, 4) == [] and jdbc.range_predicates("k", []) == ["1 = 1"]
