"""Inspector priority scoring of active right-of-way permits.

Pipeline: permit list (R8) + permit segments (R9) + published road segments
(segment tagging output) -> six ``*_scoring`` columns -> ``total_score``.

Per-segment facts are aggregated per folder before they meet the permit list:
the count over the permit's own segments, road class, downtown flag and zone
over those found in the road data. A rule that needs no road data (count,
duration, deficiencies, inspections, label) is computed without it, so no
segment is tagged for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbwise.functions import dates as D
from curbwise.functions import text as X
from curbwise.plans import reports
from curbwise.plans.tagging import road_dataset
from curbwise.sources.tables import PermitTables

col = F.col

# Fixed values of the scoring rules.
MANY_SEGMENTS_POINTS, FEW_SEGMENTS_POINTS = 10, 5
DURATION_BANDS = ((6, 10), (15, 5), (30, 3))  # (at most days, points)
LONG_DURATION_POINTS = 1
ROAD_CLASS_POINTS = ((1, 10), (2, 10), (4, 10), (5, 7), (8, 5))
OTHER_ROAD_CLASS_POINTS = 3
DOWNTOWN_POINTS = 10
DEFICIENCY_POINTS = 5
RECENT_INSPECTION_DAYS, RECENT_INSPECTION_POINTS = 7, -5
DATE_FIELDS = ["expiry_date", "start_date", "end_date", "issue_date", "most_recent_inspection",
               "extension_start_date", "extension_end_date", "event_start_date"]
SCORE_COLUMNS = ["count_segment_scoring", "duration_scoring", "road_class_scoring",
                 "dapcz_scoring", "active_deficiencies_scoring", "recent_inspection_scoring"]


def _ts(df: DataFrame, name: str) -> Column:
    return D.as_timestamp(name, df.schema[name].dataType.simpleString())


def parse_dates(df: DataFrame, fields: list[str] = DATE_FIELDS) -> DataFrame:
    """The date columns as TIMESTAMP_NTZ, text parsed once (not at every use)."""
    todo = {f: _ts(df, f) for f in fields if df.schema[f].dataType.simpleString() != "timestamp_ntz"}
    return df.withColumns(todo) if todo else df


# M5 ------------------------------------------------------------------------
def segment_count_points(n: Column) -> Column:
    return F.when(n > 1, MANY_SEGMENTS_POINTS).otherwise(FEW_SEGMENTS_POINTS)


# M6 ------------------------------------------------------------------------
def duration_points(days: Column) -> Column:
    expr = None
    for limit, pts in DURATION_BANDS:
        expr = F.when(days <= limit, pts) if expr is None else expr.when(days <= limit, pts)
    return expr.otherwise(LONG_DURATION_POINTS)


def with_duration(permits: DataFrame, null_extension: str = "fallback") -> DataFrame:
    """Add ``duration`` (days) and ``duration_scoring``; replace ``start_date``.

    RW: total days attribute, from the event start. DS: work-zone duration,
    from issue. EX: extension start..end in whole days (floored); with
    ``null_extension="fallback"`` a missing extension date falls back to the
    permit's start..end, with ``"literal"`` the duration stays NULL (what the
    published job computes when a date is missing).
    """
    if null_extension not in ("fallback", "literal"):
        raise ValueError("null_extension must be 'fallback' or 'literal'")
    permits = parse_dates(permits)
    ext_start, ext_end = _ts(permits, "extension_start_date"), _ts(permits, "extension_end_date")
    start, end = _ts(permits, "start_date"), _ts(permits, "end_date")
    use_ext = F.lit(True) if null_extension == "literal" else (ext_start.isNotNull() & ext_end.isNotNull())
    ftype = col("foldertype")
    duration = (F.when(ftype == "RW", col("total_days").try_cast("double"))
                .when(ftype == "DS", col("wz_duration").cast("double"))
                .when(ftype == "EX", F.when(use_ext, D.floor_days(ext_start, ext_end))
                      .otherwise(D.floor_days(start, end)).cast("double")))
    new_start = (F.when(ftype == "RW", _ts(permits, "event_start_date"))
                 .when(ftype == "DS", _ts(permits, "issue_date"))
                 .when(ftype == "EX", F.when(use_ext, ext_start).otherwise(start))
                 .otherwise(start))
    return (permits.withColumn("duration", duration)
            .withColumn("duration_scoring", duration_points(col("duration")))
            .withColumn("start_date", new_start))


# M8 ------------------------------------------------------------------------
def road_class_points(road_class: Column) -> Column:
    expr = None
    for cls, pts in ROAD_CLASS_POINTS:
        expr = F.when(road_class == cls, pts) if expr is None else expr.when(road_class == cls, pts)
    return expr.otherwise(OTHER_ROAD_CLASS_POINTS)


# M7 ------------------------------------------------------------------------
def attach_road_segments(segments: DataFrame, road: DataFrame) -> DataFrame:
    """Permit segments matched (inner) to the published road-segment data."""
    r = road.select(col("segment_id").cast("long").alias("segment_id"), "full_street_name",
                    col("road_class").cast("int").alias("road_class"),
                    col("inspector_zone").cast("double").alias("row_inspector_zone"), "dapcz_zone")
    return (segments.join(r, segments["propertyrsn"] == r["segment_id"], "inner")
            .withColumn("is_dapcz", col("dapcz_zone").isNotNull()))


def segment_counts(segments: DataFrame) -> DataFrame:
    """Per folder: the number of its segments, whatever the road data holds of them."""
    return segments.groupBy("folderrsn").agg(F.count("propertyrsn").alias("count_segments"))


def segment_facts(segments: DataFrame, road: DataFrame) -> DataFrame:
    """Per folder: segment count, best road class points, downtown points, zone.

    The count is taken before the road join, so road rows that repeat a
    segment do not raise it; the other three are maxima over segments found in
    the road data.
    """
    r = road.select(col("segment_id").cast("long").alias("_sid"),
                    col("road_class").cast("int").alias("_class"),
                    col("inspector_zone").cast("double").alias("_zone"),
                    col("dapcz_zone").alias("_dapcz"))
    found = segments.join(r, segments["propertyrsn"] == r["_sid"], "inner").groupBy("folderrsn").agg(
        F.max(road_class_points(col("_class"))).alias("_road_pts"),
        F.max(F.when(col("_dapcz").isNotNull(), DOWNTOWN_POINTS).otherwise(0)).alias("_dapcz_pts"),
        F.max("_zone").alias("row_inspector_zone"))
    return segment_counts(segments).join(found, "folderrsn", "left")


def with_counts(permits: DataFrame, facts: DataFrame) -> DataFrame:
    """Permit rows with their folder's facts; a folder without segments counts 0."""
    return (permits.join(facts, "folderrsn", "left")
            .withColumn("count_segments", F.coalesce(col("count_segments"), F.lit(0))))


def deficiency_points() -> Column:
    return F.when(col("count_deficiencies") > 0, DEFICIENCY_POINTS).otherwise(0)


def recent_points(as_of: str) -> Column:
    """Points of permits whose ``most_recent_inspection`` (a timestamp) is recent."""
    recent = D.floor_days(col("most_recent_inspection"), D.ts_literal(as_of)) <= RECENT_INSPECTION_DAYS
    return F.when(recent, RECENT_INSPECTION_POINTS).otherwise(0)


def type_label() -> Column:
    return F.when(col("foldertype") == "RW", col("rw_work_description")).otherwise(col("permit_type"))


# M15 -----------------------------------------------------------------------
def normalize_timestamps(df: DataFrame, fields: list[str] = DATE_FIELDS) -> DataFrame:
    """Date columns (timestamps or text in mixed layouts) -> minute-precision text."""
    parsed = parse_dates(df, fields)
    return parsed.withColumns({f: F.date_format(F.col(f), D.PUBLISH_MINUTES) for f in fields})


# M14 -----------------------------------------------------------------------
def score_permits(permits: DataFrame, segments: DataFrame, road: DataFrame, as_of: str,
                  null_extension: str = "fallback") -> DataFrame:
    """All scoring columns and ``total_score`` for every permit-list row."""
    p = with_duration(with_counts(parse_dates(permits), segment_facts(segments, road)), null_extension)
    p = p.withColumns({
        "count_segment_scoring": segment_count_points(col("count_segments")),
        "road_class_scoring": F.coalesce(col("_road_pts"), F.lit(0)),
        "dapcz_scoring": F.coalesce(col("_dapcz_pts"), F.lit(0)),
        "active_deficiencies_scoring": deficiency_points(),
        "recent_inspection_scoring": recent_points(as_of),
        "permit_type": type_label(),
    }).drop("_road_pts", "_dapcz_pts")
    p = p.withColumn("total_score", X.sum_columns(SCORE_COLUMNS))
    return X.nan_to_null(normalize_timestamps(p))


def inspector_priority(t: PermitTables, as_of: str, null_extension: str = "fallback",
                       road: DataFrame | None = None) -> DataFrame:
    """Flagship: scored permit list, ready to publish (replace).

    ``road`` is the published road-segment dataset (``sinks.read_latest`` of
    the tagging output); without it the segments are tagged in this job.
    """
    segments = reports.row_inspector_segment_list(t)
    road = road if road is not None else road_dataset(t, as_of, segments)
    return score_permits(reports.row_inspector_permit_list(t), segments, road, as_of, null_extension)


# Single-rule views (one registered query each) --------------------------------
def segment_count_score(t, as_of):
    p = with_counts(reports.row_inspector_permit_list(t), segment_counts(reports.row_inspector_segment_list(t)))
    return p.select("folderrsn", "foldertype", "count_segments",
                    segment_count_points(col("count_segments")).alias("count_segment_scoring"))


def _durations(t, null_extension: str) -> DataFrame:
    p = with_duration(reports.row_inspector_permit_list(t), null_extension)
    return normalize_timestamps(p, ["start_date"]).select("folderrsn", "foldertype", "duration", "duration_scoring", "start_date")


def duration_score(t, as_of):
    return _durations(t, "fallback")


def duration_score_literal(t, as_of):
    return _durations(t, "literal")


def road_segment_attach(t, as_of):
    segments = reports.row_inspector_segment_list(t)
    return attach_road_segments(segments, road_dataset(t, as_of, segments))


def _facts(t, as_of, inspector: bool = False, dapcz: bool = False) -> DataFrame:
    """Permit rows with their folder's facts; zones are tagged only for the layers asked for."""
    segments = reports.row_inspector_segment_list(t)
    road = road_dataset(t, as_of, segments, inspector, dapcz)
    return with_counts(reports.row_inspector_permit_list(t), segment_facts(segments, road))


def road_class_score(t, as_of):
    return _facts(t, as_of).select("folderrsn", F.coalesce(col("_road_pts"), F.lit(0)).alias("road_class_scoring"))


def dapcz_score(t, as_of):
    return _facts(t, as_of, dapcz=True).select("folderrsn", F.coalesce(col("_dapcz_pts"), F.lit(0)).alias("dapcz_scoring"))


def permit_inspector_zone(t, as_of):
    return _facts(t, as_of, inspector=True).select("folderrsn", "row_inspector_zone")


def deficiency_score(t, as_of):
    return reports.row_inspector_permit_list(t).select(
        "folderrsn", "count_deficiencies", deficiency_points().alias("active_deficiencies_scoring"))


def recent_inspection_score(t, as_of):
    p = parse_dates(reports.row_inspector_permit_list(t), ["most_recent_inspection"])
    p = p.withColumn("recent_inspection_scoring", recent_points(as_of))
    return normalize_timestamps(p, ["most_recent_inspection"]).select(
        "folderrsn", "most_recent_inspection", "recent_inspection_scoring")


def permit_type_label(t, as_of):
    return reports.row_inspector_permit_list(t).select("folderrsn", "foldertype", type_label().alias("permit_type"))


def timestamp_text_normalize(t, as_of):
    return normalize_timestamps(reports.row_inspector_permit_list(t)).select("folderrsn", *DATE_FIELDS)
