"""Street-segment tagging with inspector and downtown coordination zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbwise.functions import dates as D
from curbwise.operators.spatial import tag_zones
from curbwise.sources.sinks import latest_by_key
from curbwise.sources.tables import PermitTables

# Look-back of the incremental run and the start of a full run.
LOOKBACK_DAYS = 30
# Age of the previously published full run in the ``keyed_upsert`` query.
PREVIOUS_RUN_DAYS = 15
FULL_SINCE = "1970-01-01 00:00:00"
SEGMENT_COLUMNS = ["segment_id", "full_street_name", "road_class", "modified_date"]
TAG_COLUMNS = ["segment_id", "full_street_name", "road_class", "inspector_zone", "dapcz_zone"]


def recent_segments(segments: DataFrame, as_of: str, days: int = LOOKBACK_DAYS,
                    full: bool = False) -> DataFrame:
    """Segments modified within ``days`` before ``as_of`` (all since 1970 when ``full``)."""
    since = D.ts_literal(FULL_SINCE) if full else \
        D.ts_literal(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    return segments.filter(F.col("modified_date") >= since)


def segments_recent(t: PermitTables, as_of: str, full: bool = False) -> DataFrame:
    return recent_segments(t.segment, as_of, full=full).select(*SEGMENT_COLUMNS)


def latest_versions(segs: DataFrame) -> DataFrame:
    """One row per segment_id: the version modified last (ties: the largest row)."""
    rest = [c for c in segs.columns if c not in ("segment_id", "modified_date")]
    best = segs.groupBy("segment_id").agg(F.max(F.struct("modified_date", *rest)).alias("_v"))
    return best.select("segment_id", *[F.col(f"_v.{c}").alias(c) for c in segs.columns if c != "segment_id"])


def _tag(segs: DataFrame, t: PermitTables, inspector: bool, dapcz: bool,
         cell_size: float | None = None) -> DataFrame:
    layers = []
    if inspector:
        layers.append(("inspector_zone", t.inspector_zone, "zone_id"))
    if dapcz:
        layers.append(("dapcz_zone", t.dapcz_zone, "zone_id"))
    return tag_zones(segs.select("segment_id", "path"), "segment_id", "path", layers, cell_size)


def segment_inspector_zone(t: PermitTables, cell_size: float | None = None) -> DataFrame:
    """Every segment with the inspector zone it intersects (lowest object id)."""
    return _tag(t.segment, t, True, False, cell_size).select("segment_id", "inspector_zone")


def segment_dapcz_zone(t: PermitTables, cell_size: float | None = None) -> DataFrame:
    """Every segment with the downtown coordination zone it intersects."""
    return _tag(t.segment, t, False, True, cell_size).select("segment_id", "dapcz_zone")


def segment_zone_tags(t: PermitTables, as_of: str, full: bool = False,
                      cell_size: float | None = None) -> DataFrame:
    """Recently modified segments (or all, ``full``) with both zone tags.

    Output is the published road-segment dataset keyed by ``segment_id``.
    """
    return tag_segments(t, recent_segments(t.segment, as_of, full=full), cell_size)


def tag_segments(t: PermitTables, segs: DataFrame, cell_size: float | None = None,
                 inspector: bool = True, dapcz: bool = True) -> DataFrame:
    """Segments (with ``path``) -> published columns with the zone tags asked for, one row per segment."""
    return _tagged_versions(t, latest_versions(segs), "segment_id", cell_size, inspector, dapcz).select(*TAG_COLUMNS)


def _tagged_versions(t: PermitTables, segs: DataFrame, key: str, cell_size: float | None,
                     inspector: bool = True, dapcz: bool = True) -> DataFrame:
    """Segments, one per ``key``, with both tag columns; a layer not asked for is NULL and not joined."""
    layers = [(c, zones(), "zone_id") for wanted, c, zones in (
        (inspector, "inspector_zone", lambda: t.inspector_zone), (dapcz, "dapcz_zone", lambda: t.dapcz_zone)) if wanted]
    out = segs.drop("path")
    if layers:
        out = out.join(tag_zones(segs.select(key, "path"), key, "path", layers, cell_size), key, "left")
    for c, kind in (("inspector_zone", "double"), ("dapcz_zone", "string")):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(kind))
    return out


def road_dataset(t: PermitTables, as_of: str, wanted: DataFrame | None = None,
                 inspector: bool = True, dapcz: bool = True) -> DataFrame:
    """Segments tagged with their zones: the published dataset, where the tables hold it
    (``t.with_table("road_segment", published)``), else tagged in this job.

    There only the segments of ``wanted`` (by ``propertyrsn``) and the layers asked for
    are tagged, since that is all the caller reads.
    """
    if t.has("road_segment"):
        return t.road_segment
    segs = recent_segments(t.segment, as_of, full=True)
    if wanted is not None:
        segs = segs.join(wanted.select(F.col("propertyrsn").alias("segment_id")), "segment_id", "left_semi")
    return tag_segments(t, segs, None, inspector, dapcz)


# Rows that the ``keyed_upsert`` query adds to the run, one without
# a key (before and after, made from the first segment) and an older version of
# every tenth segment.
_NO_KEY = ("no key, before", "no key, after")
_OLDER = "older version"


def keyed_upsert(t: PermitTables, as_of: str, cell_size: float | None = None) -> DataFrame:
    """The published segment dataset after this run's incremental upsert.

    Previous version: every segment modified before ``PREVIOUS_RUN_DAYS`` ago,
    tagged. This run tags the segments modified in the look-back window and
    upserts them by ``segment_id``, the latest version of a key first: keys
    present in both are replaced, new keys are added, all other rows are kept.
    Both runs are tagged in one spatial join that the plan holds once.
    """
    cutoff = D.ts_literal(as_of) - F.expr(f"INTERVAL {PREVIOUS_RUN_DAYS} DAYS")

    def no_key(run: int, text: str) -> DataFrame:
        return t.segment.filter(F.col("segment_id") < 2).select(
            F.lit(run).alias("run"), F.lit(1).alias("version"),
            F.when(F.col("segment_id") > 1, F.col("segment_id")).alias("segment_id"), F.lit(text).alias("full_street_name"),
            F.lit(0).alias("road_class"), F.lit(None).cast("double").alias("inspector_zone"), F.lit(None).cast("string").alias("dapcz_zone"))

    # both runs' segments are tagged in one spatial join: the run is a part of the key there
    runs = [latest_versions(rows).withColumn("run", F.lit(run)) for run, rows in
            enumerate((t.segment.filter(F.col("modified_date") < cutoff), recent_segments(t.segment, as_of)))]
    both = runs[0].unionByName(runs[1]).withColumn("_version", F.concat("run", F.lit("/"), "segment_id"))
    tagged = _tagged_versions(t, both, "_version", cell_size).select("run", *TAG_COLUMNS)
    older = (F.col("run") == 1) & (F.col("segment_id") % 10 == 0)
    versions = F.explode(F.when(older, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1))))
    rows = tagged.select("run", versions.alias("version"), *TAG_COLUMNS)
    rows = rows.withColumn("full_street_name", F.when(F.col("version") == 0, _OLDER).otherwise(F.col("full_street_name")))
    rows = rows.unionByName(no_key(0, _NO_KEY[0])).unionByName(no_key(1, _NO_KEY[1]))
    # an upsert keeps one row per key, the update's where there is one: the last by run, then version
    return latest_by_key(rows, ["segment_id"], ["run", "version"]).select(*TAG_COLUMNS)
