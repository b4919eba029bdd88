"""The weekly summary kept up to date: stored weekly partials, only dirty weeks computed again.

The state is a keyed dataset (``sinks.upsert``, hash buckets) with one row per
source, week and folder type: the sum of the counts and the number of rows behind
it. A run names the days whose source rows were added, changed or removed. Their
weeks are summed again from the source rows of those weeks and replace the stored
ones; a type that no longer has rows in such a week is stored with zero rows. So a
run may be repeated, late rows of any age are right, and the rest of the sources
is not read where their files are laid out by day.

The summary itself reads the state only. Gap weeks follow from the weeks that have
rows, so they move with the first and the last of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbwise.functions import dates as D
from curbwise.plans import reports, weekly
from curbwise.sources import sinks
from curbwise.sources.tables import PermitTables

KEY = ["source", "week", "type"]
#: Source -> (date column, count column, type column or None), as ``weekly_summary`` takes them.
SOURCES = {
    "applications": ("received_date", "issuedrowpermits", "foldertype"),
    "issued": ("issued_date", "issuedrowpermits", "foldertype"),
    "commercial": ("date", "count_permits", None),
    "extension": ("date", "count_permits", None),
    "residential": ("date", "count_permits", None),
}
_SCHEMA = "source string, week date, type string, n long, n_rows long"


def source_frames(t: PermitTables) -> dict[str, DataFrame]:
    """The five sources of the weekly summary from the permit tables."""
    return {
        "applications": reports.applications_received(t), "issued": reports.issued_permits(t),
        "commercial": weekly.daily_counts(t.request_ds_commercial, "created"),
        "extension": weekly.daily_counts(t.request_extension, "created"),
        "residential": weekly.daily_counts(t.request_ds_residential, "created"),
    }


def partials(frames: dict[str, DataFrame], weeks: DataFrame | None = None) -> DataFrame:
    """One row per source, week and type; of ``weeks`` (column ``week``) only, if given."""
    parts = []
    for source, df in frames.items():
        date_col, count_col, type_col = SOURCES[source]
        kind = F.col(type_col) if type_col else F.lit(weekly.COUNT)
        rows = df.select(F.lit(source).alias("source"), D.week_ending_saturday(F.to_date(F.col(date_col))).alias("week"),
                         kind.alias("type"), F.col(count_col).cast("long").alias("n")).filter("week is not null")
        parts.append(rows if weeks is None else rows.join(weeks, "week", "left_semi").select(*rows.columns))
    return reduce(DataFrame.unionByName, parts).groupBy(*KEY).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_rows"))


def update(spark: SparkSession, root: str, frames: dict[str, DataFrame], dirty_days: DataFrame | None = None) -> int:
    """Brings the state at ``root`` up to date and returns its version.

    ``dirty_days`` has a column ``date``. Without it, or without a state, all weeks are computed.
    """
    state = sinks.read_latest(spark, root)
    if state is None or dirty_days is None:
        new = partials(frames)
        if state is not None:
            new = _with_emptied(new, state)
        return sinks.upsert(spark, new, root, KEY)
    weeks = dirty_days.select(D.week_ending_saturday(F.to_date("date")).alias("week")).filter("week is not null").distinct()
    stored = state.join(weeks, "week", "left_semi").select(*state.columns)
    return sinks.upsert(spark, _with_emptied(partials(frames, weeks), stored), root, KEY)


def _with_emptied(new: DataFrame, stored: DataFrame) -> DataFrame:
    """``new``, and zero rows for stored keys that it lacks."""
    gone = stored.join(new.select(*KEY), KEY, "left_anti")
    return new.unionByName(gone.select(*KEY, F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("n_rows")))


def summary(spark: SparkSession, root: str) -> DataFrame:
    """The weekly summary from the state alone."""
    state = sinks.read_latest(spark, root)
    if state is None:
        state = spark.createDataFrame([], _SCHEMA)
    state = state.filter("n_rows > 0")

    def source(name: str) -> DataFrame:
        date_col, count_col, type_col = SOURCES[name]
        rows = state.filter(F.col("source") == name)
        return rows.select(F.col("week").alias(date_col), *([F.col("type").alias(type_col)] if type_col else []), F.col("n").alias(count_col))

    return weekly.weekly_summary(*[source(s) for s in SOURCES])
