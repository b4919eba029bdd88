"""Daily request counts, active-permit snapshot and the weekly summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbwise.functions import dates as D
from curbwise.functions import text as X
from curbwise.operators.weekly import week_spine
from curbwise.plans import reports
from curbwise.sources.snapshot import LOCAL_ZONE
from curbwise.sources.tables import PermitTables

col = F.col

# Folder types summarised, request sheets and measure labels.
PERMIT_TYPES = ["DS", "EX", "RW"]
REQUEST_SHEETS = {  # sheet name -> permit-model table
    "Commercial DS Permit Requests": "request_ds_commercial",
    "Extension and Revision Requests": "request_extension",
    "Residential DS Permits": "request_ds_residential",
}
APPLICATIONS, ISSUED = "Applications Received", "Permits Issued"
COMMERCIAL, EXTENSION, RESIDENTIAL = ("Commercial DS Permit Requests", "Extension Requests",
                                      "Residential DS Permit Requests")
COUNT = "Count Permits"


def _each(values: list[str]):
    """One output row per value (a generator over a fixed list, not a join)."""
    return F.explode(F.array(*[F.lit(v) for v in values])).alias("_type")


# M1 ------------------------------------------------------------------------
def daily_counts(df: DataFrame, date_col: str) -> DataFrame:
    """Number of rows per calendar day of ``date_col``; rows without a date are dropped.

    A text column is parsed in any of the accepted layouts; other text fails the job.
    """
    when = D.as_timestamp(date_col, df.schema[date_col].dataType.simpleString())
    return (df.select(F.to_date(when).alias("date")).filter(col("date").isNotNull())
            .groupBy("date").agg(F.count(F.lit(1)).alias("count_permits")))


def daily_request_counts(t: PermitTables) -> DataFrame:
    """Daily counts of every request sheet, labelled by sheet."""
    frames = [daily_counts(getattr(t, table), "created").withColumn("sheet", F.lit(sheet))
              for sheet, table in REQUEST_SHEETS.items()]
    return reduce(DataFrame.unionByName, frames).select("sheet", "date", "count_permits")


# M2 ------------------------------------------------------------------------
def active_snapshot(active: DataFrame, published_at: str) -> DataFrame:
    """One row: mean active count per folder type, plus the publish time text.

    A missing folder type stays NULL (the fixed pivot list keeps its column).
    """
    wide = active.groupBy().pivot("foldertype", PERMIT_TYPES).agg(F.avg("activepermits"))
    return X.normalize_columns(wide.withColumn("published_date", F.lit(published_at)))


def active_snapshot_from_file(active_file: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """The snapshot of a published active-permit count file, stamped with its file time.

    One global aggregation computes the per-type means and the latest file
    modification time (hidden ``_metadata`` column) together, so the count
    and its publish time come from the same scan and no join is needed.
    """
    ty, n = F.col("foldertype"), F.col("activepermits").cast("double")
    agg = active_file.select(ty.alias("foldertype"), n.alias("activepermits"),
                             F.col("_metadata.file_modification_time").alias("_m")).groupBy().agg(
        *[F.avg(F.when(F.col("foldertype") == x, F.col("activepermits"))).alias(x.lower())
          for x in PERMIT_TYPES],
        F.max("_m").alias("_m"))
    local = F.convert_timezone(None, F.lit(zone), F.col("_m").cast("timestamp_ntz"))
    return agg.select(*[x.lower() for x in PERMIT_TYPES],
                      F.date_format(local, D.PUBLISH_MINUTES).alias("published_date"))


def active_permits_snapshot(t: PermitTables, as_of: str) -> DataFrame:
    published = as_of.replace(" ", "T")[:16] + ":00.000"
    return active_snapshot(reports.active_permits(t), published)


# M3 ------------------------------------------------------------------------
def weekly_type_totals(daily: DataFrame, date_col: str, type_col: str, count_col: str) -> DataFrame:
    """Per Sunday-Saturday week (labelled by its Saturday): sum of counts per type.

    Every week between the first and the last week of the input is present;
    a week without rows, or a type without rows in a week, is 0.
    """
    d = daily.select(D.week_ending_saturday(F.to_date(col(date_col))).alias("week"),
                     col(type_col).alias("_type"), col(count_col).alias("_n"))
    sums = d.groupBy("week", "_type").agg(F.sum("_n").alias("_n"))
    grid = week_spine(sums, "week").select("week", _each(PERMIT_TYPES))
    filled = grid.join(sums, ["week", "_type"], "left").fillna(0, subset=["_n"])
    return (filled.groupBy("week").pivot("_type", PERMIT_TYPES).agg(F.sum("_n"))
            .select("week", *[F.col(x).cast("double").alias(x.lower()) for x in PERMIT_TYPES]))


def _weekly_long(daily: DataFrame, date_col: str, value_col: str, type_col: str | None,
                 measure: str) -> DataFrame:
    """(week, column name, value) rows of one source, gap weeks filled with 0."""
    if type_col is None:
        d = daily.select(D.week_ending_saturday(F.to_date(col(date_col))).alias("week"),
                         F.lit(COUNT).alias("_type"), col(value_col).alias("_n"))
        types = [COUNT]
    else:
        d = daily.filter(col(type_col).isin(PERMIT_TYPES)).select(
            D.week_ending_saturday(F.to_date(col(date_col))).alias("week"),
            col(type_col).alias("_type"), col(value_col).alias("_n"))
        types = PERMIT_TYPES
    sums = d.groupBy("week", "_type").agg(F.sum("_n").alias("_n"))
    grid = week_spine(sums, "week").select("week", _each(types))
    filled = grid.join(sums, ["week", "_type"], "left").fillna(0, subset=["_n"])
    return filled.select("week", F.concat(col("_type"), F.lit(" " + measure)).alias("name"),
                         col("_n").cast("double").alias("value"))


def weekly_type_totals_report(t: PermitTables) -> DataFrame:
    """Weekly totals per folder type of applications received and permits issued."""
    apps, issued = reports.applications_received(t), reports.issued_permits(t)
    a = weekly_type_totals(apps, "received_date", "foldertype",
                           "issuedrowpermits").withColumn("measure", F.lit(APPLICATIONS))
    i = weekly_type_totals(issued, "issued_date", "foldertype",
                           "issuedrowpermits").withColumn("measure", F.lit(ISSUED))
    return a.unionByName(i).select(D.day_text("week").alias("week"), "measure", "ds", "ex", "rw")


# M4 ------------------------------------------------------------------------
SUMMARY_COLUMNS = [f"{ty} {m}" for m in (APPLICATIONS, ISSUED) for ty in PERMIT_TYPES] + \
    [f"{COUNT} {m}" for m in (COMMERCIAL, EXTENSION, RESIDENTIAL)]


def weekly_summary(applications: DataFrame, issued: DataFrame, commercial: DataFrame,
                   extension: DataFrame, residential: DataFrame) -> DataFrame:
    """One row per week: permits received / issued by type plus request counts.

    Each source is filled over its own first..last week; weeks covered by no
    source are absent; a source without rows in a covered week counts 0.
    Commercial and residential DS requests are added to DS applications.
    """
    long = reduce(DataFrame.unionByName, [
        _weekly_long(applications, "received_date", "issuedrowpermits", "foldertype", APPLICATIONS),
        _weekly_long(issued, "issued_date", "issuedrowpermits", "foldertype", ISSUED),
        _weekly_long(commercial, "date", "count_permits", None, COMMERCIAL),
        _weekly_long(extension, "date", "count_permits", None, EXTENSION),
        _weekly_long(residential, "date", "count_permits", None, RESIDENTIAL)])
    wide = long.groupBy("week").pivot("name", SUMMARY_COLUMNS).agg(F.sum("value")).fillna(0.0)
    ds_apps = f"DS {APPLICATIONS}"
    out = (wide
           .withColumn(ds_apps, col(f"`{ds_apps}`") + col(f"`{COUNT} {COMMERCIAL}`")
                       + col(f"`{COUNT} {RESIDENTIAL}`"))
           .drop(f"{COUNT} {COMMERCIAL}", f"{COUNT} {RESIDENTIAL}")
           .withColumnRenamed(f"{COUNT} {EXTENSION}", EXTENSION)
           .withColumn("date", F.concat(D.day_text("week"), F.lit("T00:00:00.000")))
           .drop("week"))
    out = X.normalize_columns(out)
    return out.select("date", *sorted(c for c in out.columns if c != "date"))


def weekly_summary_report(t: PermitTables) -> DataFrame:
    return weekly_summary(
        reports.applications_received(t), reports.issued_permits(t),
        daily_counts(t.request_ds_commercial, "created"), daily_counts(t.request_extension, "created"),
        daily_counts(t.request_ds_residential, "created"))
