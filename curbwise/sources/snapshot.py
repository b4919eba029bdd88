"""Publish time of a snapshot file, as text in the office's local zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbwise.functions.dates import PUBLISH_MINUTES

LOCAL_ZONE = "US/Central"


def published_at(df: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """One row: latest modification time of the files behind ``df``.

    Uses the file-source hidden ``_metadata`` column, so it is answered from
    the scan itself (constant per file) with a global max aggregate. The
    modification time is an instant; it is rendered as wall-clock time in
    ``zone`` with minute precision (``yyyy-MM-ddTHH:mm:00.000``).
    """
    latest = df.select(F.col("_metadata.file_modification_time").alias("_m")).agg(F.max("_m").alias("_m"))
    # instant -> session-zone wall clock -> wall clock in `zone`
    local = F.convert_timezone(None, F.lit(zone), F.col("_m").cast("timestamp_ntz"))
    return latest.select(F.date_format(local, PUBLISH_MINUTES).alias("published_date"))


def file_published_at(spark: SparkSession, path: str, fmt: str = "parquet",
                      zone: str = LOCAL_ZONE) -> DataFrame:
    return published_at(spark.read.format(fmt).load(path), zone)
