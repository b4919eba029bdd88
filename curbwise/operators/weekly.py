"""Calendar spine for time-bucketed roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def week_spine(df: DataFrame, week_col: str) -> DataFrame:
    """Every 7-day label from the smallest to the largest ``week_col`` of ``df``.

    A global min/max aggregate (one row) expanded with ``sequence``: its
    size is the number of weeks covered. Callers pass the weekly sums, whose
    exchange Spark uses for both branches.
    """
    bounds = df.agg(F.min(week_col).alias("_lo"), F.max(week_col).alias("_hi"))
    return (bounds.filter(F.col("_lo").isNotNull())
            .select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 7 DAYS"))).alias(week_col)))
