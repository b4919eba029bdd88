"""First-of-group and per-group numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Ranges of the leading order key that a group is numbered in.
RANGES = 1024


def first_of_group(df: DataFrame, keys: list[str], order_by: list[str], values: list[str]) -> DataFrame:
    """The row with the smallest ``order_by`` (ascending, NULLs last) per key.

    Equivalent to ``row_number() OVER (PARTITION BY keys ORDER BY order_by) = 1``
    but computed as ``min(struct(...))``: an aggregate with map-side partial
    aggregation, so a key holding a large share of the rows still leaves each
    map task one candidate per key instead of shipping every row to one task.
    List a unique column last in ``order_by`` to make ties deterministic.
    """
    fields = []
    for i, c in enumerate(order_by):
        fields.append(F.col(c).isNull().alias(f"_null{i}"))
        fields.append(F.col(c).alias(f"_ord{i}"))
    fields += [F.col(v).alias(f"_val_{v}") for v in values]
    best = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_first"))
    return best.select(*keys, *[F.col("_first")[f"_val_{v}"].alias(v) for v in values])


def _order(order_by: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order_by]


def cycle_number(df: DataFrame, partition_by: list[str], order_by: list[str], keys: DataFrame,
                 name: str = "cyclenumber", ranges: int = RANGES) -> DataFrame:
    """1, 2, 3 ... within each group in ``order_by`` order (NULLs last).

    ``order_by[0]`` is a numeric key, and ``keys`` a table that has all of its
    values. Its span there (a lazy one-row subquery) is cut into ``ranges``
    equal ranges; rows are numbered per (group, range) and shifted by the
    exact row count of the group's lower ranges, a running sum over at most
    ``ranges`` rows per group. So every group takes the same path, and one with
    a large share of all rows is spread over as many tasks as its keys span
    ranges. The numbering is exact whatever the ranges. The columns of
    ``partition_by`` are join keys and must not be NULL.
    """
    lead = order_by[0]
    span = keys.agg(F.struct(F.min(lead).cast("double").alias("lo"), F.max(lead).cast("double").alias("hi"))).scalar()
    # the upper bound is exclusive; keys beyond double precision at the top share the range after the last
    k = F.width_bucket(F.col(lead).cast("double"), span["lo"], span["hi"] + F.lit(1.0), F.lit(ranges))
    x = df.withColumn("_k", F.coalesce(k, F.lit(0)))
    below = Window.partitionBy(*partition_by).orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    counts = x.groupBy(*partition_by, "_k").agg(F.count(F.lit(1)).alias("_c"))
    offsets = counts.select(*partition_by, "_k", F.coalesce(F.sum("_c").over(below), F.lit(0)).alias("_off"))
    local = Window.partitionBy(*partition_by, "_k").orderBy(*_order(order_by))
    return (x.withColumn("_rn", F.row_number().over(local))
            .join(offsets, [*partition_by, "_k"], "inner")
            .withColumn(name, (F.col("_rn") + F.col("_off")).cast("int"))
            .select(*df.columns, name))
