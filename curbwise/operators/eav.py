"""Entity-attribute-value lookups over tables such as ``folderinfo``.

Two shapes occur in the reports:

* scalar lookup (``(SELECT value FROM info WHERE key = f.key AND code = c)``):
  at most one row per entity and code; a second row is an error in the source
  database, and is an error here too.
* inner attribute join (``JOIN info i ON i.key = f.key AND i.code = c``):
  an entity missing the code is dropped and a repeated code fans out.

Both read the wanted codes in one scan. The attribute tables are stored
partitioned by their code column (see ``sources.jdbc.PARTITION_COLUMNS``), so a
code filter is partition pruning: a lookup of k codes reads k partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar_attributes(info: DataFrame, key: str, code_col: str, value_col: str,
                      codes: dict[str, int]) -> DataFrame:
    """One row per entity with one column per code, plus ``_n_<name>`` counts.

    A grouped aggregation with map-side partial aggregation, so an entity with
    very many attribute rows does not concentrate raw rows in one task. Apply
    ``checked_scalar`` to the value columns where they are finally used.
    """
    wanted = info.filter(F.col(code_col).isin(list(codes.values())))
    aggs = []
    for name, code in codes.items():
        hit = F.col(code_col) == F.lit(code)
        aggs.append(F.max(F.when(hit, F.col(value_col))).alias(name))
        aggs.append(F.count(F.when(hit, F.lit(1))).alias(f"_n_{name}"))
    return wanted.groupBy(key).agg(*aggs)


def checked_scalar(name: str, what: str = "attribute") -> Column:
    """The looked-up value, raising like a scalar subquery when >1 row matched."""
    return (F.when(F.col(f"_n_{name}") > 1,
                   F.raise_error(F.lit(f"more than one {what} row for {name}")))
            .otherwise(F.col(name)).alias(name))


def attribute_join(entities: DataFrame, info: DataFrame, key: str, code_col: str,
                   value_col: str, codes: dict[str, int]) -> DataFrame:
    """Inner-join one attribute column per code (missing drops, repeats fan out).

    One scan of ``info`` and one join: equal rows of an entity are counted first (with
    partial aggregation, spread by value), then an entity's distinct values are one
    array per code, and the arrays are multiplied out row by row, counts included. What
    one row holds are the distinct values that an entity has of the codes, all of which
    are in its result rows anyway.
    """
    wanted = info.filter(F.col(code_col).isin(list(codes.values())))
    counted = wanted.groupBy(key, code_col, value_col).agg(F.count(F.lit(1)).alias("_n"))
    own = {name: F.struct(F.col(value_col).alias("v"), F.col("_n").alias("n")) for name in codes}
    rows = counted.groupBy(key).agg(*[
        F.collect_list(F.when(F.col(code_col) == F.lit(code), own[name])).alias(f"_{name}") for name, code in codes.items()])
    rows = rows.filter(reduce(lambda a, b: a & b, [F.size(f"_{name}") > 0 for name in codes])).withColumn("_times", F.lit(1).cast("long"))
    for name in codes:
        rows = rows.withColumn(f"_{name}", F.explode(f"_{name}")).withColumn("_times", F.col("_times") * F.col(f"_{name}.n"))
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))
    rows = rows.select(key, *[F.col(f"_{name}.v").alias(name) for name in codes], times.alias("_time")).drop("_time")
    return entities.join(rows, key, "inner")
