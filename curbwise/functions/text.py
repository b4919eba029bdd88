"""Text and null-handling Column helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def oracle_concat(*parts) -> Column:
    """Oracle ``a || b``: NULL parts count as empty text; an empty result is NULL.

    Spark's ``concat`` returns NULL if any part is NULL and ``concat_ws`` drops
    NULL parts together with their separator, so neither fits.
    """
    joined = F.concat(*[F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts])
    return F.nullif(joined, F.lit(""))


def joined_with_blanks(*parts) -> Column:
    """``p1 || ' ' || p2 || ' ' || ...`` with Oracle NULL-as-empty rules."""
    pieces = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(" "))
        pieces.append(_c(p))
    return oracle_concat(*pieces)


def not_like_prefix(c, prefix: str) -> Column:
    """``c NOT LIKE 'prefix%'`` (NULL stays NULL, so the row is filtered)."""
    return ~_c(c).startswith(prefix)


def empty_as_null(df: DataFrame) -> DataFrame:
    """Oracle stores '' as NULL: apply the same rule to text read from files."""
    cols = [F.nullif(F.col(f.name), F.lit("")).alias(f.name)
            if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns -> NULL (the published datasets reject NaN)."""
    cols = [F.when(F.isnan(F.col(f.name)), F.lit(None)).otherwise(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


def dataset_column_name(name: str) -> str:
    """Published column naming: lower case, blanks become underscores."""
    return name.lower().replace(" ", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[dataset_column_name(c) for c in df.columns])


def sum_columns(cols: list[str]) -> Column:
    """Row-wise sum that skips NULLs (pandas ``sum(axis=1)``)."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in cols])
