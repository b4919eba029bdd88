"""CSV at the boundary: explicit or inferred types, the usual null tokens, header output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbwise.functions.dates import parse_mixed_timestamp

# Text that spreadsheet / report CSVs use for a missing value
# (the default missing-value markers of common CSV readers).
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
               "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# How the fields of typed columns are written.
TRUE_TOKENS, FALSE_TOKENS = ["True", "TRUE", "true"], ["False", "FALSE", "false"]
LONG_TEXT = r"^\s*[+-]?[0-9]+\s*$"
DOUBLE_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
INFINITY_TEXT = r"(?i)^[+-]?inf(inity)?$"
#: ISO dates and times, for the columns that may become timestamps on request.
TIMESTAMP_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"

# One bit per kind of field, so that the kinds seen in a column are a bit_or.
_BOOL, _LONG, _DOUBLE, _TIMESTAMP, _TEXT = 1, 2, 4, 8, 16


def has_quoted_line_ends(spark: SparkSession, path: str) -> bool:
    """Whether a line holds an odd number of quotes, so that a quoted field may go over its end."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def _or_null(c: Column, null_tokens: list[str]) -> Column:
    return F.when(~c.isin(null_tokens), c) if null_tokens else c


def read_text(spark: SparkSession, path: str, null_tokens: list[str] = NULL_TOKENS) -> DataFrame:
    """CSV with a header, every field as text, null tokens as NULL; quotes are doubled inside quotes.

    Files are split among tasks where no field holds a line end (a first pass over
    the lines tells); with such fields a file is one task.
    """
    raw = (spark.read.option("header", True).option("multiLine", has_quoted_line_ends(spark, path)).option("quote", '"')
           .option("escape", '"').option("mode", "PERMISSIVE").csv(path))
    return raw.select(*[_or_null(F.col(f"`{c}`"), null_tokens).alias(c) for c in raw.columns])


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             null_tokens: list[str] = NULL_TOKENS, errors: str = "raise") -> DataFrame:
    """CSV with a header -> the columns of ``schema`` by header name; further columns are ignored.

    Null tokens become NULL, then the text is cast. Date and
    time text that no layout fits fails the job (``errors="null"``: NULL);
    other values that do not fit the declared type become NULL.
    """
    raw = read_text(spark, path, null_tokens)
    cols = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            cols.append(c.alias(f.name))
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            cols.append(parse_mixed_timestamp(c, errors).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.to_date(parse_mixed_timestamp(c, errors)).alias(f.name))
        else:
            cols.append(c.try_cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def _kind(c: Column, timestamps: bool) -> Column:
    """The bit of the narrowest kind that holds a field; NULL has none."""
    number = F.regexp_replace(c, r"\s", "")
    whole = F.when(number.try_cast("long").isNotNull(), _LONG).otherwise(_TEXT)  # beyond 64 bits: the digits stay text
    kind = (F.when(c.isNull(), 0).when(c.isin(TRUE_TOKENS + FALSE_TOKENS), _BOOL).when(c.rlike(LONG_TEXT), whole)
            .when(c.rlike(DOUBLE_TEXT) | c.rlike(INFINITY_TEXT), _DOUBLE))
    if timestamps:
        kind = kind.when(c.rlike(TIMESTAMP_TEXT) & c.try_cast("timestamp_ntz").isNotNull(), _TIMESTAMP)
    return kind.otherwise(_TEXT)


def _joined(seen: int) -> T.DataType:
    """The narrowest type for all kinds of a column: none < boolean, none < long < double, none < timestamp; else text."""
    if seen == _BOOL:
        return T.BooleanType()
    if seen == _LONG:
        return T.LongType()
    if seen in (0, _DOUBLE, _LONG | _DOUBLE):
        return T.DoubleType()  # a column without values is numeric, as CSV readers have it
    return T.TimestampNTZType() if seen == _TIMESTAMP else T.StringType()


def infer_types(raw: DataFrame, timestamps: bool = False) -> T.StructType:
    """The narrowest type of each text column over all its rows: one aggregation, one row to the driver.

    Every field counts, so a column whose first text comes late is text. ``timestamps``
    also finds columns of ISO dates and times, which otherwise stay text.
    """
    seen = raw.agg(*[F.bit_or(_kind(F.col(f"`{c}`"), timestamps)).alias(f"_{i}") for i, c in enumerate(raw.columns)]).first()
    return T.StructType([T.StructField(c, _joined(seen[i] or 0)) for i, c in enumerate(raw.columns)])


def _typed(c: Column, to: T.DataType) -> Column:
    if isinstance(to, T.StringType):
        return c
    if isinstance(to, T.BooleanType):
        return F.when(c.isNotNull(), c.isin(TRUE_TOKENS))
    plain = c if isinstance(to, T.TimestampNTZType) else F.regexp_replace(c, r"\s", "")
    if isinstance(to, T.DoubleType):
        infinite = F.when(plain.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
        return F.when(plain.rlike(INFINITY_TEXT), infinite).otherwise(plain.cast(to))
    return plain.cast(to)


def read_typed(spark: SparkSession, path: str, null_tokens: list[str] = NULL_TOKENS, timestamps: bool = False) -> DataFrame:
    """CSV with a header, typed by what all its fields hold; null tokens are NULL.

    Whole numbers with missing values stay whole numbers, and whole numbers
    beyond 64 bits make their column text.
    """
    raw = read_text(spark, path, null_tokens)
    schema = infer_types(raw, timestamps)
    return raw.select(*[_typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields])


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """Write a CSV directory (one file per partition) with a header line; quotes are doubled."""
    df.write.mode("overwrite").option("header", header).option("quote", '"').option("escape", '"').csv(path)
