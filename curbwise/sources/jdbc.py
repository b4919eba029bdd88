"""Reading the permit model from the source database over JDBC.

The reports run in Spark, so the database only serves table scans: one
partitioned JDBC read per table, split on its numeric key so every task pulls
a key range in parallel, with column and filter pushdown done by Spark's JDBC
source. The extracted tables are normally written to parquet once and the
reports read that (``PermitTables.from_parquet``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbwise.functions.text import empty_as_null
from curbwise.schemas import PERMIT_SCHEMAS
from curbwise.sources.tables import PermitTables

# Key column used to split each table's JDBC scan into ranges.
SPLIT_COLUMNS = {
    "folder": "folderrsn", "folderprocess": "processrsn", "folderprocessattempt": "processrsn",
    "folderprocessdeficiency": "processrsn", "folderinfo": "folderrsn", "folderpeople": "folderrsn",
    "people": "peoplersn", "folderproperty": "folderrsn", "property": "propertyrsn",
    "propertyinfo": "propertyrsn", "folderfreeform": "folderrsn", "accountbill": "folderrsn",
    "accountbillfee": "folderrsn", "accountpaymentdetail": "folderrsn", "accountpayment": "folderrsn",
}


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 fetch_size: int = 10_000, **extra) -> dict[str, str]:
    # DATE columns have no zone: read them as wall-clock times, not instants
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), "preferTimestampNTZ": "true"}
    if user:
        opts["user"] = user
    if password:
        opts["password"] = password
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


# Keys are counted in this many equal widths before the ranges are cut.
HISTOGRAM_BINS = 4096


def histogram_query(table: str, column: str, low: int, high: int, bins: int = HISTOGRAM_BINS) -> str:
    """The database's count of rows per equal width of the key: at most ``bins`` + 1 rows."""
    width = max(1, -(-(high - low + 1) // bins))
    return (f"(SELECT FLOOR(({column} - {low}) / {width}) AS bin, COUNT(*) AS n FROM {table} "
            f"WHERE {column} IS NOT NULL GROUP BY FLOOR(({column} - {low}) / {width})) h")


def balanced_bounds(counts: dict[int, int], low: int, width: int, parts: int) -> list[int]:
    """Lower bounds of the second and later key ranges, so that ranges hold about equal numbers of rows.

    A width that holds more than a range's share gets a range of its own.
    """
    share, held, out = sum(counts.values()) / parts, 0, []
    for b in sorted(counts):
        if held and held + counts[b] / 2 > share:
            out.append(low + b * width)
            held = 0
        held += counts[b]
    return out


def range_predicates(column: str, bounds: list[int]) -> list[str]:
    """Disjoint conditions that together hold every row, rows without a key included."""
    if not bounds:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{column} < {bounds[0]} OR {column} IS NULL", *inner, f"{column} >= {bounds[-1]}"]


def read_table(spark: SparkSession, url: str, table: str, split_column: str | None = None,
               num_partitions: int = 64, schema_name: str | None = None, **conn) -> DataFrame:
    """One table, read in about ``num_partitions`` key ranges of ``split_column``.

    A ``min/max`` query and a histogram of the key, both pushed to the database, give
    ranges with about equal numbers of rows, however the keys are spread.
    """
    qualified = f"{schema_name}.{table}" if schema_name else table
    base = jdbc_options(url, qualified, **conn)

    def ask(query: str):
        return spark.read.format("jdbc").options(**{**base, "dbtable": query}).load()

    bounds = ask(f"(SELECT MIN({split_column}) lo, MAX({split_column}) hi FROM {qualified}) b").first() if split_column else None
    if bounds is None or bounds[0] is None:
        df = spark.read.format("jdbc").options(**base).load()
    else:
        low, high = int(bounds[0]), int(bounds[1])
        counts = {int(r[0]): int(r[1]) for r in ask(histogram_query(qualified, split_column, low, high)).collect()}
        width = max(1, -(-(high - low + 1) // HISTOGRAM_BINS))
        predicates = range_predicates(split_column, balanced_bounds(counts, low, width, num_partitions))
        properties = {k: v for k, v in base.items() if k not in ("url", "dbtable")}
        df = spark.read.jdbc(url, qualified, predicates=predicates, properties=properties)
    return df.toDF(*[c.lower() for c in df.columns])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Cast a source table to the model's declared types; empty text is NULL (Oracle rule)."""
    schema = PERMIT_SCHEMAS[table]
    return empty_as_null(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]))


def from_jdbc(spark: SparkSession, url: str, tables: list[str] | None = None,
              num_partitions: int = 64, **conn) -> PermitTables:
    names = tables or [n for n in PERMIT_SCHEMAS if n in SPLIT_COLUMNS or n.startswith("valid")]

    def loader(name):
        return lambda: conform(read_table(spark, url, name, SPLIT_COLUMNS.get(name),
                                          num_partitions, **conn), name)
    return PermitTables(spark, {n: loader(n) for n in names})


# Attribute (EAV) tables are stored partitioned by attribute code: every
# report reads a handful of codes, which then prune to a handful of folders.
PARTITION_COLUMNS = {"folderinfo": "infocode", "propertyinfo": "propertyinfocode"}


def extract_to_parquet(t: PermitTables, root: str, tables: list[str] | None = None) -> None:
    """Write each table to ``root/<table>`` (the nightly extract)."""
    for name in tables or t.names():
        writer = getattr(t, name).write.mode("overwrite")
        if name in PARTITION_COLUMNS:
            writer = writer.partitionBy(PARTITION_COLUMNS[name])
        writer.parquet(f"{root.rstrip('/')}/{name}")


# The key that most joins of a table use: bucketed extracts are laid out by it.
BUCKET_COLUMNS = {name: key for name, key in SPLIT_COLUMNS.items()}
BUCKET_COLUMNS["folderprocess"] = "folderrsn"


def extract_to_tables(t: PermitTables, database: str, buckets: int, tables: list[str] | None = None) -> None:
    """Write each table as ``database.<table>``, bucketed and sorted by its join key.

    Tables with equal numbers of buckets join on that key without a shuffle and
    without a sort (``PermitTables.from_tables``). Choose ``buckets`` so that a bucket
    of the largest table is some hundred MB. Attribute tables are partitioned by code
    besides. Tables without such a key (code lists) are plain.
    """
    for name in tables or t.names():
        df = getattr(t, name)
        key = BUCKET_COLUMNS.get(name)
        writer = (df.repartition(buckets, key) if key else df).write.mode("overwrite").format("parquet")
        if name in PARTITION_COLUMNS:
            writer = writer.partitionBy(PARTITION_COLUMNS[name])
        if key:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(f"{database}.{name}")
