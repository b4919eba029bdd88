"""Publishing results: full replace and keyed upsert of versioned datasets.

A published dataset is a folder of immutable versions::

    <root>/version=000001/   (parquet, complete once _SUCCESS exists)
    <root>/version=000002/

Readers take the newest complete version; writers add the next one. A
replace writes the new rows as the next version; an upsert gives
``current rows whose key is not updated  UNION ALL  updates``, keys compared
null-safe and at most one row per key. Upserted datasets are kept in hash buckets
of the key, and only the buckets of the updated keys are written again
(``buckets``). A failed or killed job leaves no ``_SUCCESS`` marker (bucketed: no
manifest), so readers never see a partial version, and a retry simply rewrites that version.
Applying the same upsert twice gives the same rows (idempotent). One writer
per dataset at a time is assumed (jobs publishing the same dataset are run
one after the other); ``prune`` removes old versions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbwise.functions.text import nan_to_null, normalize_columns
from curbwise.sources import buckets

_VERSION = re.compile(r"^version=(\d+)$")


def _fs(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path, jvm


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions of the dataset at ``root``, oldest first."""
    fs, path, jvm = _fs(spark, root)
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        m = _VERSION.match(st.getPath().getName())
        marks = ("_SUCCESS", buckets.MANIFEST)
        if m and st.isDirectory() and any(fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), x)) for x in marks):
            out.append(int(m.group(1)))
    return sorted(out)


def _version_path(root: str, v: int) -> str:
    return f"{root.rstrip('/')}/version={v:06d}"


def read_latest(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame | None:
    """Rows of the newest complete version (all rows; no cap), cast to ``schema``."""
    vs = versions(spark, root)
    if not vs:
        return None
    manifest = buckets.read_manifest(spark, _version_path(root, vs[-1]))
    df = buckets.read(spark, root, manifest) if manifest else spark.read.parquet(_version_path(root, vs[-1]))
    if schema is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return df


def _write_next(spark: SparkSession, df: DataFrame, root: str, cluster_by: list[str] | None = None) -> int:
    vs = versions(spark, root)
    nxt = (vs[-1] + 1) if vs else 1
    buckets.clear(spark, _version_path(root, nxt))  # what a failed job may have left
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    df.write.mode("overwrite").parquet(_version_path(root, nxt))
    return nxt


def latest_by_key(updates: DataFrame, key: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row per key (NULL is a key): the last by ``order_by``, ties the largest row.

    Without ``order_by`` rows of one key must be equal; the job fails if they are not.
    A maximum with partial aggregation, so a key with many versions is no single task.
    """
    rest = [c for c in updates.columns if c not in key and c not in (order_by or [])]
    row = F.struct(*(order_by or []), *rest) if order_by or rest else F.struct(F.lit(0).alias("_0"))
    got = updates.groupBy(*key).agg(F.max(row).alias("_hi"), F.min(row).alias("_lo"))
    best = F.col("_hi")
    if not order_by:
        differ = F.raise_error(F.lit(f"rows with the same {', '.join(key)} differ and no order is declared"))
        best = F.when(F.col("_hi").eqNullSafe(F.col("_lo")), F.col("_hi")).otherwise(differ)
    got = got.withColumn("_row", best)
    return got.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in updates.columns])


def merge_by_key(current: DataFrame, updates: DataFrame, key: list[str], order_by: list[str] | None = None) -> DataFrame:
    """Keyed upsert as a DataFrame: rows of ``current`` not keyed in ``updates``, plus one row per key of ``updates``.

    A null-safe left-anti join on the key (one shuffle of each side by key, or
    a broadcast of the update keys when Spark measures them small) and a
    union; no row of either side passes through the driver.
    """
    return _keep_other_keys(current, latest_by_key(updates, key, order_by), key)


def _keep_other_keys(current: DataFrame, upd: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``current`` whose key ``upd`` lacks, and ``upd``, which has one row per key."""
    keys = upd.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)])
    same = F.lit(True)
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    kept = current.join(keys, same, "left_anti")
    return kept.unionByName(upd, allowMissingColumns=True)


def replace(spark: SparkSession, df: DataFrame, root: str, cluster_by: list[str] | None = None) -> int:
    """Publish ``df`` as the whole dataset (an empty ``df`` truncates it).

    With ``cluster_by`` every file holds a range of those columns, in order, so that
    readers of a few keys open a few files and row groups (the files' minima and maxima tell).
    """
    return _write_next(spark, df, root, cluster_by)


def upsert(spark: SparkSession, updates: DataFrame, root: str, key: list[str], order_by: list[str] | None = None,
           n_buckets: int = buckets.BUCKETS) -> int:
    """Insert or replace rows of the dataset by ``key`` (one row per key, see ``latest_by_key``).

    The first upsert of a dataset lays it out in ``n_buckets`` hash buckets of the key;
    later ones read and write the buckets of the updated keys.
    """
    vs = versions(spark, root)
    nxt = (vs[-1] + 1) if vs else 1
    buckets.clear(spark, _version_path(root, nxt))
    latest = latest_by_key(updates, key, order_by)
    manifest = buckets.read_manifest(spark, _version_path(root, vs[-1])) if vs else None
    if manifest and manifest["key"] == list(key):
        buckets.upsert(spark, root, manifest, nxt, latest, lambda current, new: _keep_other_keys(current, new, key))
    else:
        current = read_latest(spark, root)
        merged = latest if current is None else _keep_other_keys(current, latest, key)
        buckets.create(spark, merged, root, nxt, list(key), n_buckets)
    return nxt


def prune(spark: SparkSession, root: str, keep: int = 3) -> None:
    """Delete all but the newest ``keep`` complete versions. Buckets that a kept version still reads stay."""
    fs, _, jvm = _fs(spark, root)
    vs = versions(spark, root)
    used: dict[int, set[int]] = {}
    for v in vs[-keep:]:
        for b, of in (buckets.read_manifest(spark, _version_path(root, v)) or {"held": {}})["held"].items():
            used.setdefault(of, set()).add(int(b))
    for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(root)) if vs else []:
        m = _VERSION.match(st.getPath().getName())
        v = int(m.group(1)) if m else None
        if v is None or v >= vs[-keep:][0]:
            continue
        if v not in used:
            fs.delete(st.getPath(), True)
            continue
        fs.delete(jvm.org.apache.hadoop.fs.Path(st.getPath(), buckets.MANIFEST), False)  # first: no version any more
        for part in fs.listStatus(st.getPath()):
            bucket = part.getPath().getName().partition("=")[2]
            if bucket and int(bucket) not in used[v]:
                fs.delete(part.getPath(), True)


@dataclass(frozen=True)
class PublishSpec:
    name: str
    method: str  # "replace" | "upsert"
    key: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()  # of rows with one key the last by these columns stays
    cluster_by: tuple[str, ...] = ()  # replaced datasets are laid out by ranges of these columns


# How each result dataset is published, and its row key.
PUBLISH_SPECS = {
    "license_agreements_timeline": PublishSpec("license_agreements_timeline", "replace"),
    "lde_site_plan_revisions": PublishSpec("lde_site_plan_revisions", "upsert", ("processrsn", "councildistrict"), ("cyclenumber",)),
    "tds_cases": PublishSpec("tds_cases", "replace"),
    "tds_asmd_map": PublishSpec("tds_asmd_map", "replace"),
    "sif_payment_details": PublishSpec("sif_payment_details", "replace"),
    "review_time": PublishSpec("review_time", "replace"),
    "weekly_summary": PublishSpec("weekly_summary", "replace"),
    "active_permits_snapshot": PublishSpec("active_permits_snapshot", "upsert", ("published_date",)),
    "inspector_priority": PublishSpec("inspector_priority", "replace", cluster_by=("folderrsn",)),
    "segment_zone_tags": PublishSpec("segment_zone_tags", "upsert", ("segment_id",)),
}


def publish(spark: SparkSession, name: str, df: DataFrame, root: str,
            specs: dict[str, PublishSpec] = PUBLISH_SPECS) -> int:
    """Publish a result under ``root/<name>`` as configured: NaN -> NULL, column names normalised."""
    spec = specs[name]
    clean = nan_to_null(normalize_columns(df))
    target = f"{root.rstrip('/')}/{name}"
    if spec.method == "replace":
        return replace(spark, clean, target, list(spec.cluster_by) or None)
    if spec.method == "upsert":
        text = [c for c in spec.order_by if clean.schema[c].dataType == T.StringType()]
        if text:
            raise ValueError(f"{name}: rows of one key are ordered by {', '.join(text)}, which is text here and would sort as text")
        return upsert(spark, clean, target, list(spec.key), list(spec.order_by) or None)
    raise ValueError(f"unknown publish method {spec.method!r}")
