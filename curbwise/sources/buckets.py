"""Keyed datasets in hash buckets: an upsert rewrites the buckets of its keys only.

A bucketed version of a published dataset (see ``sinks``) is a folder::

    <root>/version=000007/_bucket=12/*.parquet     the buckets that this version wrote
    <root>/version=000007/_manifest.json           for every bucket the version that holds it

A row's bucket is a hash of its key, so a key is in one bucket. An upsert deals
its rows to buckets, reads the current rows of those buckets, merges, writes them
under the next version and then the manifest, in which the other buckets keep the
version they had. A version without its manifest does not exist for readers: a
job that fails before leaves the dataset as it was, and a retry writes the same
version again. Applying an update again gives the same rows.

The manifest has one entry per bucket. The number of buckets is fixed when the
first bucketed version is written; choose it so that a bucket is some hundred MB.
Columns may be added by an update (older rows have NULL there); an update whose
column needs a wider type than the stored one rewrites all buckets.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
MANIFEST = "_manifest.json"
_BUCKET = "_bucket"


def bucket_of(key: list[str], buckets: int) -> Column:
    """The bucket of a row: equal for equal keys, NULL parts included."""
    parts = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("\0")) for k in key]
    return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")


def _path(spark: SparkSession, *parts: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join(parts))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def read_manifest(spark: SparkSession, version_path: str) -> dict | None:
    """The manifest of a version; None where it is not a bucketed one."""
    fs, path = _path(spark, version_path, MANIFEST)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def _write_manifest(spark: SparkSession, version_path: str, manifest: dict) -> None:
    """Written beside its name first, so that readers never see a part of it."""
    fs, path = _path(spark, version_path, MANIFEST)
    _, beside = _path(spark, version_path, f"{MANIFEST}.part")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(json.dumps(manifest).encode()))
    finally:
        stream.close()
    if fs.exists(path):  # a retry of the same version
        fs.delete(path, False)
    if not fs.rename(beside, path):
        raise OSError(f"manifest of {version_path} could not be put in place")


def read(spark: SparkSession, root: str, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
    """The rows of all buckets, or of some."""
    schema = T.StructType.fromJson(manifest["schema"])
    held = {int(b): v for b, v in manifest["held"].items() if buckets is None or int(b) in buckets}
    if not held:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root.rstrip('/')}/version={v:06d}/{_BUCKET}={b}" for b, v in sorted(held.items())])


def _write(df: DataFrame, version_path: str, key: list[str]) -> None:
    """A folder per bucket, rows by key; the manifest, not a marker file, makes the version complete."""
    (df.repartition(F.col(_BUCKET)).sortWithinPartitions(_BUCKET, *key).write.mode("overwrite").partitionBy(_BUCKET)
     .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(version_path))


def _held(spark: SparkSession, version_path: str) -> list[int]:
    fs, path = _path(spark, version_path)
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{_BUCKET}="))


def create(spark: SparkSession, df: DataFrame, root: str, version: int, key: list[str], buckets: int = BUCKETS) -> None:
    """A bucketed version with all its buckets."""
    target = f"{root.rstrip('/')}/version={version:06d}"
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    _write(df.withColumn(_BUCKET, bucket_of(key, buckets)), target, key)
    _write_manifest(spark, target, {"key": key, "buckets": buckets, "schema": schema.jsonValue(),
                                    "held": {str(b): version for b in _held(spark, target)}})


def _fits(update: T.DataType, stored: T.DataType) -> bool:
    """Whether values of an update can be stored without loss."""
    wider = {"tinyint": 1, "smallint": 2, "int": 3, "bigint": 4}
    a, b = update.simpleString(), stored.simpleString()
    return a == b or a == "void" or a in wider and b in wider and wider[a] <= wider[b] or (a, b) == ("float", "double")


def upsert(spark: SparkSession, root: str, manifest: dict, version: int, updates: DataFrame, merge) -> None:
    """The next version: ``merge(current rows of the touched buckets, updates)`` beside the other buckets.

    ``updates`` has one row per key. It is written to the new version's folder first,
    by bucket, so that it is computed once and names its buckets.
    """
    key, n = manifest["key"], manifest["buckets"]
    stored = {f.name: f.dataType for f in T.StructType.fromJson(manifest["schema"]).fields}
    target = f"{root.rstrip('/')}/version={version:06d}"
    staged = f"{target}/_updates"  # a name that readers of the folder pass over
    _write(updates.withColumn(_BUCKET, bucket_of(key, n)), staged, key)
    touched = _held(spark, staged)
    types = T.StructType([T.StructField(f.name, f.dataType) for f in updates.schema.fields])
    fits = all(_fits(f.dataType, stored[f.name]) for f in types.fields if f.name in stored)
    part = spark.read.schema(types).parquet(*[f"{staged}/{_BUCKET}={b}" for b in touched]) if touched else spark.createDataFrame([], types)
    if fits:
        part = part.select(*[F.col(f"`{c}`").cast(stored.get(c, t)).alias(c) for c, t in ((f.name, f.dataType) for f in types.fields)])
    merged = merge(read(spark, root, manifest, touched if fits else None), part)
    merged = merged.withColumn(_BUCKET, bucket_of(key, n))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in merged.schema.fields if f.name != _BUCKET])
    if touched or not fits:
        (merged.repartition(F.col(_BUCKET)).sortWithinPartitions(_BUCKET, *key).write.mode("append").partitionBy(_BUCKET)
         .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(target))
    fs, path = _path(spark, staged)
    fs.delete(path, True)
    held = manifest["held"] | {str(b): version for b in _held(spark, target)}
    _write_manifest(spark, target, {"key": key, "buckets": n, "schema": schema.jsonValue(), "held": held})


def clear(spark: SparkSession, version_path: str) -> None:
    """Removes what a failed job left of a version."""
    fs, path = _path(spark, version_path)
    if fs.exists(path):
        fs.delete(path, True)
