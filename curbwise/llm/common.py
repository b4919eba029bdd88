"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The characters that separate words (x20 and x09 to x0D).
WORD_SPACE = " \t\n\x0b\x0c\r"
#: Java pattern of one run of them.
SPACE_RUN = r"[ \t-\r]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; a null or blank text has none."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(WORD_SPACE))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE_RUN))


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased; every other character is left alone."""
    return F.translate(col, UPPER, LOWER)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, seen by the driver and every executor.

    Local masters without one (tests) get a private folder; on a cluster an
    unset folder is an error, since a machine's own disk is not shared.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not folder and sc.getCheckpointDir():
        folder = sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        import tempfile

        folder = tempfile.mkdtemp(prefix="llm-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return os.path.join(shared_folder(spark), "llm", f"{name}-{uuid.uuid4().hex[:12]}")


#: Spark's setting by which a job's shuffle files go when it ends, and not when the driver happens to collect its garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends at files that
    every executor sees, so a lost executor costs no recomputation of Python stages.
    The shuffle files of the job are of no use then and are removed with it."""
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_garbage(spark: SparkSession) -> None:
    """Has the driver's JVM collect its garbage after many small jobs: their plans and generated code would fill its
    whole heap, and Spark removes the broadcasts and shuffle files of ended queries only after that."""
    spark.sparkContext._jvm.System.gc()


def with_columns_of(result: DataFrame, docs: DataFrame) -> DataFrame:
    """``result`` cut to the columns of ``docs``, in their order and types."""
    return result.select([F.col(f"`{f.name}`").cast(f.dataType) for f in docs.schema.fields])


def free_name(taken: list[str], name: str) -> str:
    """``name``, or with underscores in front until no column of ``taken`` has it (case-blind)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_corpus_package_sent", False):
        return
    import tempfile
    import zipfile
    from pathlib import Path

    package = Path(__file__).resolve().parent.parent
    path = os.path.join(tempfile.mkdtemp(prefix="llm-package-"), f"{package.name}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for f in sorted(package.rglob("*.py")):
            out.write(f, f.relative_to(package.parent))
    sc.addPyFile(path)
    sc._corpus_package_sent = True
