"""The corpus pipeline: quality rules, near copies, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's docs. All but the last return the
columns of documents. The first two stages drop rows, the third rewrites texts,
the fourth repeats and drops rows to meet the sources' target weights, and the
last gives the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from curbwise.llm import mixing, ngram_join, packing, pii, quality
from curbwise.llm.common import scratch, with_columns_of


def _counted(result: DataFrame, docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the rewritten text, where the table has the column."""
    if "n_chars" in docs.columns:
        result = result.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return with_columns_of(result, docs)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null, empty and very short texts go, repeated rows are judged each."""
    return quality.keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id; texts without words and null doc_ids stay."""
    return ngram_join.drop_near_copies(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates for personal data; null and empty texts stay as they are, equal texts stay equal."""
    return _counted(pii.replace(docs), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the sources meet their target weights; a null source is one of them, texts without words go."""
    return _counted(mixing.repeat(docs), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences, every id in one piece; a null or empty text has its end id alone."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("personal_data", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Tokens, shingle components and keyed surrogates are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written to the shared folder and read again; empty tables give empty results."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
