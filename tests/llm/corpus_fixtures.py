"""Small fixtures shared by the corpus operator tests."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows, schema=DOCS):
    """Rows are (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], *(r[2:] or ("en", "a")), None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, schema)


def clashing(df):
    """The table with further columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    for name in ("n", "sid", "row", "size", "target", "measures", "kept", "host", "rule", "h", "__t", "pii_count", "rank", "payload.x"):
        df = df.withColumn(name, F.lit(name))
    return df


def word_list(text):
    return SPACE.findall(text or "")


def random_text(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edit(rng: random.Random, text: str, changes: int) -> str:
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def sf(tmp_path, **tables):
    """A folder of tables as the queries read them."""
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


__all__ = ["DOCS", "T", "clashing", "documents", "edit", "random_text", "sf", "word_list"]
