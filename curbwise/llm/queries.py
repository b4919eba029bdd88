"""Registered queries: each applies one operator to its whole table.

Tables are read by Spark from ``sf_dir``; nothing is limited, sampled or
filtered by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from curbwise.llm import alignment, ann, chat_format, edit_embedding, huffman, mixing, ngram_join, packing, periodic, pii, quality, url_filter, warc
from curbwise.llm.common import scratch, words

#: Fixed values of the url query.
URL_RULES = ("allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = ngram_join.join_counted(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_shingles", "component_id", "n_links")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    got = chat_format.format_conversations(rows.unionByName(planted))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat_format.masked_text(F.col("formatted"), F.col("loss_mask"))
    return got.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                      F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"), "escaped", "round_trip")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    rules = [url_filter.parse_rule(r) for r in URL_RULES]
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(_table(spark, sf_dir, "documents"))


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = huffman.write_tokens(docs, scratch(spark, "token-files"))
    return huffman.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archive(_table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    got = warc.read_archive(spark, path, payload=False, verify=True).filter(F.col("record_type").isin("response", "revisit"))
    return got.select(warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      warc.page_of("refers_to").alias("refers_to"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"), rules=quality.EVERY_TEXT)
    return got.select("doc_id", *[F.col(f"measures.{m}").alias(m) for m in quality.BASE], "base_failed", "kept")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = edit_embedding.compare_neighbours(_table(spark, sf_dir, "documents"))
    marks = [F.lower(F.hex(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")]
    return got.select("doc_id", "n_chars", "edited_sha256", *marks, "near_edited", "near_next")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.counts(_table(spark, sf_dir, "documents"))


def _repeating(text: F.Column, doc_id: F.Column) -> F.Column:
    """The text whose words from a place on repeat a unit, for the documents that the query alters."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    w = words(text)
    n = F.size(w)
    a = F.when(n > 0, g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    unit = F.slice(w, a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(w, F.lit(1), a), tail), " ")).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    got = periodic.collapse(docs.select("doc_id", _repeating(F.col("text"), F.col("doc_id")).alias("text")))
    best = F.col("strongest")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return got.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
                      best["length"].alias("length"), best["period"].alias("period"),
                      F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
                      F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_chat_formatting, op3_url_filters, op4_nearest_neighbours, op5_pii, op6_token_output, op7_warc, op8_quality_rules, op9_mixing, op10_packing, op11_edit_fingerprints, op12_token_alignment, op13_periodic_runs)}


def queries() -> dict:
    return dict(QUERIES)
