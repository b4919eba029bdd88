"""The pipeline's stages against brute force, each on its own input."""

import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from corpus_fixtures import clashing, documents, edit, random_text, sf, word_list
from test_huffman import library
from test_ngram_join import brute as components
from test_quality import measured

import corpus_pipeline
from curbwise.llm import mixing, oracle, pii, queries


def corpus(seed=8):
    rng = random.Random(seed)
    lead = "the garden of the house is in a big old town and it was for all "
    rows, n = [], 0
    for _ in range(25):
        base = lead + random_text(rng, rng.choice([40, 80, 160]), 3000)
        for _ in range(rng.randint(1, 4)):
            rows.append((n, edit(rng, base, rng.choice([0, 0, 1, 2])), "en", rng.choice(["a", "a", "a", "b", "c", None])))
            n += 1
    rows += [(n, "#$% " * 40, "en", "a"), (n + 1, "BUY!! " * 60, "en", "b"), (n + 2, None, "en", "a"), (n + 3, "", "fr", "b"), (n + 4, "few words", "en", "c"),
             (n + 5, lead + random_text(rng, 60, 3000) + " mail me: jo.smith3@mail4.example.com or +1 (017) 555-7713.", "en", "b"), (n + 6, lead + " ".join(f"u{i}" for i in range(20000)), "en", "z")]
    return rows


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """Each stage's input and output, written and read as the pipeline does."""
    top = tmp_path_factory.mktemp("stages")
    d = sf(top, documents=clashing(documents(spark, corpus())))
    docs, out = spark.read.parquet(f"{d}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, d).write.parquet(f"{top}/{name}")
        after = spark.read.parquet(f"{top}/{name}")
        out.append((docs, after))
        docs = after
    return d, out


def test_columns_stay_until_packing(staged):
    _, stages = staged
    for before, after in stages[:-1]:
        assert after.dtypes == before.dtypes
    assert stages[-1][1].columns[:3] == ["doc_id", "start", "length"]


def test_quality_stage(staged):
    before, after = (x.collect() for x in staged[1][0])
    kept = {r["doc_id"] for r in after}
    con = duckdb.connect()
    con.register("documents", staged[1][0][0].select("doc_id", "text", "lang").toPandas())
    assert kept == {r[0] for r in con.execute(oracle.OP8).fetchall() if r[-1]}
    assert all((measured(r["text"])[0] >= 10) for r in after) and 0 < len(after) < len(before)


def test_near_copies_stage(staged):
    before, after = (x.collect() for x in staged[1][1])
    comps = components([(r["doc_id"], r["text"]) for r in before])
    assert Counter(r["doc_id"] for r in after) == Counter({c for _, _, c in comps})
    assert len(after) < len(before)


def test_personal_data_stage(staged):
    before, after = (x.collect() for x in staged[1][2])
    old, new = ({r["doc_id"]: r for r in x} for x in (before, after))
    assert old.keys() == new.keys()
    changed = {k for k in old if old[k]["text"] != new[k]["text"]}
    assert changed == {k for k in old if pii.detect(old[k]["text"])} and changed
    for k in changed:
        assert not any(old[k]["text"][a:b] in new[k]["text"] for a, b, _, _ in pii.detect(old[k]["text"]))
        assert new[k]["n_chars"] == len(new[k]["text"])


def test_mixing_stage(staged):
    before, after = staged[1][3]
    words, source = defaultdict(int), defaultdict(int)
    for r in after.collect():
        words[r["doc_id"]] += len(word_list(r["text"]))
        source[r["source"]] += len(word_list(r["text"]))
    mixed = mixing.mix(before).collect()
    assert dict(words) == {r["doc_id"]: r["taken"] for r in mixed if r["taken"]}
    wanted = {r["doc_id"]: r for r in mixed}
    for r in before.collect():
        assert abs(source[r["source"]] - wanted[r["doc_id"]]["target"]) <= 1


def test_packing_stage_and_run(spark, staged):
    d, stages = staged
    before, after = (x.collect() for x in stages[4])
    assert sum(r["length"] for r in after) == sum(map(len, library([r["text"] for r in before])))
    room = defaultdict(int)
    for r in after:
        room[r["sequence_id"]] += r["length"]
    assert max(room.values()) <= 4096
    key = lambda rows: Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert key(corpus_pipeline.run(spark, d).collect()) == key(after)


def test_empty_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, sf(tmp_path, documents=documents(spark, []))).count() == 0


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_queries_equal_sql_on_the_given_tables(spark, name):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    df = queries.queries()[name](spark, d)
    got = con.execute(oracle.oracle_sql()[name])
    order = [[c[0] for c in got.description].index(c) for c in df.columns]
    assert Counter(map(tuple, df.collect())) == Counter(tuple(r[i] for i in order) for r in got.fetchall())


def test_ids_of_the_token_queries_on_the_given_table(spark):
    import zlib

    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    at, want = 0, set()
    for r, ids in zip(rows, library([r["text"] for r in rows])):
        want.add((r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert set(map(tuple, queries.op6_token_output(spark, d).collect())) == want


def test_entry_lists_all_queries():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert [n for n in names if n.startswith("op")] == list(queries.queries()) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
