import math
import random

import numpy as np
from corpus_fixtures import sf
from pyspark.sql import functions as F

from curbwise.llm import ann, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, k=10):
    usable = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            usable[i, tuple(np.float32(x) for x in v)] = np.array(v, np.float32).astype(float)
    out = {}
    for (i, _), v in usable.items():
        if i % every == 0:
            near = sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for (j, _), w in usable.items() if j != i and len(w) == len(v))
            out[i] = near[:k]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_edge_cases_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist(), 0) for i in range(60)]
    rows += [(i, [1.0] * 8, 1) for i in range(60, 100)] + [(100, [1.0] * 8, 1), (100, [1.0] * 8, 1)]  # equal vectors, a repeated row
    rows += [(200, None, 0), (300, [], 0), (400, [0.0] * 8, 0), (500, [1.0, None] + [0.0] * 6, 0), (600, [float("nan")] * 8, 0),
             (700, [float("inf")] + [0.0] * 7, 0), (None, [2.0] * 8, 0), (800, [1.0, 2.0], 0), (801, [1.0, 2.5], 0), (0, rows[0][1], 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(1) for n in ("ids", "shard", "kind", "v", "dim", "rank")})
    got = found(ann.search(df, F.col("vec_id") % 20 == 0))
    want = brute(rows, 20)
    assert {k: [x[1] for x in v] for k, v in got.items()} == {k: [x[1] for x in v] for k, v in want.items() if v}
    assert all(abs(a[0] - b[0]) < 1e-12 for k in got for a, b in zip(got[k], want[k]))


def test_recall_over_shards(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 32))
    rows = [(i, (centres[i % 12] + 0.3 * rng.normal(size=32)).tolist(), 0) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(ann.search(df, F.col("vec_id") % 100 == 0, shard_rows=700))
    want = brute(rows, 100)
    recall = np.mean([len({x[1] for x in got[q]} & {x[1] for x in want[q]}) / 10 for q in want])
    assert len(got) == 30 and recall >= 0.95


def test_shards_follow_partitions_and_memory(spark):
    assert [ann.shard_count(n, 64, 200) for n in (1, 8192, 8193, 51282, 10**6, 10**7)] == [1, 1, 2, 7, 123, 248]
    assert all(ann.shard_count(10**9, 64, p) == 24796 for p in (8, 200, 8000))  # bounded by memory
    assert ann.shard_count(10**9, 64, 40000) == 40000
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).tolist(), 0) for i in range(900)]
    got = found(ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, shard_bytes=100 << 10))  # eight shards
    want = brute(rows, 100)
    assert np.mean([len({x[1] for x in got[q]} & {x[1] for x in want[q]}) / 10 for q in want]) >= 0.95


def test_graph_keeps_diverse_edges():
    rng = np.random.default_rng(3)
    g = ann.Graph(rng.normal(size=(800, 16)), degree=12)
    assert g.edges.shape == (800, 12) and (g.edges >= 0).any(axis=1).all()
    for i in random.Random(1).sample(range(800), 50):
        e = g.edges[i][g.edges[i] >= 0]
        assert len(set(e.tolist())) == len(e) and i not in e


def test_recall_among_nearly_equal_vectors():
    """Thousands of vectors that differ by float noise, among others and far from the origin."""
    rng = np.random.default_rng(4)
    unit = rng.normal(size=(2001, 64))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = (unit[0] + 1e-6 * rng.normal(size=(3000, 64))).astype(np.float32).astype(float)
    far = (1000 + 0.1 * rng.normal(size=(4000, 64))).astype(np.float32).astype(float)
    for points in (np.concatenate([unit[1:], near]), far):
        asked = np.arange(len(points) - 40, len(points))
        ids = [[i] for i in range(len(points))]
        got = ann._answers(ann.Graph(points), points, ids, asked, points[asked], 10, ann.SEARCH_BEAM)
        found_ = [set() for _ in asked]
        for batch in got:
            for q, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found_[q - asked[0]].add(v)
        want = [set(np.argsort(((points - points[q]) ** 2).sum(axis=1), kind="stable")[:11].tolist()) - {q} for q in asked.tolist()]
        assert np.mean([len(f & w) / 10 for f, w in zip(found_, want)]) >= 0.95


def test_query_given_table_and_empty(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    got, want = found(queries.op4_nearest_neighbours(spark, d)), brute(rows, 100)
    assert np.mean([len({x[1] for x in got[q]} & {x[1] for x in want[q]}) / 10 for q in want]) >= 0.9
    empty = sf(tmp_path, embeddings=spark.createDataFrame([], SCHEMA))
    assert queries.op4_nearest_neighbours(spark, empty).count() == 0
