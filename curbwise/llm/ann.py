"""Approximate nearest neighbours with robust-pruned directed graphs, one per shard.

Vectors are made distinct first (a vector keeps its ``k + 1`` smallest ids, all
that a list of k neighbours can show), dealt to shards by hash, and each shard
is one group of a task: its points are inserted in growing batches, a greedy
search of the graph so far proposes neighbours, relaxed distance pruning
(factor ``alpha``) keeps diverse edges among them, and reverse edges are pruned
the same way. Every query then goes through a beam search of each shard of its
dimension; the shards' lists are merged by exact distance. All distances are
those of differences in double precision.

A task holds one shard and one Arrow batch of queries. Queries are a stated set;
each meets each shard, not each row. A search costs about the logarithm of its
shard, so few large shards are cheaper than many small ones: there is one for
every shuffle partition that would get ``shard_rows`` vectors, and more only
where a shard would not fit ``shard_bytes`` (see ``shard_count``).

Cases: vectors that are null, empty, zero, or have null or non-finite
components, and rows without vec_id, take no part; rows that repeat a vec_id
and its vector count once; equal vectors are all candidates, ties go to the
smaller vec_id; vectors of different length are never compared; an empty
table, or one without queries, gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from curbwise.llm.common import saved, ship

SHARD_ROWS = 8192
SHARD_BYTES = 64 << 20
DEGREE = 32
BUILD_BEAM = 48
SEARCH_BEAM = 256
ALPHA = 1.2
ENTRIES = 32
AT_ONCE = 256
EXPAND = 4
_FOUND = "query_id long, vec_id long, score double"


class Graph:
    """A directed graph over the rows of ``points`` with at most ``degree`` edges out of each."""

    def __init__(self, points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 7):
        self.points = np.ascontiguousarray(points, np.float64)
        self.alpha2, self.degree = alpha * alpha, degree
        n = len(points)
        self.edges = np.full((n, degree), -1, np.int64)
        order = np.random.default_rng(seed).permutation(n)
        if n:  # the point nearest to the mean comes first
            middle = int(np.argmin(((self.points - self.points.mean(axis=0)) ** 2).sum(axis=1)))
            order = np.concatenate([[middle], order[order != middle]])
        self.entries, done = order[:ENTRIES], 1
        while done < n:  # batches no larger than the graph so far
            batch = order[done:done + min(done, AT_ONCE)]
            self._insert(batch, beam, done)
            done += len(batch)

    def _distances(self, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances of q[i] to ids[i, :], from differences, which nearly equal vectors need; infinite for -1."""
        x = self.points[np.maximum(ids, 0)]
        x -= q[:, None, :]
        return np.where(ids < 0, np.inf, np.einsum("ijk,ijk->ij", x, x))

    def search(self, q: np.ndarray, beam: int, inserted: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of all rows of ``q`` side by side from the entry points: nodes found, nearest first (-1 fills), and nodes expanded."""
        b, n = len(q), len(self.points)
        rows = np.arange(b)[:, None]
        seen = np.zeros((b, n + 1), bool)  # the last column takes the -1s
        seen[:, n] = True
        ids = np.full((b, beam), -1, np.int64)
        begin = self.entries[:min(beam, len(self.entries) if inserted is None else inserted)]
        ids[:, :len(begin)] = begin
        seen[:, begin] = True
        dist = self._distances(q, ids)
        open_ = ids >= 0
        trail = []
        while True:
            todo = np.where(open_, dist, np.inf)
            pick = np.argpartition(todo, EXPAND - 1, axis=1)[:, :EXPAND] if beam > EXPAND else np.argsort(todo, axis=1)[:, :EXPAND]
            some = np.isfinite(np.take_along_axis(todo, pick, 1))
            live = np.flatnonzero(some.any(axis=1))
            if not len(live):
                break
            nodes = np.where(some, np.take_along_axis(ids, pick, 1), -1)
            open_[rows, pick] = False
            trail.append(nodes)
            near = np.where(nodes[live, :, None] >= 0, self.edges[nodes[live]], -1).reshape(len(live), -1)
            near = np.where(near < 0, n, near)
            near.sort(axis=1)
            fresh = ~seen[live[:, None], near]
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            seen[live[:, None], near] = True
            near = np.where(fresh, near, -1)
            keep = fresh.any(axis=0)
            near = near[:, keep]
            all_ids = np.concatenate([ids[live], near], axis=1)
            all_dist = np.concatenate([dist[live], self._distances(q[live], near)], axis=1)
            all_open = np.concatenate([open_[live], near >= 0], axis=1)
            best = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
            ids[live], dist[live], open_[live] = (np.take_along_axis(x, best, 1) for x in (all_ids, all_dist, all_open))
        return ids, np.concatenate(trail, axis=1) if trail else ids[:, :0]

    def _prune(self, nodes: np.ndarray, cand: np.ndarray) -> np.ndarray:
        """At most ``degree`` diverse neighbours of each node among its candidates, nearest first."""
        cand = np.sort(cand, axis=1)
        cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
        cand[cand == nodes[:, None]] = -1
        x = self.points[np.maximum(cand, 0)]
        x -= self.points[nodes][:, None, :]  # seen from the node, products lose nothing that counts
        norm = np.einsum("ijk,ijk->ij", x, x)
        d = np.where(cand < 0, np.inf, norm)
        between = np.matmul(x, x.transpose(0, 2, 1))
        between *= -2
        between += norm[:, :, None]
        between += norm[:, None, :]
        rows = np.arange(len(nodes))
        out = np.full((len(nodes), self.degree), -1, np.int64)
        left = d.copy()
        for k in range(self.degree):
            pick = np.argmin(left, axis=1)
            ok = np.isfinite(left[rows, pick])
            if not ok.any():
                break
            out[ok, k] = cand[rows, pick][ok]
            covered = self.alpha2 * between[rows, pick] <= d
            covered[rows, pick] = True
            left[covered & ok[:, None]] = np.inf
        return out

    def _insert(self, batch: np.ndarray, beam: int, inserted: int) -> None:
        found, trail = self.search(self.points[batch], beam, inserted)
        out = self._prune(batch, np.concatenate([found, trail], axis=1))
        self.edges[batch] = out
        # reverse edges, grouped by the node they start from
        to, by = out.ravel(), np.repeat(batch, self.degree)
        to, by = to[to >= 0], by[to >= 0]
        order = np.argsort(to, kind="stable")
        to, by = to[order], by[order]
        nodes, first, count = np.unique(to, return_index=True, return_counts=True)
        wide = np.full((len(nodes), self.degree + int(count.max(initial=0))), -1, np.int64)
        wide[:, :self.degree] = self.edges[nodes]
        wide[np.repeat(np.arange(len(nodes)), count), self.degree + np.arange(len(to)) - np.repeat(first, count)] = by
        fits = (wide >= 0).sum(axis=1) <= self.degree
        packed = np.take_along_axis(wide, np.argsort(wide < 0, axis=1, kind="stable"), 1)
        self.edges[nodes[fits]] = packed[fits][:, :self.degree]
        over = np.flatnonzero(~fits)
        for i in range(0, len(over), AT_ONCE):
            some = over[i:i + AT_ONCE]
            used = int((packed[some] >= 0).sum(axis=1).max())
            self.edges[nodes[some]] = self._prune(nodes[some], packed[some][:, :used])


def shard_count(rows: int, dim: int, partitions: int, shard_rows: int = SHARD_ROWS, shard_bytes: int = SHARD_BYTES, degree: int = DEGREE) -> int:
    """Shards for ``rows`` vectors: one per partition, as long as each gets ``shard_rows``, and as many as memory asks for.

    A row of a shard takes its vector twice while the shard is read, its edges,
    its ids and one byte for each query of a search.
    """
    row = 16 * dim + 8 * degree + 128 + AT_ONCE
    return max(-(-rows * row // shard_bytes), min(partitions, -(-rows // shard_rows)))


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def search(vectors: DataFrame, queries: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding",
           shard_rows: int = SHARD_ROWS, shard_bytes: int = SHARD_BYTES, beam: int = SEARCH_BEAM, degree: int = DEGREE, alpha: float = ALPHA) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the nearest found of every row that ``queries`` selects."""
    ship(vectors.sparkSession)
    v = F.col(f"`{embedding}`").cast("array<double>")
    rows = vectors.filter(F.col(f"`{vec_id}`").isNotNull()).select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.alias("v"), F.coalesce(queries, F.lit(False)).alias("asked")).filter(_usable(F.col("v")))
    # the smallest ids of each distinct vector; Spark limits the groups before the shuffle
    first = Window.partitionBy("v").orderBy("vec_id")
    points = (rows.select("vec_id", "v").withColumn("r", F.dense_rank().over(first)).filter(F.col("r") <= k + 1)
              .groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")).withColumn("dim", F.size("v")))
    points = saved(points, "ann-points")
    sizes = {r["dim"]: r["n"] for r in points.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per vector length
    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards, total = {}, 0  # dimension -> (first shard, number of shards)
    for dim in sorted(sizes):
        shards[dim] = (total, shard_count(sizes[dim], dim, partitions, shard_rows, shard_bytes, degree))
        total += shards[dim][1]
    pairs = [F.lit(x) for d, (a, n) in shards.items() for x in (d, F.struct(F.lit(a).alias("a"), F.lit(n).alias("n")))]
    where = F.create_map(*pairs) if pairs else F.lit(None).cast("map<int,struct<a:int,n:int>>")
    at = F.element_at(where, F.col("dim"))
    base = points.select((at["a"] + F.pmod(F.xxhash64("v"), at["n"])).cast("int").alias("shard"), F.lit(0).alias("kind"),
                         F.lit(None).cast("long").alias("query_id"), "ids", "v")
    asked = rows.filter("asked").select("vec_id", "v").distinct().withColumn("dim", F.size("v"))
    asked = asked.select(F.explode(F.sequence(at["a"], at["a"] + at["n"] - 1)).alias("shard"), F.lit(1).alias("kind"),
                         F.col("vec_id").alias("query_id"), F.lit(None).cast("array<long>").alias("ids"), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, ids, graph = None, [], [], None
        for batch in batches:
            number, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cut = [0, *(np.flatnonzero((np.diff(number) != 0) | (np.diff(kind) != 0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cut, cut[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if number[a] != shard:
                    shard, held, ids, graph = number[a], [], [], None
                x = part.column(4).flatten().to_numpy().reshape(b - a, -1)
                if kind[a] == 0:
                    held.append(x)
                    ids += part.column(3).to_pylist()
                    continue
                if graph is None:
                    points_ = np.concatenate(held)
                    graph = Graph(points_, degree, max(BUILD_BEAM, degree), alpha)
                yield from _answers(graph, points_, ids, part.column(2).to_numpy(), x, k, beam)

    placed = base.unionAll(asked).repartitionById(max(total, 1), F.col("shard")).sortWithinPartitions("shard", "kind")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = placed.mapInArrow(run, _FOUND).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def _answers(graph: Graph, points: np.ndarray, ids: list[list[int]], asked: np.ndarray, q: np.ndarray, k: int, beam: int):
    for i in range(0, len(q), AT_ONCE):
        found, _ = graph.search(q[i:i + AT_ONCE], max(beam, k + 1))
        out: list[tuple[int, int, float]] = []
        for own, x, nodes in zip(asked[i:i + AT_ONCE].tolist(), q[i:i + AT_ONCE], found):
            nodes = nodes[nodes >= 0]
            score = np.sqrt(((points[nodes] - x) ** 2).sum(axis=1))
            each = sorted((s, v) for s, n in zip(score.tolist(), nodes.tolist()) for v in ids[n] if v != own)
            out += [(own, v, s) for s, v in each[:k]]
        cols = list(zip(*out)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())],
                                         ["query_id", "vec_id", "score"])
