"""Packing documents into sequences: shortest-pack-first over the length histogram.

1. Documents are tokenised and cut into pieces of at most ``capacity`` ids; the
   pieces' small rows (no ids) are written to the shared folder.
2. The histogram of piece lengths (at most ``capacity`` rows) is packed on the
   driver: lengths are placed longest first, each into the pack with the most
   room left, and equal packs are handled together as a pattern with a count.
   The work depends on the number of lengths, not of documents.
3. Each piece gets its rank among the pieces of its length (counts per length
   and salt first, then ranks inside a salt, so a hot length is no single task)
   and the rank names its pattern, its sequence and its offset.

Cases: null text is empty and has the end id alone; a very long text gives many
full pieces; repeated rows are packed each; ties fall to (doc_id, start,
checksum) and equal pieces are interchangeable; null doc_id is kept; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from curbwise.llm.common import saved, ship
from curbwise.llm.tokens import END_ID, WordEncoder, crc, default_path

CAPACITY = 4096
SALTS = 64
#: Text encoded at once; smaller slices than elsewhere, since the pipeline's earlier stages have filled their executors.
SLICE_BYTES = 4 << 20
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PLACED = _PIECE + ", sequence_id long, offset long"
_RANK_BITS = 44


def pieces(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", tokenizer: str | None = None,
           capacity: int = CAPACITY, end_id: int | None = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: one row per piece of at most ``capacity`` ids."""
    path = tokenizer or default_path()
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path, end_id)
        for batch in batches:
            for rows, ids, bounds in encoder.batches(batch, 1, SLICE_BYTES):
                total = np.diff(bounds)
                each = -(-total // capacity)  # pieces of each text
                row = np.repeat(np.arange(len(total)), each)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)) * capacity
                first = bounds[:-1][row] + start
                length = np.minimum(capacity, total[row] - start)
                sums = [crc(ids[a:a + n]) for a, n in zip(first.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(row)), pa.array(start), pa.array(length, pa.int64()),
                     pa.array(sums, pa.int64()), pa.array(total[row])],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
                pa.default_memory_pool().release_unused()  # else a worker process keeps its largest slice's memory

    picked = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return picked.mapInArrow(cut, _PIECE)


def shortest_pack_first(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, longest first) and how often each is used, covering the histogram exactly."""
    room: dict[int, list[list]] = {}  # space left -> [lengths, count]
    widest: list[int] = []  # spaces left in use, ascending

    def put(space: int, lengths: tuple[int, ...], count: int) -> None:
        if space not in room:
            room[space] = []
            i = int(np.searchsorted(widest, space)) if widest else 0
            widest.insert(i, space)
        room[space].append([lengths, count])

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            if not widest or widest[-1] < length:
                put(capacity - length, (length,), left)
                break
            space = widest[-1]
            pack = room[space][-1]
            used = min(left, pack[1])
            pack[1] -= used
            if not pack[1]:
                room[space].pop()
                if not room[space]:
                    del room[space]
                    widest.pop()
            put(space - length, pack[0] + (length,), used)
            left -= used
    return [(lengths, count) for space in sorted(room) for lengths, count in room[space]]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each length its runs of ranks: sorted key (length, first rank), first sequence, offset."""
    filled: dict[int, int] = {}
    rows, base = [], 0
    for lengths, count in patterns:
        offset = 0
        for length in lengths:
            first = filled.get(length, 0)
            rows.append(((length << _RANK_BITS) + first, first, base, offset))
            filled[length] = first + count
            offset += length
        base += count
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return {"key": table[:, 0], "first": table[:, 1], "base": table[:, 2], "offset": table[:, 3]}


def ranked(rows: DataFrame, group: str, order: list[Column], salts: int = SALTS) -> DataFrame:
    """``rows`` with ``rank`` from 0 within ``group``, without gathering a group in one task."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    along = Window.partitionBy(group).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = salted.groupBy(group, "salt").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0))).drop("n")
    inside = Window.partitionBy(group, "salt").orderBy(*order)
    got = salted.join(sizes, [group, "salt"])
    return got.withColumn("rank", F.col("before") + F.row_number().over(inside) - 1).drop("salt", "before")


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", tokenizer: str | None = None,
         capacity: int = CAPACITY, end_id: int | None = END_ID) -> DataFrame:
    """One row per piece with its sequence_id and offset there."""
    cut = saved(pieces(docs, text, doc_id, tokenizer, capacity, end_id), "pack-pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity rows
    table = slots(shortest_pack_first(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy().astype(np.int64) for n in ("length", "rank"))
            at = np.searchsorted(table["key"], (length << _RANK_BITS) + rank, "right") - 1
            sequence = table["base"][at] + rank - table["first"][at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(table["offset"][at])],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    order = [F.col(c) for c in ("doc_id", "start", "ids_crc32")]
    rank = ranked(cut, "length", order).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank")
    return rank.mapInArrow(place, _PLACED)
