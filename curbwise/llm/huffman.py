"""Token ids in a compressed block format: canonical length-limited Huffman codes.

Writing: documents are put in ascending doc_id order over range partitions and
tokenised there once; the ids go to the shared folder. Each task counts its ids
as it makes them and puts the counts into one row behind its documents; their
sums are the counts of the whole corpus. The package-merge rule turns them into
code lengths of at most ``MAX_BITS`` bits, and the documents are encoded in
blocks of about ``BLOCK_IDS`` ids. A block is a row of
its own: payload bits, the bit offset of every ``STEP``-th id, and the ids,
starts and sizes of its documents. A document lies in one block.

Reading: the code lengths (one row per id in use) rebuild the decoding table.
Each block is decoded on its own: all of its checkpoints are lanes that walk
the payload side by side, one table look-up per id.

On disk a file set is two Parquet folders, ``codebook`` (id, bits) and
``blocks`` (not compressed again). Block ``start`` is the number of ids before
it in the whole set.

Cases: null text is empty and has the end id alone; null doc_id comes first;
rows of equal doc_id are ordered by a hash of their text, and equal rows are
interchangeable; a very long text is one larger block; an empty table gives a
set without blocks and an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from curbwise.llm.common import scratch, ship
from curbwise.llm.tokens import END_ID, WordEncoder, default_path

MAX_BITS = 20
BLOCK_IDS = 1 << 17
STEP = 128
_IDS = "part int, doc_id long, n long, before long, ids binary"
#: ``n`` of the row that holds a task's counts: 64-bit integers, one per id from 0 on.
_COUNTS = -1
_BLOCK = ("start long, n_ids long, doc_ids array<long>, doc_starts array<long>, doc_sizes array<long>, "
          "checkpoints binary, payload binary")
_DECODED = "doc_id long, start long, n_tokens long, ids binary"


# --- code lengths and codes (one entry per id in use) -------------------------------------------

def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal prefix-code lengths of at most ``max_bits`` for positive counts (package-merge)."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} symbols need more than {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    weights, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        even = len(weights) // 2 * 2
        both = np.concatenate([leaves, weights[:even:2] + weights[1:even:2]])
        rank = np.argsort(both, kind="stable")
        weights = both[rank]
        is_leaf.append(rank < n)
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for level in reversed(is_leaf):  # the cheapest items of a level; its packages pay for twice as many below
        used = int(level[:take].sum())
        lengths[:used] += 1
        take = 2 * (take - used)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, position)."""
    codes = np.zeros(len(lengths), np.int64)
    code, last = -1, 0
    for i in np.argsort(lengths, kind="stable").tolist():
        code = (code + 1) << (int(lengths[i]) - last)
        last = int(lengths[i])
        codes[i] = code
    return codes


class Codebook:
    """Symbols (sorted ids) with their canonical codes; tables for both directions."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, max_bits: int = MAX_BITS):
        self.symbols, self.lengths, self.max_bits = symbols.astype(np.int64), lengths.astype(np.int64), max_bits
        self.codes = canonical_codes(self.lengths)

    def encoder(self) -> tuple[np.ndarray, np.ndarray]:
        top = int(self.symbols[-1]) + 1 if len(self.symbols) else 0
        codes, lengths = np.zeros(top, np.uint64), np.zeros(top, np.int64)
        codes[self.symbols], lengths[self.symbols] = self.codes, self.lengths
        return codes, lengths

    def decoder(self) -> tuple[np.ndarray, np.ndarray]:
        """For every ``max_bits``-bit window the symbol it begins with, and its length."""
        order = np.argsort(self.lengths, kind="stable")
        span = 1 << (self.max_bits - self.lengths[order])
        symbol = np.zeros(1 << self.max_bits, np.uint32)
        size = np.ones(1 << self.max_bits, np.uint8)
        filled = int(span.sum())
        symbol[:filled] = np.repeat(self.symbols[order], span)
        size[:filled] = np.repeat(self.lengths[order], span)
        return symbol, size


# --- blocks -------------------------------------------------------------------------------------

def encode_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """(payload, checkpoints) of a block of ids; bits run from the high end of 64-bit words."""
    size = lengths[ids]
    end = np.cumsum(size)
    at = end - size
    words = np.zeros((int(end[-1]) + 63) // 64 + 1 if len(ids) else 1, np.uint64)
    if len(ids):
        code, word = codes[ids], at >> 6
        room = 64 - (at & 63) - size  # negative: the code runs on into the next word
        part = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[first]] = np.add.reduceat(part, first)
        over = np.flatnonzero(room < 0)
        words[word[over] + 1] += code[over] << (64 + room[over]).astype(np.uint64)
    bits = int(end[-1]) if len(ids) else 0
    return words.byteswap().tobytes()[:(bits + 7) // 8], at[::STEP].astype("<u8").tobytes()


def decode_block(payload: bytes, checkpoints: bytes, n: int, symbol: np.ndarray, size: np.ndarray, max_bits: int) -> np.ndarray:
    """The block's ``n`` ids; every checkpoint is a lane of at most ``STEP`` ids."""
    padded = payload + b"\0" * (16 - len(payload) % 8)
    words = np.frombuffer(padded, ">u8").astype(np.uint64)
    at = np.frombuffer(checkpoints, "<u8").copy()
    out = np.zeros((STEP, len(at)), np.uint32)
    keep = np.uint64(64 - max_bits)
    low, six, one, full = np.uint64(63), np.uint64(6), np.uint64(1), np.uint64(63)
    for k in range(min(STEP, n)):
        if k and (n - k - 1) // STEP + 1 < len(at):  # the last lane has come to its end
            at = at[:(n - k - 1) // STEP + 1]
        word, shift = (at >> six).astype(np.int64), at & low
        window = (words[word] << shift) | ((words[word + 1] >> one) >> (full - shift))
        code = (window >> keep).astype(np.int64)
        out[k, :len(at)] = symbol[code]
        at = at + size[code]
    return out.T.ravel()[:n]


# --- jobs ---------------------------------------------------------------------------------------

def _tokenised(docs: DataFrame, text: str, doc_id: str, path: str, end_id: int | None, narrow: bool) -> DataFrame:
    """Documents in ascending order with their ids and the ids before them in their partition; after them the partition's counts."""
    kind = "<u2" if narrow else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before, part = WordEncoder(path, end_id), 0, TaskContext.get().partitionId()
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for rows, ids, bounds in encoder.batches(batch, 1):
                data = ids.astype(kind).tobytes()
                width = np.dtype(kind).itemsize
                offsets = (bounds * width).astype("<i4")
                body = pa.Array.from_buffers(pa.binary(), rows.num_rows, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(rows.num_rows, part, np.int32)), rows.column(0), pa.array(np.diff(bounds)),
                     pa.array(before + bounds[:-1]), body], ["part", "doc_id", "n", "before", "ids"])
                before += int(bounds[-1])
                counts = _sum(counts, np.bincount(ids))
        if before:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([None], pa.int64()), pa.array([_COUNTS], pa.int64()), pa.array([None], pa.int64()),
                 pa.array([counts.astype("<i8").tobytes()], pa.binary())], ["part", "doc_id", "n", "before", "ids"])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    picked = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    return picked.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, _IDS)


def _sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Counts of two parts, either of which may end earlier."""
    if len(a) < len(b):
        a, b = b, a
    a = a.copy()
    a[:len(b)] += b
    return a


def _count(held: DataFrame) -> dict[int, int]:
    """How often each id occurs, from the tasks' counts; at most one row per id of the vocabulary comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for cell in batch.column(0):
                total = _sum(total, np.frombuffer(cell.as_buffer(), "<i8"))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    counts = held.filter(F.col("n") == _COUNTS).select("ids")
    rows = counts.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    return {r["id"]: r["n"] for r in rows}


def id_type(tokenizer: str, end_id: int | None) -> str:
    """The numpy type that holds every id of the tokenizer file and the end id."""
    from tokenizers import Tokenizer

    largest = max([*Tokenizer.from_file(tokenizer).get_vocab().values(), end_id or 0])
    return "<u2" if largest < 1 << 16 else "<u4"


def write_tokens(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", tokenizer: str | None = None,
                 end_id: int | None = END_ID, max_bits: int = MAX_BITS) -> str:
    """Writes the documents' ids under ``path`` (``codebook`` and ``blocks``) and returns it."""
    spark = docs.sparkSession
    ship(spark)
    kind = id_type(tokenizer or default_path(), end_id)
    path_of_ids = scratch(spark, "huffman-ids")
    _tokenised(docs, text, doc_id, tokenizer or default_path(), end_id, kind == "<u2").write.option(
        "compression", "zstd").parquet(path_of_ids)
    held = spark.read.schema(_IDS).parquet(path_of_ids)
    ids = held.filter(F.col("n") != _COUNTS)
    counts = _count(held)
    symbols = np.array(sorted(counts), np.int64)
    book = Codebook(symbols, code_lengths(np.array([counts[s] for s in symbols.tolist()], np.int64), max_bits), max_bits)
    spark.createDataFrame([(int(s), int(n)) for s, n in zip(book.symbols, book.lengths)], "id long, bits int").coalesce(
        1).write.parquet(f"{path}/codebook")
    totals = {r["part"]: r["n"] for r in ids.groupBy("part").agg(F.sum("n").alias("n")).collect()}  # one row per partition
    first, base = 0, {}
    for part in sorted(totals):
        base[part] = first
        first += totals[part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, lengths = book.encoder()
        for batch in batches:
            part, keys, n, before, data = (batch.column(i) for i in range(5))
            start = before.to_numpy() + np.array([base[p] for p in part.to_pylist()], np.int64)
            n = n.to_numpy()
            # a block ends where its documents no longer follow each other, or when it is full
            full = (np.cumsum(n) - n) // BLOCK_IDS
            new = np.flatnonzero((np.diff(full, prepend=-1) != 0) | (np.concatenate([[-1], (start + n)[:-1]]) != start))
            for a, b in zip(new.tolist(), [*new[1:].tolist(), len(n)]):
                block = np.concatenate([np.frombuffer(c.as_buffer(), kind) for c in data[a:b]])
                payload, checkpoints = encode_block(block, codes, lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([start[a]]), pa.array([len(block)], pa.int64()), pa.array([keys[a:b].to_pylist()], pa.list_(pa.int64())),
                     pa.array([start[a:b]], pa.list_(pa.int64())), pa.array([n[a:b]], pa.list_(pa.int64())),
                     pa.array([checkpoints], pa.binary()), pa.array([payload], pa.binary())],
                    ["start", "n_ids", "doc_ids", "doc_starts", "doc_sizes", "checkpoints", "payload"])

    ids.mapInArrow(run, _BLOCK).write.option("compression", "none").parquet(f"{path}/blocks")
    return path


def read_tokens(spark: SparkSession, path: str, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of every document of a file set."""
    ship(spark)
    rows = sorted((r["id"], r["bits"]) for r in spark.read.schema("id long, bits int").parquet(f"{path}/codebook").collect())
    book = Codebook(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbol, size = book.decoder()
        for batch in batches:
            for i in range(batch.num_rows):
                n_ids, keys, starts, sizes, checkpoints, payload = (batch.column(k)[i] for k in range(1, 7))
                ids = decode_block(payload.as_py(), checkpoints.as_py(), n_ids.as_py(), symbol, size, max_bits)
                sizes = sizes.values.to_numpy()
                offsets = np.concatenate([[0], np.cumsum(sizes)]) * 4
                body = pa.Array.from_buffers(pa.binary(), len(sizes), [
                    None, pa.py_buffer(offsets.astype("<i4").tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
                yield pa.RecordBatch.from_arrays([keys.values, starts.values, pa.array(sizes), body],
                                                 ["doc_id", "start", "n_tokens", "ids"])

    return spark.read.schema(_BLOCK).parquet(f"{path}/blocks").mapInArrow(run, _DECODED)
