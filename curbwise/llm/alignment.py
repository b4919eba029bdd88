"""Cross-tokenizer alignment: where the tokens of two public tokenizers end together.

Tokenizer A is a byte-level BPE file of the tokenizers library, B a piece model
of the sentencepiece library; A sees a space in front of the text, which B adds
itself. For each text the cumulative byte ends of B's tokens go into a dictionary
from end to index, those of A into another; the ends both know, sorted, cut the
two id lists into groups. The links of a group are the pairs of an A and a B
token whose byte ranges overlap: the start and the end of each A token are searched
among the ends and the starts of B's.

Neither tokenizer has tokens that go over a single space between two words into the
next word (for the piece model its file is looked through; if one did, a text would
be one unit), so texts are cut there and each distinct unit is aligned once while a
worker process remembers it. Tests compare with the libraries on whole texts. What it
remembers lies in a few arrays and is bounded; when full it keeps the units of the
texts at hand and forgets the others, which costs time only.

How many links hold a pair of ids is counted over the whole corpus. Documents are
aligned in blocks of ``BLOCK_BYTES`` of text; a block has a dictionary of its
distinct pairs with their counts, and each document its distinct units. Only dictionaries are exchanged by pair, so a pair that every
document holds comes once per block, and the totals return to the blocks the same
way. The aligned blocks are written to the shared folder first: a lost executor
costs no second tokenising.

Cases: null and empty texts, and texts whose bytes a tokenizer does not give back
(B writes a space as U+2581, so texts that hold this character), have no tokens:
zeros and empty lists; a very long text is a block by itself; ids that tie for
the best pair of a B id are all best; repeated rows count each; null doc_id is
kept; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from curbwise.llm.common import saved, ship
from curbwise.llm.tokens import _gather

BYTE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"
BLOCK_BYTES = 4 << 20
KNOWN_CHARS = 2 << 20
_AT_ONCE = 5_000
#: Characters that a tokenizer may count as white space; all others are printing.
_HIDDEN = re.compile(r"[\s\x00-\x20\x7f-\xa0\u180e\u200b]")
_B_BITS = 32  # a pair of ids as one long: A's id above B's

GROUPS = "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>"
_ALIGNED = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "steps array<int>, times array<int>, unit_links array<int>, unit_slots array<int>, "
            "pairs array<long>, totals array<long>, leads boolean")
COUNTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def default_paths() -> tuple[str, str]:
    """The public files of this installation; paths may be given instead everywhere."""
    import public_tokenizers

    return public_tokenizers.path(BYTE_FILE), public_tokenizers.path(PIECE_FILE)


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers with the bytes of each of their ids."""

    def __init__(self, paths: tuple[str, str]):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(paths[0])
        self._a.encode_special_tokens = True  # their strings in a text are ordinary text
        self._b = sentencepiece.SentencePieceProcessor(model_file=paths[1])
        of_char, vocabulary = _byte_of_char(), self._a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(of_char[c] for c in token) if all(c in of_char for c in token) else token.encode()
        self.b_bytes = [self._piece(i) for i in range(self._b.get_piece_size())]
        self.a_size, self.b_size = (np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        # printed ids: A's in a group, A's last of a group, then the same of B's
        self.n_a, self.n_b = len(self.a_bytes), len(self.b_bytes)
        marked = (f"{i}{mark}" for n, marks in ((self.n_a, ",|"), (self.n_b, ",;")) for mark in marks for i in range(n))
        self.marked = pa.array(marked, pa.large_string())
        pieces = map(self._b.id_to_piece, range(len(self.b_bytes)))
        self._apart = not any(re.search("[^▁]▁", p) for p in pieces)  # no piece goes over a space into the next word
        every = np.arange(0x110000, dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
        self._printing = np.ones(len(every), bool)
        self._printing[[ord(c) for c in _HIDDEN.findall(every)]] = False

    def units(self, text: str) -> list[str]:
        """The text cut at single spaces between printing characters; a space before each and
        their tokens one after another are the text's."""
        return self.cut(pa.array([text], pa.large_string()))[0].to_pylist()

    def cut(self, texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
        """The units of all texts (none of them null), one text after another, and the n + 1 bounds of each text's."""
        bounds, data = _buffers(texts)
        cuts = self._spaces(data)
        gap = np.zeros(len(data), bool)
        gap[cuts] = True
        gap[bounds[bounds < len(data)]] = gap[bounds[bounds > 0] - 1] = False  # beside another text
        cuts, body = np.flatnonzero(gap), data[~gap]
        bounds = bounds - np.searchsorted(cuts, bounds)
        ends = np.sort(np.concatenate([cuts - np.arange(len(cuts)), bounds]))
        ends = ends[np.diff(ends, prepend=-1) > 0]  # an empty text has no unit
        return _strings(ends, body), np.searchsorted(ends, bounds)

    def _spaces(self, data: np.ndarray) -> np.ndarray:
        """Where in a text's bytes single spaces between printing characters are."""
        if not self._apart or len(data) < 3:
            return np.zeros(0, np.int64)
        plain = data.max() < 0x80
        points = data if plain else np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        shown = self._printing[points]
        at = 1 + np.flatnonzero((points[1:-1] == 32) & shown[:-2] & shown[2:])
        return at if plain else np.flatnonzero((data & 0xC0) != 0x80)[at]

    def printing(self, units: pa.LargeStringArray) -> np.ndarray:
        """Whether the first and the last character of each unit are printing."""
        bounds, data = _buffers(units)
        first, last = data[bounds[:-1]], data[bounds[1:] - 1]
        out = self._printing[first] & self._printing[last]
        for i in np.flatnonzero((first >= 0x80) | (last >= 0x80)).tolist():
            unit = units[i].as_py()
            out[i] = self._printing[ord(unit[0])] and self._printing[ord(unit[-1])]
        return out

    def _piece(self, i: int) -> bytes:
        if self._b.is_byte(i):
            return bytes([int(self._b.id_to_piece(i)[1:-1], 16)])
        return self._b.id_to_piece(i).replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of A and B of each text; none where the bytes do not come back."""
        for text, a, b in zip(texts, self._a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False),
                              self._b.encode(texts, num_threads=1)):
            a, said = a.ids, b" " + text.encode()
            whole = text and b"".join(map(self.a_bytes.__getitem__, a)) == said == b"".join(map(self.b_bytes.__getitem__, b))
            yield (a, b) if whole else ([], [])


class Alignment:
    """One text's groups: A's tokens a_cut[g]:a_cut[g+1] and B's b_cut[g]:b_cut[g+1]."""

    def __init__(self, a: list[int], b: list[int], known: Tokenizers):
        self.a, self.b, self._known = np.array(a, np.int64), np.array(b, np.int64), known
        self.a_end, self.b_end = np.cumsum(known.a_size[self.a]), np.cumsum(known.b_size[self.b])
        a_at = dict(zip(self.a_end.tolist(), range(1, len(a) + 1)))
        b_at = dict(zip(self.b_end.tolist(), range(1, len(b) + 1)))
        self.common = sorted(a_at.keys() & b_at.keys())
        self.a_cut = np.array([0, *map(a_at.__getitem__, self.common)], np.int64)
        self.b_cut = np.array([0, *map(b_at.__getitem__, self.common)], np.int64)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the linked A and B tokens, in order of A's: from the first token of B that
        ends behind the start of A's to the last that starts before its end."""
        a_start, b_start = self.a_end - self._known.a_size[self.a], self.b_end - self._known.b_size[self.b]
        first = np.searchsorted(self.b_end, a_start, "right")
        n = np.searchsorted(b_start, self.a_end, "left") - first
        return np.repeat(np.arange(len(n)), n), np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)

    def printed(self) -> pa.LargeStringArray:
        """``a1,`` ``a2|`` ``b1;`` ...: the groups' ids in order, each with the mark after it."""
        known = self._known
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[self.a_cut[1:] - 1], last_b[self.b_cut[1:] - 1] = 1, 1
        line = np.empty(len(self.a) + len(self.b), np.int64)
        line[np.arange(len(self.a)) + np.repeat(self.b_cut[:-1], np.diff(self.a_cut))] = self.a + last_a * known.n_a
        line[np.arange(len(self.b)) + np.repeat(self.a_cut[1:], np.diff(self.b_cut))] = self.b + last_b * known.n_b + 2 * known.n_a
        return known.marked.take(pa.array(line))


class Units:
    """Alignments of the units of texts, kept while their characters stay below ``KNOWN_CHARS``."""

    def __init__(self, paths: tuple[str, str]):
        self.known = Tokenizers(paths)
        self._names = self._printed = pa.array([], pa.large_string())  # a unit's groups, a mark after the last too
        self._shape = np.empty((0, 4), np.int32)  # tokens of A and B, groups, links of each unit; zeros where the bytes do not come back
        self._codes = np.empty(0, np.int64)  # linked pairs of ids, a code per link, unit after unit

    def of(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of A and B, groups and links of each of ``units``, and the codes of all their links."""
        size = self._shape[:, 3].astype(np.int64)
        return self._shape[units].astype(np.int64), _gather(self._codes, (np.cumsum(size) - size)[units], size[units])

    def printed(self, units: np.ndarray) -> np.ndarray:
        """The groups of ``units`` as the bytes of a text."""
        return _buffers(self._printed.take(pa.array(units)))[1][:-1]

    def numbers(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """The units of all texts, one text after another, and the n + 1 bounds of each text's; none
        where a tokenizer does not give the text back. They hold until the next call."""
        units, bounds = self.known.cut(texts)
        units = units.dictionary_encode()
        at = self._places(units.dictionary)
        row = at[units.indices.to_numpy()]
        whole = np.diff(np.concatenate([[0], np.cumsum(self._shape[row, 0] == 0)])[bounds]) == 0
        n = np.diff(bounds)
        return row[np.repeat(whole, n)], np.concatenate([[0], np.cumsum(n * whole)])

    def _places(self, units: pa.LargeStringArray) -> np.ndarray:
        """The numbers of different ``units``; those not known yet are aligned."""
        found = pc.index_in(units, value_set=self._names)
        new, at = pc.is_null(found).to_numpy(zero_copy_only=False), pc.fill_null(found, 0).to_numpy().copy()
        if new.any():
            if (pc.sum(pc.utf8_length(self._names)).as_py() or 0) > KNOWN_CHARS:
                at[~new] = self._keep(at[~new])
            at[new] = self._learn(units.filter(pa.array(new)))
        return at

    def _keep(self, at: np.ndarray) -> np.ndarray:
        """Forgets all units but those at the different places ``at``; their new places."""
        shape, self._codes = self.of(at)
        self._shape, at = shape.astype(np.int32), pa.array(at)
        self._names, self._printed = self._names.take(at), self._printed.take(at)
        return np.arange(len(at))

    def _learn(self, units: pa.LargeStringArray) -> np.ndarray:
        """Aligns units not known yet; their places."""
        known, inside = len(self._names), self.known.printing(units)
        whole, rest = (units.filter(pa.array(x)).to_pylist() for x in (inside, ~inside))
        got = [part for i in range(0, len(whole), _AT_ONCE) for part in self._aligned(whole[i:i + _AT_ONCE])]
        for unit in rest:  # begins or ends with white space, so nothing can be beside it
            got += self._aligned([unit])
        shapes, codes, printed = zip(*got)
        self._names = pa.concat_arrays([self._names, pa.array(whole + rest, pa.large_string())])
        self._shape, self._codes = np.concatenate([self._shape, *shapes]), np.concatenate([self._codes, *codes])
        self._printed = pa.concat_arrays([self._printed, *printed])
        return known + np.where(inside, np.cumsum(inside), len(whole) + np.cumsum(~inside)) - 1

    def _aligned(self, units: list[str]) -> list[tuple[np.ndarray, np.ndarray, pa.LargeStringArray]]:
        """Shapes, codes and printed groups of the units, aligned as one text with a space before each."""
        (a, b), = self.known.encode([" ".join(units)])
        if not a and len(units) == 1:
            return [(np.zeros((1, 4), np.int32), np.empty(0, np.int64), pa.array([""], pa.large_string()))]
        if not a:
            return [part for half in (units[:len(units) // 2], units[len(units) // 2:]) for part in self._aligned(half)]
        got = Alignment(a, b, self.known)
        ends = np.cumsum([1 + len(u.encode()) for u in units])
        cuts = [np.searchsorted(x, ends, "right") for x in (got.a_end, got.b_end, got.common)]
        left, right = got.links()
        shape = np.diff(np.stack([*cuts, np.searchsorted(left, cuts[0])]), prepend=0).T.astype(np.int32)
        bounds, marked = _buffers(got.printed())
        return [(shape, (got.a[left] << _B_BITS) + got.b[right], _strings(bounds[np.concatenate([[0], cuts[0] + cuts[1]])], marked))]


@lru_cache(maxsize=2)
def _units(paths: tuple[str, str]) -> Units:
    return Units(paths)


def _buffers(strings: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The n + 1 bounds of the strings' bytes, and these bytes."""
    bounds = np.frombuffer(strings.buffers()[1] or bytes(8), np.int64)[strings.offset:strings.offset + len(strings) + 1]
    return bounds - bounds[0], np.frombuffer(strings.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]


def _strings(bounds: np.ndarray, data: np.ndarray) -> pa.LargeStringArray:
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def _slices(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Array, pa.LargeStringArray]]:
    """doc_ids and texts (null: empty) of consecutive rows of about ``limit`` bytes of text."""
    parts, held = [], 0
    for batch in batches:
        size, begun = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist(), 0
        for i, n in enumerate(size):
            if held and held + n > limit:
                yield _rows([*parts, batch.slice(begun, i - begun)])
                parts, held, begun = [], 0, i
            held += n
        parts.append(batch.take(pa.array(np.arange(begun, batch.num_rows))))  # a slice would hold the whole batch
    if any(part.num_rows for part in parts):
        yield _rows(parts)


def _rows(parts: list[pa.RecordBatch]) -> tuple[pa.Array, pa.LargeStringArray]:
    texts = pa.concat_arrays([part.column(1).cast(pa.large_string()) for part in parts])
    return pa.concat_arrays([part.column(0) for part in parts]), pc.fill_null(texts, "")


def _picked(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", paths: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, the ids of both tokenizers, and for each group the number of A's and B's tokens up to its end."""
    paths = paths or default_paths()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _slices(batches, BLOCK_BYTES):
            known = _units(paths).known
            got = [Alignment(a, b, known) for a, b in known.encode(texts.to_pylist())]
            lists = ([x.a for x in got], [x.b for x in got], [x.a_cut[1:] for x in got], [x.b_cut[1:] for x in got])
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, pa.list_(pa.int32())) for x in lists)],
                                             ["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"])

    return _picked(docs, text, doc_id).mapInArrow(run, GROUPS)


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def _block(ids: pa.Array, texts: pa.LargeStringArray, units: Units, number: int) -> pa.RecordBatch:
    """A row per document with its distinct units; the first row also has the block's dictionary:
    the distinct pairs of ids with their counts, and the pairs of each distinct unit."""
    rows, ends = units.numbers(texts)
    shown = [hashlib.sha256(units.printed(rows[a:b])).hexdigest() if b > a else "" for a, b in zip(ends.tolist(), ends[1:].tolist())]
    used, local = np.unique(rows, return_inverse=True)
    shape, codes = units.of(used)
    totals = np.stack([np.diff(np.concatenate([[0], np.cumsum(x[local])])[ends]) for x in shape.T])
    pairs, slot = np.unique(codes, return_inverse=True)
    n_links = shape[:, 3]
    count = np.bincount(slot, np.repeat(np.bincount(local, minlength=len(used)), n_links), len(pairs)).astype(np.int64)
    lines = np.arange(len(ids) + 1) * len(used)  # a document's units are the numbers from its line to the next
    own, times = np.unique(np.repeat(lines[:-1], np.diff(ends)) + local, return_counts=True)
    bounds = np.searchsorted(own, lines)
    steps = np.diff(own, prepend=0)
    begins = bounds[:-1][np.diff(bounds) > 0]
    steps[begins] = own[begins] - lines[:-1][np.diff(bounds) > 0]
    first = np.arange(len(ids) + 1) > 0
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(ids), number)), ids, *(pa.array(c, pa.int64()) for c in totals), pa.array(shown),
         _lists(steps, bounds, pa.int32()), _lists(times, bounds, pa.int32()),
         _lists(n_links, first * len(used), pa.int32()), _lists(slot, first * len(slot), pa.int32()),
         _lists(pairs, first * len(pairs), pa.int64()), _lists(count, first * len(pairs), pa.int64()),
         pa.array(np.arange(len(ids)) == 0)],
        ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "steps", "times", "unit_links", "unit_slots", "pairs", "totals", "leads"])


def _aligned(docs: DataFrame, text: str, doc_id: str, paths: tuple[str, str] | None) -> DataFrame:
    paths = paths or default_paths()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for ids, texts in _slices(batches, BLOCK_BYTES):
            yield _block(ids, texts, _units(paths), number)
            number += 1
            pa.default_memory_pool().release_unused()  # else a worker process keeps its largest block's memory

    return saved(_picked(docs, text, doc_id).mapInArrow(run, _ALIGNED), "aligned")


def _of_blocks(aligned: DataFrame) -> DataFrame:
    """block, slot, pair, n: the blocks' dictionaries, a row per entry."""
    entry = F.posexplode(F.arrays_zip("pairs", "totals")).alias("slot", "entry")
    return aligned.filter(F.size("pairs") > 0).select("block", entry).select("block", "slot", F.col("entry.pairs").alias("pair"), F.col("entry.totals").alias("n"))


def _counted(entries: DataFrame) -> DataFrame:
    """pair, total, best: links that hold the pair, and whether no other pair of its B id has more."""
    total = entries.groupBy("pair").agg(F.sum("n").alias("total"))
    total = saved(total.withColumn("b", F.col("pair").bitwiseAND((1 << _B_BITS) - 1)), "pair-totals")
    most = total.groupBy("b").agg(F.max("total").alias("most"))
    return total.join(most, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def pair_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", paths: tuple[str, str] | None = None) -> DataFrame:
    """a_id, b_id, links, best: one row per pair of ids that any link of the corpus holds."""
    got = _counted(_of_blocks(_aligned(docs, text, doc_id, paths)))
    return got.select(F.shiftright("pair", _B_BITS).alias("a_id"), F.col("pair").bitwiseAND((1 << _B_BITS) - 1).alias("b_id"),
                      F.col("total").alias("links"), "best")


def counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", paths: tuple[str, str] | None = None) -> DataFrame:
    """Per document its tokens, groups and links, the links whose pair is the most frequent of its
    B id (``n_best``), and the sum over its links of their pairs' counts in the corpus."""
    aligned = _aligned(docs, text, doc_id, paths)
    entries = _of_blocks(aligned)
    back = entries.join(_counted(entries), "pair").select("block", "slot", "total", "best")
    own = [c for c in aligned.columns if c not in ("block", "pairs", "totals", "leads")]
    told = back.select("block", "slot", *[F.lit(None).cast(aligned.schema[c].dataType).alias(c) for c in own], "total", "best")
    after = F.lit((1 << 31) - 1) - F.col("leads").cast("int")  # behind all slots, the row with the units first
    rows = aligned.select("block", after.alias("slot"), *own, F.lit(None).cast("long").alias("total"), F.lit(None).cast("boolean").alias("best"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, entries_, units = None, [], None
        for batch in batches:
            block = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                part = batch.slice(a, b - a)
                if b > a and block[a] != now:
                    now, entries_, units = block[a], [], None
                entry = part.filter(pc.is_valid(part.column("total")))
                if entry.num_rows:
                    entries_.append([entry.column(c).to_numpy(zero_copy_only=False) for c in ("total", "best")])
                mine = part.filter(pc.is_null(part.column("total")))
                if mine.num_rows:
                    if units is None:
                        total, best = (np.concatenate([e[i] for e in entries_] or [[]]).astype(np.int64) for i in (0, 1))
                        units, entries_ = _sums(mine.slice(0, 1), total, best), []
                    yield _finished(mine, *units)

    ordered = told.unionAll(rows).repartition("block").sortWithinPartitions("block", "slot")
    return ordered.mapInArrow(run, COUNTS)


def _sums(lead: pa.RecordBatch, total: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each unit of a block the sum of its links' counts and the number of its best links."""
    slot = lead.column("unit_slots").flatten().to_numpy()
    ends = np.concatenate([[0], np.cumsum(lead.column("unit_links").flatten().to_numpy(), dtype=np.int64)])
    return tuple(np.diff(np.concatenate([[0], np.cumsum(x[slot])])[ends]) for x in (total, best))


def _finished(rows: pa.RecordBatch, count_sum: np.ndarray, n_best: np.ndarray) -> pa.RecordBatch:
    steps, times = rows.column("steps"), rows.column("times")
    bounds = steps.offsets.to_numpy() - steps.offsets[0].as_py()
    line, n = np.cumsum(steps.flatten().to_numpy(), dtype=np.int64), times.flatten().to_numpy().astype(np.int64)
    unit = line - np.repeat(np.concatenate([[0], line])[bounds[:-1]], np.diff(bounds))
    of = lambda x: pa.array(np.diff(np.concatenate([[0], np.cumsum(n * x[unit])])[bounds]), pa.int64())
    return pa.RecordBatch.from_arrays(
        [*(rows.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), of(n_best), of(count_sum), rows.column("groups_sha256")],
        ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
