"""Token ids of whole texts with a public tokenizer file, through the distinct words of a batch.

For a tokenizer whose pre-tokenizer removes white space and parts letters from
punctuation, a text's ids are the ids of its words one after another. The words
of a batch of texts are made distinct first, then their units (a lower-cased
word without its trailing punctuation, and that punctuation). A worker process
keeps the ids of units it has met, so only new ones go through the library;
the ids of the texts are then gathered in whole arrays. The store is bounded; when
full it keeps the units of the texts at hand and forgets the others, which costs
time only. ``tests/llm`` compares the result with the library on whole texts.

Cases: a null or empty text has no ids but the end id, where one is given; a very
long text is encoded whole, in a slice of its own if need be; repeated rows are encoded
each; an empty batch gives nothing; columns beside the text pass through.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KNOWN_UNITS = 500_000
BATCH_BYTES = 8 << 20
DEFAULT_FILE = "word_bpe_49k.json"
END_ID = 2
#: ASCII punctuation that ends a run of letters; the apostrophe may begin a contraction.
_TAIL = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
_AT_ONCE = 2_000


def default_path() -> str:
    """The public tokenizer file of this installation; a path may be given instead everywhere."""
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_FILE)


def _whole_run(unit: str) -> bool:
    """One run of letters for the pre-tokenizer, whatever its neighbours."""
    return unit.isalpha() and (unit.isascii() or unit.lower().isalpha() and unicodedata.is_normalized("NFC", unit))


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[starts[i] : starts[i] + sizes[i]] for every i, one after another."""
    shift = starts - (np.cumsum(sizes) - sizes)
    return flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]


class _Units:
    """Ids of units of one tokenizer file, kept for the life of the worker process."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        self._known = pa.array([], pa.large_string())
        self._ids = np.empty(0, np.uint32)
        self._starts = np.empty(0, np.int64)
        self._sizes = np.empty(0, np.int64)

    def _keep(self, at: pa.Array) -> None:
        """Forgets all units but those at the places ``at``."""
        self._known = self._known.take(at)
        at = at.to_numpy()
        self._ids = _gather(self._ids, self._starts[at], self._sizes[at])
        self._sizes = self._sizes[at]
        self._starts = np.cumsum(self._sizes) - self._sizes

    def _encode(self, units: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The units in the order they were encoded, all their ids, and the number of ids of each."""
        runs, rest, order, ids, sizes = [], [], [], [], []
        for u in units:
            (runs if _whole_run(u) else rest).append(u)
        for i in range(0, len(runs), _AT_ONCE):
            some = runs[i:i + _AT_ONCE]
            got = self._tok.encode(" ".join(some), add_special_tokens=False)
            at = np.asarray(got.word_ids, np.int64)
            if not len(at) or at[-1] != len(some) - 1:  # not one run each after all
                rest += some
                continue
            order += some
            ids.append(np.asarray(got.ids, np.uint32))
            sizes.append(np.bincount(at, minlength=len(some)))
        for i in range(0, len(rest), _AT_ONCE):  # the library's results are many times larger than the ids
            got = [e.ids for e in self._tok.encode_batch_fast(rest[i:i + _AT_ONCE], add_special_tokens=False)]
            ids.append(np.fromiter(chain.from_iterable(got), np.uint32))
            sizes.append(np.fromiter(map(len, got), np.int64, len(got)))
        return order + rest, np.concatenate(ids or [np.empty(0, np.uint32)]), np.concatenate(sizes or [np.empty(0, np.int64)])

    def find(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of distinct ``units`` are: all ids, first position and number of each."""
        at = pc.index_in(units, value_set=self._known)
        if at.null_count and len(self._known) + at.null_count > KNOWN_UNITS:
            self._keep(at.drop_null())
            at = pc.index_in(units, value_set=self._known)
        if at.null_count:
            names, ids, sizes = self._encode(units.filter(pc.is_null(at)).to_pylist())
            self._starts = np.concatenate([self._starts, len(self._ids) + np.cumsum(sizes) - sizes])
            self._sizes = np.concatenate([self._sizes, sizes])
            self._ids = np.concatenate([self._ids, ids])
            self._known = pa.concat_arrays([self._known, pa.array(names, pa.large_string())])
            at = pc.index_in(units, value_set=self._known)
        at = at.to_numpy(zero_copy_only=False)
        return self._ids, self._starts[at], self._sizes[at]


def _parts(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Each word as a head and a (mostly empty) tail whose ids follow each other."""
    whole = pc.or_(pc.match_substring(words, "<|"), pc.match_substring(words, "'"))  # may hold a special token or a contraction
    low = pc.ascii_lower(words)
    head = pc.ascii_rtrim(low, _TAIL)
    cut = pc.and_(pc.and_not(pc.less(pc.binary_length(head), pc.binary_length(low)), whole),
                  pc.match_substring_regex(head, "[a-z]$"))
    size = pc.binary_length(head).to_numpy(zero_copy_only=False)
    tail = pc.if_else(cut, _after(low, size), "")
    return pc.if_else(cut, head, pc.if_else(whole, words, low)), tail


def _after(words: pa.Array, size: np.ndarray) -> pa.Array:
    """Each word without its first ``size`` bytes."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    kept = np.diff(offsets) - size
    new = np.concatenate([[0], np.cumsum(kept)]).astype(np.int64)
    body = _gather(data, offsets[:-1] + size, kept)
    return pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(new), pa.py_buffer(np.ascontiguousarray(body)))


_BY_PATH: dict[str, _Units] = {}


class WordEncoder:
    """Unsigned 32-bit ids of texts, the end id appended to each."""

    def __init__(self, path: str, end_id: int | None = END_ID):
        if path not in _BY_PATH:
            _BY_PATH[path] = _Units(path)
        self._units = _BY_PATH[path]
        self._end = end_id

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts and the n + 1 bounds of each text's ids."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        split = pc.ascii_split_whitespace(texts)  # at x20 and x09 to x0D
        words = split.flatten().dictionary_encode()
        head, tail = _parts(words.dictionary)
        units = pa.concat_arrays([head, tail]).dictionary_encode()
        ids, starts, sizes = self._units.find(units.dictionary)
        of = units.indices.to_numpy().reshape(2, -1).T.ravel()  # head, tail of word 0, of word 1, ...
        word_ids = _gather(ids, starts[of], sizes[of])
        word_sizes = sizes[of].reshape(-1, 2).sum(axis=1)
        word_starts = np.cumsum(word_sizes) - word_sizes
        at = words.indices.to_numpy()
        each = word_sizes[at]
        flat = _gather(word_ids, word_starts[at], each)
        bounds = np.concatenate([[0], np.cumsum(each)])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        if self._end is not None:
            flat = np.insert(flat, bounds[1:], self._end)
            bounds = bounds + np.arange(len(bounds))
        return flat.astype("<u4", copy=False), bounds

    def batches(self, batch: pa.RecordBatch, text: int,
                at_once: int | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        """(rows, ids, bounds) of slices of ``batch`` with about ``at_once`` (``BATCH_BYTES``) bytes of text each."""
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(size, dtype=np.int64) // (at_once or BATCH_BYTES)
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                rows = batch.slice(a, b - a)
                yield rows, *self.encode(rows.column(text))


def crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.tobytes())
