"""Periodic run detection in word sequences: multi-scale minimizers and direct lag scans.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and at least ``max(least, 3 * q)`` words that no neighbouring
word extends keeping period q. All runs are found, by two ways:

* Periods below ``SHORT``: the words are compared with themselves at each lag;
  a stretch of equal words long enough is a run.
* Longer periods, one scale for q in [2^t * SHORT, 2^(t+1) * SHORT): k words
  (k = a quarter of the scale) are hashed at every place, and the least hash of
  each window of half the scale is a minimizer. Inside a run the same minimizers
  come back q words later, so pairs of equal minimizers whose distance lies in
  the scale are seeds. A seed is extended both ways by prefix hashes, and the
  result is compared word by word.

Nothing is missed: k words that have a period of k/3 or less lie in a run of a
lower scale and take no part as minimizers. If all places of one unit of a run
were such, the run itself would have that lower period (two overlapping stretches
with small periods share one), so a window with a minimizer stands inside the run,
and again q words later. Two places of the same remaining k words are more than
k/3 apart, so a minimizer has a bounded number of partners in its scale.

The texts of a batch are searched as one sequence with separators that equal
nothing. Work is in map tasks only: nothing is shuffled, and a document is held
by one task.

Cases: null, empty and blank texts have no words, no runs and an empty collapsed
text; a very long text is searched whole; runs of equal exponent are told apart
by start, then period; repeated rows give a row each; null doc_id is kept; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from curbwise.llm.common import ship

LEAST = 24
TIMES = 3
#: Periods below it are found by direct scans. A quarter of it must be LEAST or more.
SHORT = 96
SLICE_BYTES = 4 << 20

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUN_SQL = "struct<start:long,length:long,period:long>"
FOUND = f"doc_id long, n_words long, runs array<{_RUN_SQL}>, strongest {_RUN_SQL}, collapsed string"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sliding(a: np.ndarray, width: int, of: np.ufunc) -> np.ndarray:
    """Minimum or maximum of each window of ``width`` values."""
    n = len(a) - width + 1
    pad = -len(a) % width
    blocks = np.concatenate([a, np.repeat(a[-1:], pad)]).reshape(-1, width)
    ahead = of.accumulate(blocks, axis=1).ravel()
    behind = of.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return of(behind[:n], ahead[width - 1:width - 1 + n])


def _prime_factors(n: int) -> list[int]:
    out, f = [], 2
    while f * f <= n:
        if n % f == 0:
            out.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return out + [n] * (n > 1)


class Sequence:
    """Runs of one sequence of integers."""

    def __init__(self, ids: np.ndarray, least: int = LEAST, times: int = TIMES):
        self.w, self.least, self.times = np.ascontiguousarray(ids, np.int64), least, times
        self.found: set[tuple[int, int, int]] = set()

    def runs(self, longest: int | None = None) -> list[tuple[int, int, int]]:
        """(start, length, period) by start, then period. No run is longer than ``longest``."""
        longest = len(self.w) if longest is None else longest
        for q in range(1, min(SHORT, longest // self.times + 1)):
            self.scan(q)
        scale = SHORT
        if self.times * scale <= longest:
            self.prepare()
        while self.times * scale <= longest:
            for q, start, length in self._seeded(scale):
                if not self._exact(q, start, length):
                    self.scan(q)  # equal hashes of different words
            scale *= 2
        return sorted((s, n, q) for s, n, q in self.found)

    def scan(self, q: int) -> None:
        """All runs of period ``q``, by comparing the words with those q further."""
        equal = np.flatnonzero(self.w[q:] == self.w[:-q])
        need = max(self.least, self.times * q) - q
        if len(equal) < need:
            return
        cut = np.flatnonzero(np.diff(equal) != 1) + 1
        first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(equal)]])
        size = last - first
        for i in np.flatnonzero(size >= need).tolist():
            self._add(q, int(equal[first[i]]), int(size[i]) + q)

    def _add(self, q: int, start: int, length: int) -> None:
        stretch = self.w[start:start + length]
        for f in _prime_factors(q):  # a shorter period of a stretch of 3 q words divides q
            if np.array_equal(stretch[q // f:], stretch[:-(q // f)]):
                return
        self.found.add((start, length, q))

    def _exact(self, q: int, start: int, length: int) -> bool:
        w, end = self.w, start + length
        if not np.array_equal(w[start:end - q], w[start + q:end]):
            return False
        if start and w[start - 1] == w[start - 1 + q] or end < len(w) and w[end] == w[end - q]:
            return False
        self._add(q, start, length)
        return True

    def prepare(self) -> None:
        """Prefix hashes of the sequence, for ``common``."""
        n = len(self.w)
        power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]))
        self._back = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, _INVERSE)]))
        value = _mix(self.w.view(np.uint64) * _BASE + np.uint64(1))
        self._sum = np.concatenate([[np.uint64(0)], np.add.accumulate(value * power[:n])])

    def _of(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self._sum[start + size] - self._sum[start]) * self._back[start]

    def _seeded(self, scale: int) -> list[tuple[int, int, int]]:
        """(period, start, length) from seeds whose period lies in [scale, 2 * scale)."""
        w, n = self.w, len(self.w)
        k, width = scale // 4, scale // 2
        m = n - k + 1
        if m < width:
            return []
        h = _mix(self._of(np.arange(m), k)) >> np.uint64(1)
        inside = np.zeros(m + 1, np.int64)
        for s, length, q in self.found:
            if q <= k // 3 and length >= k:
                inside[s] += 1
                inside[s + length - k + 1] -= 1
        h[np.cumsum(inside[:m]) > 0] = _NEVER
        least = _sliding(h, width, np.minimum)
        edge = np.zeros(width - 1, np.uint64)
        chosen = np.flatnonzero((_sliding(np.concatenate([edge, least, edge]), width, np.maximum) == h) & (h != _NEVER))
        order = np.argsort(h[chosen], kind="stable")
        at, value = chosen[order], h[chosen][order]
        seeds, step = [], 1
        while step < len(at):
            same = (value[step:] == value[:-step]) & (at[step:] - at[:-step] < 2 * scale)
            if not same.any():
                break
            x = at[:-step][same]
            d = at[step:][same] - x
            seeds.append(np.stack([x, d])[:, d >= scale])
            step += 1
        if not seeds:
            return []
        x, d = np.concatenate(seeds, axis=1)
        if not len(x):
            return []
        ahead = self.common(x, x + d, n - x - d, 1)
        behind = self.common(x, x + d, x, -1)
        long = ahead + behind >= (self.times - 1) * d
        got = np.unique(np.stack([d, x - behind, ahead + behind + d], axis=1)[long], axis=0)
        return [tuple(r) for r in got.tolist()]

    def common(self, x: np.ndarray, y: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
        """How many words from x and y on (way 1) or before them (way -1) agree, at most ``most``."""
        low, high = np.zeros(len(x), np.int64), most.astype(np.int64)
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high + 1) // 2
            a, b = (x, y) if way > 0 else (x - mid, y - mid)
            agree = self._of(a, mid) == self._of(b, mid)
            low = np.where(open_ & agree, mid, low)
            high = np.where(open_ & ~agree, mid - 1, high)


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run with the greatest length / period; ties: smallest start, then period."""
    best = runs[0]
    for r in runs[1:]:  # in order of start, period
        if r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def _search(ids: pa.Array, texts: pa.Array, least: int, times: int) -> pa.RecordBatch:
    split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))  # at x20 and x09 to x0D
    words = split.flatten()
    real = pc.greater(pc.binary_length(words), 0)
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    bounds = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])[offsets]
    words = words.filter(real)
    n_words = np.diff(bounds)
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    line = -1 - np.arange(len(codes) + len(n_words), dtype=np.int64)  # separators equal nothing
    line[np.arange(len(codes)) + doc] = codes
    begins = bounds[:-1] + np.arange(len(n_words))
    found = Sequence(line, least, times).runs(int(n_words.max(initial=0)))
    start, length, period = np.array(found, np.int64).reshape(-1, 3).T
    of = np.searchsorted(begins, start, "right") - 1
    dropped = np.zeros(len(line) + 1, np.int64)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, start + length, -1)
    kept = np.cumsum(dropped)[np.arange(len(codes)) + doc] == 0
    cuts = np.concatenate([[0], np.cumsum(kept)])[bounds]
    kept_words = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), words.filter(pa.array(kept)))
    where = np.searchsorted(of, np.arange(len(n_words) + 1))
    rows = pa.StructArray.from_arrays([pa.array(start - begins[of]), pa.array(length), pa.array(period)], fields=list(_RUN))
    best = [None] * len(n_words)
    for i in np.unique(of).tolist():
        a, b = where[i], where[i + 1]
        mine = zip((start[a:b] - begins[i]).tolist(), length[a:b].tolist(), period[a:b].tolist())
        best[i] = dict(zip(("start", "length", "period"), _strongest(list(mine))))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n_words, pa.int64()), pa.ListArray.from_arrays(pa.array(where, pa.int32()), rows),
         pa.array(best, _RUN), pc.binary_join(kept_words, pa.scalar(" ", pa.large_string())).cast(pa.string())],
        ["doc_id", "n_words", "runs", "strongest", "collapsed"])


def collapse(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, n_words, runs (by start, then period), strongest (null without runs) and the
    collapsed text: its words joined by one space without those that a run holds after its
    first unit."""
    if not 1 <= least <= SHORT // 4 or times < 3:
        raise ValueError(f"least must be from 1 to {SHORT // 4} and times 3 or more")
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(size, dtype=np.int64) // SLICE_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    yield _search(batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), least, times)

    picked = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return picked.mapInArrow(run, FOUND)
