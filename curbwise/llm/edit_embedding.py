"""Document fingerprints by a randomised edit embedding, and near copies by bands of them.

A text is read by a random walk that all texts share: at each step the walk stays
on its character or goes on to the next, by a random bit of (step, character), and
the character it stands on at step j is coordinate j of the embedding. Two walks
that stand on the same rest of two texts at the same step stay together, so edits
cost a few unequal coordinates each: edit distance becomes Hamming distance. The
walk ends with the text; its bits come back every ``STATES`` steps.

A fingerprint samples ``COORDINATES`` coordinates, one byte each: a hash of the
step and the character there. For each of them all steps have a shared random
order, and the first step of that order that the walk reaches is taken (positions
of new minima of a random sequence, so only some 30 steps per coordinate are ever
candidates). Texts of different lengths therefore compare mostly the same steps,
and the share of equal bytes estimates the share of equal coordinates of the
longer walk.

Two walks may take long to meet again after an edit, so near copies use the
fingerprints of ``WALKS`` seeds. They are cut into bands of sampled coordinates;
texts that share a band are candidates of the smallest id of the bucket, and those that fail
meet the next smallest, until every bucket is done. A candidate is verified on
whole texts: the characters that two walks leave together are an alignment, whose
cost bounds the edit distance from above; where the least bound of ``WALKS`` walks
is too high, the distance itself is found. Pairs that share no band are not found: the tests measure it. Equal texts are one text throughout.

Cases: null text is empty, and the fingerprint of an empty text is all zeros, which
no other text has; a very long text is walked in pieces; equal doc_ids follow each
other by a hash of the text, then the text; the only row of a table is its own
neighbour; null doc_id comes last; repeated rows give a row each; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from curbwise.llm.common import saved, ship
from curbwise.llm.ngram_join import components
from curbwise.llm.periodic import Sequence

COORDINATES = 128
BAND = 5
STATES = 2048
CLASSES = 64
WALKS = 3
SEED = 11
_CHUNK = 1 << 20
_LAST_STEP = 1 << 52

FINGERPRINTS = "doc_id long, n_chars long, fingerprint binary"
COMPARED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
            "near_edited double, near_next double")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(seed: int, row: int, n: int) -> np.ndarray:
    """n numbers in (0, 1) of a seed and a row."""
    x = np.arange(1, n + 1, dtype=np.uint64) + np.uint64((row << 32) + (seed << 48))
    return ((_mix(x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


class Walk:
    """The walk of one seed: which steps each character of a text takes."""

    def __init__(self, seed: int = SEED):
        bits = _uniform(seed, 1, STATES * CLASSES).reshape(CLASSES, STATES) < 0.5
        bits[:, 0] = True  # so that a walk always goes on
        self._states = states = [[0] * CLASSES + [j] for j in range(STATES)]  # each leads on by the kind of a character
        for c in range(CLASSES):
            goes = np.flatnonzero(np.concatenate([bits[c], bits[c]]))
            after = goes[np.searchsorted(goes, np.arange(STATES))] + 1
            for j, k in enumerate((after % STATES).tolist()):
                states[j][c] = states[k]

    def pieces(self, text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Code points of a piece of the text and the first step of each of them, with the
        first step after the piece at the end."""
        state, base, number = self._states[0], 0, itemgetter(CLASSES)
        for at in range(0, len(text), _CHUNK):
            points = np.frombuffer(text[at:at + _CHUNK].encode("utf-32-le", "surrogatepass"), "<u4")
            kinds = (_mix(points.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(CLASSES - 1)).astype(np.uint8)
            passed = np.fromiter(map(number, accumulate(kinds.tobytes(), getitem, initial=state)), np.int64, len(kinds) + 1)
            steps = base + np.concatenate([[0], np.cumsum((np.diff(passed) - 1) % STATES + 1)])
            state = self._states[int(passed[-1])]
            base = int(steps[-1])
            yield points, steps

    def steps(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """All code points and first steps of a text."""
        parts = list(self.pieces(text)) or [(np.empty(0, np.uint32), np.zeros(1, np.int64))]
        return np.concatenate([p for p, _ in parts]), np.concatenate([s[:-1] for _, s in parts] + [parts[-1][1][-1:]])


class Embedding(Walk):
    """Fingerprints of one seed."""

    def __init__(self, seed: int = SEED, coordinates: int = COORDINATES):
        super().__init__(seed)
        self._size = coordinates
        rows = []
        for k in range(coordinates):
            step, draws = 0, iter(_uniform(seed, 2 + k, 512).tolist())
            u = next(draws)
            while step < _LAST_STEP:
                rows.append((step, k))
                step += 1 + int(min(np.log(next(draws)) / np.log1p(-u), _LAST_STEP))
                u *= next(draws)
        rows.sort()
        self._steps, self._of = np.array(rows, np.int64).T

    def fingerprint(self, text: str) -> np.ndarray:
        """One byte for each coordinate; zeros for the empty text alone."""
        out = np.zeros(self._size, np.uint8)
        for points, first in self.pieces(text):
            a, b = np.searchsorted(self._steps, first[[0, -1]])
            step = self._steps[a:b]
            there = points[np.searchsorted(first, step, "right") - 1].astype(np.uint64)
            value = _mix(_mix(step.astype(np.uint64) + np.uint64(1)) + there)
            out[self._of[a:b]] = (value % np.uint64(255)).astype(np.uint8) + 1  # later steps replace earlier ones
        return out


@lru_cache(maxsize=4)
def _embedding(seed: int, coordinates: int) -> Embedding:
    return Embedding(seed, coordinates)


@lru_cache(maxsize=8)
def _walk(seed: int) -> Walk:
    return Walk(seed)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal coordinates."""
    return float(np.count_nonzero(a == b)) / len(a)


def edit_bound(a: str, b: str, seed: int = SEED, walks: int = WALKS) -> int:
    """At least the edit distance: the cost of the best alignment that the walks give."""
    best = max(len(a), len(b))
    for turn in range(walks):
        (x, x_first), (y, y_first) = _walk(seed + turn).steps(a), _walk(seed + turn).steps(b)
        leaves = x_first[1:] - 1  # the step at which a character of a is left
        there = np.searchsorted(y_first, leaves, "right") - 1
        on = there < len(y)
        on[on] = y[there[on]] == x[on]  # b's walk is left by the same bit at the same step
        gap_x = np.diff(np.concatenate([[-1], np.flatnonzero(on), [len(x)]])) - 1
        gap_y = np.diff(np.concatenate([[-1], there[on], [len(y)]])) - 1
        best = min(best, int(np.maximum(gap_x, gap_y).sum()))
    return best


def edit_distance(a: str, b: str, most: int) -> int | None:
    """The edit distance if it is at most ``most``: the furthest place of each diagonal for 0, 1, 2, ... edits."""
    x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64) for t in (a, b))
    n, m = len(x), len(y)
    if abs(n - m) > most:
        return None
    both = Sequence(np.concatenate([x, [-1], y]))
    both.prepare()
    far = np.array([-1], np.int64)  # places in a of the diagonals -edits .. edits
    for edits in range(most + 1):
        diagonal = np.arange(-edits, edits + 1)
        wide = np.concatenate([[-2, -2], far, [-2, -2]])
        at = np.maximum(np.maximum(wide[1:-1] + 1, wide[:-2]), wide[2:] + 1) if edits else np.array([0])
        at = np.minimum(at, np.minimum(n, m - diagonal))
        on = at >= np.maximum(0, -diagonal)
        i, j = at[on], at[on] + diagonal[on]
        at[on] = i + both.common(i, n + 1 + j, np.minimum(n - i, m - j), 1)
        far = np.where(on, at, -2)
        if abs(m - n) <= edits and far[edits + m - n] >= n:
            return edits
    return None


def _near(a: str, b: str, percent: int, seed: int) -> bool:
    most = (100 - percent) * max(len(a), len(b)) // 100
    return edit_bound(a, b, seed) <= most or edit_distance(a, b, most) is not None


def _picked(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = SEED, coordinates: int = COORDINATES) -> DataFrame:
    """doc_id, n_chars, fingerprint of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _embedding(seed, coordinates).fingerprint
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([of(t).tobytes() for t in texts], pa.binary())],
                ["doc_id", "n_chars", "fingerprint"])

    return _picked(docs, text, doc_id).mapInArrow(run, FINGERPRINTS)


# --- each text with its neighbour ------------------------------------------------------------------

def with_head_of_next(text: str, following: str) -> str:
    """The last third of a text replaced by as much of the start of another (or all of that)."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


_OPEN = COMPARED + ", part int, edge string, text string"


def _compared(doc_id, text: str, mine: np.ndarray, following: str, its: np.ndarray, edit: Callable, of: Callable) -> tuple:
    edited = edit(text, following)
    other = of(edited)
    return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), mine.tobytes(), other.tobytes(), likeness(mine, other), likeness(mine, its))


def compare_neighbours(docs: DataFrame, edit: Callable[[str, str], str] = with_head_of_next, text: str = "text", doc_id: str = "doc_id",
                       seed: int = SEED, coordinates: int = COORDINATES) -> DataFrame:
    """Each text's fingerprint beside that of ``edit(text, next text)``, next by descending doc_id
    (after the last: the first), and its likeness to both.

    The texts are dealt to ranges of doc_id and read in order, so a text meets the next one
    in its task. The first and last text of each range go to the shared folder, and the
    last one of a range meets the first one of the next there: two rows for each range.
    """
    columns = [c.split()[0] for c in _OPEN.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, of, last = TaskContext.get().partitionId(), _embedding(seed, coordinates).fingerprint, None
        for batch in batches:
            rows = []
            for i, (key, body) in enumerate(zip(batch.column(0), batch.column(1))):
                key, body = key.as_py(), body.as_py()
                mark = of(body)
                if last is None:
                    rows.append((key, None, None, mark.tobytes(), None, None, None, part, "first", body))
                else:
                    rows.append((*_compared(*last, body, mark, edit, of), part, None, None))
                last = key, body, mark
            yield batch_of(rows)
        if last is not None:
            yield batch_of([(last[0], None, None, last[2].tobytes(), None, None, None, part, "last", last[1])])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _embedding(seed, coordinates).fingerprint
        for batch in batches:
            for r in batch.to_pylist():
                mine, its = (np.frombuffer(r[c], np.uint8) for c in ("fingerprint", "next_fingerprint"))
                done = _compared(r["doc_id"], r["text"], mine, r["next_text"], its, edit, of)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(done, types)], columns[:7])

    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    ranged = _picked(docs, text, doc_id).repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    got = saved(ranged.mapInArrow(run, _OPEN), "neighbours")
    first = got.filter("edge = 'first'").select("part", F.col("fingerprint").alias("next_fingerprint"), F.col("text").alias("next_text"))
    parts = got.filter("edge = 'first'").select("part")  # one small row for each range
    along = Window.orderBy("part")
    following = parts.select("part", F.coalesce(F.lead("part").over(along), F.first("part").over(along)).alias("next"))
    ends = got.filter("edge = 'last'").select("doc_id", "fingerprint", "text", "part").join(following, "part")
    closing = ends.drop("part").join(first.withColumnRenamed("part", "next"), "next")
    return got.filter("edge is null").select(*columns[:7]).unionByName(closing.mapInArrow(close, COMPARED))


# --- near copies ---------------------------------------------------------------------------------------

def near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = 80, seed: int = SEED) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of its class): documents are linked when they
    share a band and their edit distance is at most 100 - ``percent`` per cent of the longer text."""
    picked = _picked(docs, text, doc_id)
    of_text = picked.withColumn("digest", F.sha2("text", 256))
    texts = of_text.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("text").alias("text")).drop("digest")
    texts = saved(texts.filter("doc_id is not null and text <> ''"), "edit-texts")
    parts = []
    for turn in range(WALKS):
        bands = [F.xxhash64(F.lit(turn), F.lit(b), F.substring("fingerprint", b * BAND + 1, BAND)) for b in range(COORDINATES // BAND)]
        parts.append(fingerprints(texts, seed=seed + turn).select("doc_id", F.explode(F.array(*bands)).alias("band")))
    rows, judged = saved(reduce(DataFrame.unionAll, parts), "edit-bands"), None

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(c).to_pylist() for c in ("u", "v", "text", "other"))
            near = [_near(p, q, percent, seed) for p, q in zip(x, y)]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(near)], ["u", "v", "near"])

    while True:
        centres = rows.groupBy("band").agg(F.min("doc_id").alias("v"), F.max("doc_id").alias("most")).filter("v < most").drop("most")
        held = saved(rows.join(centres, "band").filter("doc_id > v"), "edit-candidates")
        pairs = held.select(F.col("doc_id").alias("u"), "v").distinct()
        if judged is not None:
            pairs = pairs.join(judged.select("u", "v"), ["u", "v"], "left_anti")
        both = pairs.join(texts.withColumnRenamed("doc_id", "u"), "u").join(texts.select(F.col("doc_id").alias("v"), F.col("text").alias("other")), "v")
        new = saved(both.mapInArrow(verify, "u long, v long, near boolean"), "edit-judged")
        judged = new if judged is None else judged.unionAll(new)
        far = judged.filter("not near").select(F.col("u").alias("doc_id"), "v")
        rows = saved(held.join(far, ["doc_id", "v"], "left_semi").select("doc_id", "band"), "edit-bands")
        if rows.isEmpty():
            break
    roots = components(judged.filter("near").select("u", "v"), "edit-components")
    own = of_text.groupBy("digest").agg(F.min("doc_id").alias("node"))
    named = own.join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("class_id"))
    return of_text.select("doc_id", "digest").join(named, "digest").select("doc_id", "class_id")
