"""N-gram Jaccard join: T-occurrence search over inverted lists, DivideSkip inside blocks.

Two texts link when their sets of n-word shingles have Jaccard similarity of at
least ``percent`` hundredths. The join returns each document's component of
links. Steps:

1. Every text becomes the sorted set of its shingles' 64-bit hashes in one
   Arrow pass; equal sets share a ``sid`` (a hash of the set), so copies are one
   from here on, however many there are.
2. Lists, first part. Linked sets x, y share at least ceil(0.8 max(|x|, |y|))
   shingles, so their ``prefixes`` (the |x| - T + l smallest hashes) share at
   least l (``extra`` of the smaller set). The prefix entries
   (hash, sid) of a chunk of documents are sorted into buckets of the hash
   space; one task reads a bucket at a time and keeps the lists that more than
   one sid is on. Of a hash that ``HOT`` sids of a chunk share one entry goes to
   the bucket, so a bucket grows with the chunks, not with a hot group.
3. T-occurrence on those lists: a set on fewer than l shared lists is alone.
   Of the others, dropping the l - 1 longest lists loses no link (long lists
   are only probed, never merged), and each remaining short list is a star
   from its smallest sid (from a node of its own, if it is long). Connected components of the stars are ``blocks``:
   every link lies inside one block. The sentences that the texts of a large corpus have in common put sets into one
   large block that link with none of it. The sets of blocks above ``WHOLE`` sets are therefore listed again with all of
   their shingles, block by block: there a set is on T lists of its block at least, and the T - 1 longest are dropped.
4. The texts of blocks (not of single sets, which a bit set keeps out of the
   shuffle) are read again and searched block by block with whole sets:
   DivideSkip merges the short lists of a query with a heap, skips ahead where
   too few entries remain, and finds the counts of the surviving candidates in
   the long lists by binary search. Where the short lists are so dense that a
   heap has nothing to skip (near copies), their entries are counted in arrays,
   and so are those of the long lists for more than a few candidates.
   A set that an earlier query retrieved asks nothing itself unless a second
   pass needs it: all sets outside a block's largest component are queries, and
   any link between components has an end among them.
5. A block of more than ``BLOCK_SHINGLES`` shingles is dealt to shards that each
   hold a few common centres. The components found there are joined through
   the centres; then all sets outside the block's largest component (in parts
   of bounded size) are searched against every shard. No task holds more than
   a shard and a part.

``links`` and ``join_counted`` find every link between different sets: there each
set of a block asks, in parts of ``ASKED`` queries or more: ``PARTS`` parts, but none
of more than a third of a shard. So a large group of near copies is many tasks, and
a set is sent to one task of each part of its block and one of each shard at most.

All bounds above only place the work; no pair is skipped by them.

Cases: null and empty texts have no shingles and link with nothing; a text of
fewer than n words is one shingle; rows with equal text, equal sets or a
repeated doc_id each get a row; rows with a null doc_id keep their size and
take no part in links; ties and order play no role; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from curbwise.llm.common import drop_garbage, free_name, saved, ship, words

N_WORDS = 5
PERCENT = 80
HOT = 64
CHUNK_ENTRIES = 4_000_000
SLICE = 1 << 16
BLOCK_SHINGLES = 3_000_000
CENTRES = 4
ASKED = 1 << 8
PARTS = 16
WHOLE = 1 << 10
DENSE = 1 << 10
FILTER_BITS = 1 << 26
_ENTRIES = "kind int, bucket int, a binary, b binary"
_LISTS = "sid long, df int, hash long, pivot long"


# --- sets ---------------------------------------------------------------------------------------

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_sets(texts: pa.Array, n: int = N_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; A-Z are lower-cased first."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    words = split.flatten().dictionary_encode()
    names = words.dictionary.cast(pa.large_binary()).to_pylist()
    values = np.fromiter((xxhash.xxh3_64_intdigest(w.lower()) for w in names), np.uint64, len(names))
    flat = values[words.indices.to_numpy()] if len(words) else np.empty(0, np.uint64)
    real = (np.array([len(w) > 0 for w in names], bool)[words.indices.to_numpy()] if len(words) else np.empty(0, bool))
    bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
    bounds = np.concatenate([[0], np.cumsum(real)])[bounds]  # leading or trailing space gives empty words
    flat = flat[real]
    rolled = np.zeros(max(0, len(flat) - n + 1), np.uint64)
    for i in range(n):
        rolled = rolled * _ODD[0] + _mix(flat[i:i + len(rolled)] * _ODD[1 + i % 4])
    rolled = _mix(rolled)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(rolled[a:b - n + 1]))
        elif b > a:
            h = np.array([b - a], np.uint64)
            for i in range(a, b):
                h = _mix(h * _ODD[2] + flat[i:i + 1])
            out.append(h)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def set_id(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def least_overlap(n, percent: int = PERCENT):
    """Shingles that a set of ``n`` shares at least with any set it links to."""
    return -(-n * percent // 100)


def extra(n: int) -> int:
    """l: shared prefix entries asked for; never falls as the set grows.

    Short sets ask for half of their entries, so that a passage of some fifty
    words that many documents share does not make them candidates; for long
    ones a sixteenth and a constant does, and keeps their prefixes short.
    """
    return max(1, min(n // 2, 64 + n // 16))


# --- step 2: lists over prefixes ----------------------------------------------------------------

def _slices(batch: pa.RecordBatch, column: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(size, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _rows(kind: int, bucket, a: list[bytes], b: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kind] * len(a), pa.int32()), pa.array(bucket, pa.int32()), pa.array(a, pa.binary()), pa.array(b, pa.binary())],
                                      ["kind", "bucket", "a", "b"])


def _chunk(hashes: np.ndarray, sids: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Entries of a chunk by bucket (kind 1); the sids of lists that are hot in the chunk but one (kind 2)."""
    order = np.lexsort((sids, hashes))
    hashes, sids = hashes[order], sids[order]
    first = np.flatnonzero(np.diff(hashes, prepend=hashes[0] ^ np.uint64(1)))
    count = np.diff(np.append(first, len(hashes)))
    hot = np.repeat(count >= HOT, count)
    head = np.zeros(len(hashes), bool)
    head[first] = True
    rest = np.flatnonzero(hot & ~head)
    for i in range(0, len(rest), SLICE):
        at = rest[i:i + SLICE]
        yield _rows(2, bucket=[int(hashes[at[0]] % np.uint64(buckets))], a=[hashes[at].tobytes()], b=[sids[at].tobytes()])
    # one sid stands for a hot list, HOT times, so that the bucket sees its length
    kept = ~hot | head
    hashes, sids, weight = hashes[kept], sids[kept], np.where(hot, HOT, 1)[kept].astype(np.uint8)
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    used = np.flatnonzero(np.diff(cuts))
    for i in range(0, len(used), 256):
        some = [slice(cuts[k], cuts[k + 1]) for k in used[i:i + 256]]
        yield _rows(1, bucket=used[i:i + 256], a=[hashes[k].tobytes() for k in some], b=[sids[k].tobytes() + weight[k].tobytes() for k in some])


def _sets(docs: DataFrame, n_words: int) -> DataFrame:
    """doc_id, h (hash of the text), n, sid of every row; sid is null where the row takes no part in links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 1):
                keys, sets = part.column(0).to_pylist(), shingle_sets(part.column(1), n_words)
                sids = [set_id(s) if len(s) and k is not None else None for k, s in zip(keys, sets)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(sids, pa.int64())],
                    ["doc_id", "h", "n", "sid"])

    return docs.select("doc_id", "text", F.xxhash64("text")).mapInArrow(run, "doc_id long, h long, n long, sid long")


def _entries(docs: DataFrame, n_words: int, percent: int, buckets: int, whole: bool = False) -> DataFrame:
    """Prefix entries by bucket of the hash space; with ``whole`` all entries of the sets of blocks
    (doc_id, text, sid, block), in lists of their own for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        hashes: list[np.ndarray] = []
        owners: list[int] = []
        held = 0

        def chunk() -> Iterator[pa.RecordBatch]:
            return _chunk(np.concatenate(hashes), np.repeat(np.array(owners, np.int64), [len(h) for h in hashes]), buckets)

        for batch in batches:
            for part in _slices(batch, 1):
                given = (part.column(i).to_pylist() if whole else [None] * part.num_rows for i in (2, 3))
                for key, s, asked, block in zip(part.column(0).to_pylist(), shingle_sets(part.column(1), n_words), *given):
                    if key is None or not len(s) or (sid := set_id(s)) in seen:
                        continue
                    if not whole:
                        prefix = s[:len(s) - least_overlap(len(s), percent) + extra(len(s))]
                    elif sid == asked:
                        prefix = s ^ _mix(np.array([block], np.int64).view(np.uint64))
                    else:  # another text under a repeated doc_id
                        continue
                    seen.add(sid)
                    hashes.append(_mix(prefix * _ODD[3]))  # small hashes spread over all buckets again
                    owners.append(sid)
                    held += len(prefix)
                if held >= CHUNK_ENTRIES:
                    yield from chunk()
                    seen, hashes, owners, held = set(), [], [], 0
        if held:
            yield from chunk()

    return docs.mapInArrow(run, _ENTRIES)


def _lists(entries: DataFrame) -> DataFrame:
    """sid, df (list length, at most HOT), hash and pivot for each entry of a list with several sids."""

    def batch_of(sid: np.ndarray, df: np.ndarray, h: np.ndarray, pivot: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(sid), pa.array(df.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(pivot)],
                                          ["sid", "df", "hash", "pivot"])

    def of_bucket(parts: list[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        h = np.concatenate([np.frombuffer(a, np.uint64) for a, _ in parts])
        sid = np.concatenate([np.frombuffer(b, np.int64, len(a) // 8) for a, b in parts])
        weight = np.concatenate([np.frombuffer(b, np.uint8, offset=len(a)) for a, b in parts]).astype(np.int64)
        order = np.lexsort((sid, h))
        h, sid, weight = h[order], sid[order], weight[order]
        # a set with copies comes from several chunks, and is on the list once
        one = np.flatnonzero((np.diff(h, prepend=h[0] ^ np.uint64(1)) != 0) | (np.diff(sid, prepend=sid[0]) != 0))
        h, sid, weight = h[one], sid[one], np.maximum.reduceat(weight, one)
        first = np.flatnonzero(np.diff(h, prepend=h[0] ^ np.uint64(1)))
        count = np.diff(np.append(first, len(h)))
        low, high = np.minimum.reduceat(sid, first), np.maximum.reduceat(sid, first)
        df = np.minimum(np.add.reduceat(weight, first), HOT)
        several = (low != high) | (np.maximum.reduceat(weight, first) == HOT)
        # a long list is a node of its own, since not all of its sids are here
        pivot = np.where(df == HOT, h[first].view(np.int64), low)
        keep = np.repeat(several, count)
        if keep.any():
            yield batch_of(sid[keep], np.repeat(df, count)[keep], h[keep], np.repeat(pivot, count)[keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for kind, bucket, a, b in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if bucket != now and parts:
                    yield from of_bucket(parts)
                    parts = []
                now = bucket
                if kind == 1:
                    parts.append((a, b))
                else:
                    h = np.frombuffer(a, np.uint64)
                    yield batch_of(np.frombuffer(b, np.int64), np.full(len(h), HOT), h, h.view(np.int64))
        if parts:
            yield from of_bucket(parts)

    return entries.mapInArrow(run, _LISTS)


# --- step 3: blocks -----------------------------------------------------------------------------

def _are_stars(edges: DataFrame) -> bool:
    """Whether every u of the distinct edges (u, v), v < u, has one edge and is no v."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionAll(edges.select("v", F.lit(0)))
    count = F.sum("up").alias("ups"), F.count(F.lit(1)).alias("all")
    return ends.groupBy("node").agg(*count).filter("ups > 1 OR (ups = 1 AND all > 1)").isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the smallest node of each node's component of the edges (u, v).

    Large-star and small-star in turns until every node has one edge, to a node
    that has none itself; each round is written to the shared folder. Minima are
    combined in the map tasks, so a hub costs no more than its edges.
    """
    spark = edges.sparkSession
    now = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = saved(now, name)
    while not _are_stars(now):
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # saved, so that the join's sides are plain exchanges and Spark splits a hub's edges
        least = saved(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), name)
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        own = least.filter("m < u").select("u", F.col("m").alias("v"))
        large = saved(large.unionAll(own).distinct(), name)
        least = saved(large.groupBy("u").agg(F.min("v").alias("m")), name)  # now every v is smaller than its u
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        now = saved(small.filter("u <> v").distinct(), name)
    drop_garbage(spark)
    roots = now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())


def _stars(lists: DataFrame, sizes: DataFrame, percent: int, whole: bool = False) -> DataFrame:
    """(u, v): each set with the pivots of its short lists, if it is on enough lists to link at all.

    ``whole``: the lists are those of all shingles, not of prefixes.
    """
    # a set's own prefix; the lists that are hot in a chunk may come from several chunks
    on = lists.groupBy("sid").agg(F.sort_array(F.collect_set(F.struct("df", "hash", "pivot"))).alias("on"))
    least = f"cast(ceil(n * {percent} / 100.0) as long)"  # least_overlap, then extra of it
    need = f"cast({least} as int)" if whole else f"cast(greatest(1, least({least} div 2, 64 + {least} div 16)) as int)"
    got = on.join(sizes, "sid").withColumn("need", F.expr(need))
    got = got.filter(F.size("on") >= F.col("need"))
    short = F.slice("on", F.lit(1), F.size("on") - F.col("need") + 1)
    return got.select(F.col("sid").alias("u"), F.explode(F.array_distinct(F.transform(short, lambda x: x["pivot"]))).alias("v"))


# --- step 4: DivideSkip in a block --------------------------------------------------------------

class Block:
    """An inverted index over some sets, and their links under a union-find."""

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT):
        self.sets, self.percent = sets, percent
        self.size = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), self.size)
        flat = np.concatenate(sets)
        token, ids = np.unique(flat, return_inverse=True)
        order = np.argsort(ids, kind="stable")
        self._owner = owner[order]  # the lists one after another, each in order of sets
        self._start = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=len(token)))])
        self._tokens, at = [], 0
        for n in self.size.tolist():
            self._tokens.append(ids[at:at + n])
            at += n
        self.root = list(range(len(sets)))

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.root[max(a, b)] = min(a, b)

    def links(self, x: int) -> list[int]:
        """All sets that link to set ``x``, by DivideSkip."""
        tokens = self._tokens[x]
        length = self._start[tokens + 1] - self._start[tokens]
        tokens = tokens[np.argsort(length, kind="stable")]
        n, longest = len(tokens), int(length.max())
        need = int(least_overlap(n, self.percent))
        # how many of the longest lists are only probed
        probed = min(need - 1, int(need / (0.0085 * np.log2(max(longest, 2)) + 1)))
        lists = [self._owner[self._start[t]:self._start[t + 1]] for t in tokens.tolist()]
        short, long = lists[:n - probed], lists[n - probed:]
        if sum(map(len, short)) > DENSE:
            times = np.bincount(np.concatenate(short), minlength=len(self.sets))
            times[x] = 0
            cand = np.flatnonzero(times >= need - probed)
            count = times[cand]
        else:
            found = _merge_skip([s.tolist() for s in short], need - probed)
            found.pop(x, None)
            cand = np.array(sorted(found), np.int64)
            count = np.array([found[c] for c in cand.tolist()], np.int64)
        if not len(cand):
            return []
        fits = np.maximum(self.size[cand], n) * self.percent <= np.minimum(self.size[cand], n) * 100
        cand, count = cand[fits], count[fits]
        if len(cand) > longest >> 5:  # so many that counting whole lists is less work than searching them
            if long:
                count += np.bincount(np.concatenate(long), minlength=len(self.sets))[cand]
            long = []
        for k, s in enumerate(long):
            left = probed - k
            alive = count + left >= need
            if not alive.all():
                cand, count = cand[alive], count[alive]
            if not len(cand):
                return []
            at = np.searchsorted(s, cand)
            count += s[np.minimum(at, len(s) - 1)] == cand
        linked = 100 * count >= self.percent * (n + self.size[cand] - count)
        return cand[linked].tolist()

    def solve(self, ask: list[int] | None = None) -> None:
        """Joins all linked sets; with ``ask`` only the links of those sets."""
        if ask is not None:
            for x in ask:
                for y in self.links(x):
                    self.join(x, y)
            return
        asked, reached = set(), set()
        for x in range(len(self.sets)):
            if x in reached:
                continue
            asked.add(x)
            got = self.links(x)
            reached.update(got)
            for y in got:
                self.join(x, y)
        groups: dict[int, int] = {}
        for i in range(len(self.sets)):
            r = self.find(i)
            groups[r] = groups.get(r, 0) + 1
        if len(groups) == 1:
            return
        largest = max(groups, key=lambda r: (groups[r], -r))
        rest = [i for i in range(len(self.sets)) if i not in asked and self.find(i) != self.find(largest)]
        self.solve(rest)


def _merge_skip(lists: list[list[int]], need: int) -> dict[int, int]:
    """Owners on at least ``need`` of the sorted lists, with how many: a heap of list heads that skips ahead."""
    found: dict[int, int] = {}
    heap = [(s[0], k, 0) for k, s in enumerate(lists) if s]
    heapq.heapify(heap)
    while len(heap) >= need:
        top = heap[0][0]
        popped = []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap))
        if len(popped) >= need:
            found[top] = len(popped)
            for _, k, i in popped:
                if i + 1 < len(lists[k]):
                    heapq.heappush(heap, (lists[k][i + 1], k, i + 1))
            continue
        while heap and len(popped) < need - 1:  # none of these heads can reach the count before the next top
            popped.append(heapq.heappop(heap))
        if not heap:
            break
        ahead = heap[0][0]
        for _, k, i in popped:
            j = bisect_left(lists[k], ahead, i)
            if j < len(lists[k]):
                heapq.heappush(heap, (lists[k][j], k, j))
    return found


# --- jobs ---------------------------------------------------------------------------------------

def _tasks(batches: Iterator[pa.RecordBatch], n_words: int) -> Iterator[tuple[tuple, dict[int, np.ndarray], set[int], dict[int, int]]]:
    """(key, sets by sid, sids that ask, copies by sid of those held) of each (block, shard, part) with several sets.

    The batches are sorted by key and hold block, shard, part, sid, ask, text; rows that carry a seventh
    column, copies, are held by the shard where it is not null.
    """
    now, sets, ask, held = None, {}, set(), {}
    for batch in batches:
        for part in _slices(batch, 5):
            keys = list(zip(*(part.column(i).to_pylist() for i in range(3))))
            copies = part.column(6).to_pylist() if part.num_columns > 6 else [None] * len(keys)
            for key, sid, asked, s, n in zip(keys, part.column(3).to_pylist(), part.column(4).to_pylist(), shingle_sets(part.column(5), n_words), copies):
                if key != now:
                    if len(sets) > 1:
                        yield now, sets, ask, held
                    now, sets, ask, held = key, {}, set(), {}
                if set_id(s) == sid:  # else another text under a repeated doc_id
                    sets[sid] = s
                    if asked:
                        ask.add(sid)
                    if n is not None:
                        held[sid] = n
    if len(sets) > 1:
        yield now, sets, ask, held


def _search(rows: DataFrame, n_words: int, percent: int, only_asked: bool) -> DataFrame:
    """(block, u, v): the sids of each (block, shard, part) with the smallest of their component there.

    ``rows``: block, shard, part, sid, ask, text. With ``only_asked`` the links of the asked sids alone are searched.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, sets, ask, _ in _tasks(batches, n_words):
            sids = sorted(sets)
            block = Block([sets[s] for s in sids], percent)
            block.solve([i for i, s in enumerate(sids) if s in ask] if only_asked else None)
            roots = [sids[block.find(i)] for i in range(len(sids))]
            yield pa.RecordBatch.from_arrays([pa.array([key[0]] * len(sids), pa.int64()), pa.array(sids, pa.int64()), pa.array(roots, pa.int64())],
                                             ["block", "u", "v"])

    keys = ["block", "shard", "part"]
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys).mapInArrow(run, "block long, u long, v long")


def _filter_bits(members: int) -> int:
    """Places of the bit set: sixteen a member and more, at most ``FILTER_BITS`` (8 MB)."""
    return min(FILTER_BITS, 1 << max(16, (16 * members).bit_length()))


def _only_members(texts: DataFrame, members: DataFrame) -> DataFrame:
    """The texts whose doc_id may be a member's: those of single sets need not be shuffled.

    A bit set goes to the tasks, of 8 MB at most however many members there
    are; texts that pass it by chance fall out in the join.
    """
    size = _filter_bits(members.count())

    def place(doc_id: str):
        return F.pmod(F.xxhash64(doc_id), F.lit(size))

    at = members.select(place("doc_id").alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("b")).toArrow()
    bits = np.zeros(size // 64, np.int64)
    bits[words.column("w").to_numpy()] = words.column("b").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(2).to_numpy(zero_copy_only=False)
            yield batch.select([0, 1]).filter(pa.array((bits[p >> 6] >> (p & 63)) & 1 == 1))

    return texts.filter("doc_id IS NOT NULL").select("doc_id", "text", place("doc_id")).mapInArrow(run, "doc_id long, text string")


def _in_blocks(roots: DataFrame, sets: DataFrame) -> DataFrame:
    """``sets`` (sid, doc_id, n, copies) that share a component of ``roots`` with another, with their ``block``."""
    members = roots.select(F.col("node").alias("sid"), F.col("root").alias("block")).join(sets, "sid")
    several = members.groupBy("block").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1").select("block")
    return members.join(several, "block").select("block", "sid", "doc_id", "n", "copies")


def _blocks(docs: DataFrame, text: str, doc_id: str, n_words: int, percent: int, block_shingles: int,
            whole_from: int = WHOLE) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Steps 1 to 3: the texts of the sets of blocks (and some others), each row's set, one row of each set,
    and the sets of blocks, dealt to shards."""
    spark = docs.sparkSession
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    sets = saved(_sets(texts, n_words), "join-sets")
    reps = sets.filter("sid IS NOT NULL").groupBy("sid").agg(
        F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.count(F.lit(1)).alias("copies"))

    def lists(rows: DataFrame, whole: bool) -> DataFrame:
        return _lists(_entries(rows, n_words, percent, 8 * parts, whole).repartition(parts, "bucket").sortWithinPartitions("bucket"))

    roots = components(_stars(lists(texts, False), reps.select("sid", "n"), percent), "join-blocks")
    members = saved(_in_blocks(roots, reps), "join-members")
    wanted = saved(_only_members(texts, members), "join-texts")
    large = members.groupBy("block").agg(F.count(F.lit(1)).alias("sets")).filter(F.col("sets") > whole_from).select("block")
    of_large = saved(members.join(large, "block"), "join-large")
    if not of_large.isEmpty():
        rows = wanted.join(of_large.select("doc_id", "sid", "block"), "doc_id").select("doc_id", "text", "sid", "block")
        roots = components(_stars(lists(rows, True), of_large.select("sid", "n"), percent, True), "join-whole")
        members = members.join(of_large.select("sid"), "sid", "left_anti").unionByName(_in_blocks(roots, of_large.drop("block")))
    sizes = members.groupBy("block").agg(F.ceil(F.sum("n") / block_shingles).cast("int").alias("shards"))
    members = members.join(sizes, "block").withColumn("shard", F.pmod(F.xxhash64("sid"), F.col("shards")).cast("int"))
    return wanted, sets, reps, saved(members, "join-members")


def join(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n_words: int = N_WORDS, percent: int = PERCENT,
         block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``; further set_id (null: no part in links),
    component (set_id that stands for it) and text_hash."""
    texts, sets, reps, members = _blocks(docs, text, doc_id, n_words, percent, block_shingles)

    def with_text(rows: DataFrame) -> DataFrame:
        return texts.join(rows, "doc_id").select("block", "shard", "part", "sid", "ask", "text")

    plain = members.select("block", "shard", F.lit(0).alias("part"), "sid", F.lit(False).alias("ask"), "doc_id")
    large = members.filter("shards > 1")
    first = Window.partitionBy("block").orderBy(F.xxhash64("sid"), "sid")
    centres = large.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= CENTRES)
    centres = centres.select("block", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.lit(0).alias("part"), "sid",
                             F.lit(False).alias("ask"), "doc_id")
    found = saved(_search(with_text(plain.unionAll(centres)), n_words, percent, False), "join-found")
    if not large.isEmpty():
        found = found.unionAll(_across_shards(large, found, with_text, n_words, percent, block_shingles))
        roots = components(found.select("u", "v"), "join-components")
        roots = roots.select(F.col("node").alias("sid"), "root")
    else:
        roots = found.select(F.col("u").alias("sid"), F.col("v").alias("root"))
    named = reps.join(roots, "sid", "left").select("sid", "doc_id", F.coalesce("root", "sid").alias("root"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "root").select(F.col("sid").alias("set_id"), F.col("root").alias("component"), "component_id")
    got = sets.join(named, sets["sid"] == named["set_id"], "left")
    return got.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
                      "set_id", "component", F.col("h").alias("text_hash"))


def _across_shards(large: DataFrame, found: DataFrame, with_text, n_words: int, percent: int, block_shingles: int) -> DataFrame:
    """Links of the sets outside each large block's largest component, searched against all of its shards."""
    roots = components(found.select("u", "v"), "join-shards").select(F.col("node").alias("sid"), "root")
    named = saved(large.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid")), "join-named")
    counts = named.groupBy("block", "root").agg(F.count(F.lit(1)).alias("c"))
    main = counts.groupBy("block").agg(F.max_by("root", F.struct("c", "root")).alias("main"))
    outside = named.join(main, "block").filter("root <> main").drop("main")
    # a task holds a shard and a part
    some = outside.groupBy("block").agg(F.ceil(3 * F.sum("n") / block_shingles).cast("int").alias("parts"))
    asked = outside.join(some, "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
        F.pmod(F.xxhash64("sid", F.lit(1)), F.col("parts")).cast("int").alias("part"), "sid", F.lit(True).alias("ask"), "doc_id")
    against = named.join(some, "block").select(
        "block", "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "sid", F.lit(False).alias("ask"), "doc_id")
    return saved(_search(with_text(asked.unionAll(against)), n_words, percent, True), "join-across")


def _every_link(texts: DataFrame, members: DataFrame, n_words: int, percent: int, parts: DataFrame, emit, schema: str) -> DataFrame:
    """The rows of ``emit(block, links, held)``, longs, for each task: block, its links (sid, sids) and the copies by sid of its shard.

    Every set of a block asks every shard of it, in the ``parts`` of the block, so a task holds a shard and
    a part, however large the block.
    """
    dealt = members.join(parts, "block").withColumn("own", F.pmod(F.xxhash64("sid", F.lit(2)), F.col("parts")).cast("int"))
    # shards + parts - 1 places: its part in every shard, and its shard's other parts
    dealt = dealt.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("shards") + F.col("parts") - 2)))
    asks = F.col("at") < F.col("shards")
    other = F.col("at") - F.col("shards")
    dealt = dealt.select(
        "block", F.when(asks, F.col("at")).otherwise(F.col("shard")).alias("place"),
        F.when(asks, F.col("own")).otherwise(other + (other >= F.col("own")).cast("int")).alias("part"), "sid", asks.alias("ask"), "doc_id",
        F.when(~asks | (F.col("at") == F.col("shard")), F.col("copies")).alias("held")).withColumnRenamed("place", "shard")
    rows = texts.join(dealt, "doc_id").select("block", "shard", "part", "sid", "ask", "text", "held")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, ...]] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

        for key, those, ask, held in _tasks(batches, n_words):
            sids = sorted(those)
            block = Block([those[s] for s in sids], percent)
            for row in emit(key[0], ((s, [sids[j] for j in block.links(i)]) for i, s in enumerate(sids) if s in ask), held):
                out.append(row)
                if len(out) >= SLICE:
                    yield batch()
                    out = []
        if out:
            yield batch()

    keys = ["block", "shard", "part"]
    width = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(width, *keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _parts(members: DataFrame, asked: int, block_shingles: int) -> DataFrame:
    """Parts of each block's queries: of some ``asked`` sets, ``PARTS`` at most, but none of more than a third of a shard."""
    some = F.least(F.lit(PARTS), F.ceil(F.count(F.lit(1)) / asked))
    return members.groupBy("block").agg(F.greatest(some, F.ceil(3 * F.sum("n") / block_shingles) - 2).cast("int").alias("parts"))


def links(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n_words: int = N_WORDS, percent: int = PERCENT,
          block_shingles: int = BLOCK_SHINGLES, asked: int = ASKED) -> DataFrame:
    """(u, v), u < v: the set_ids of every two different sets that link; ``join`` gives the set_id of each row.

    Rows with equal sets are one here. The result and the work grow with the number of links, which is the
    square of a group of different near copies.
    """
    texts, _, _, members = _blocks(docs, text, doc_id, n_words, percent, block_shingles)

    def emit(block: int, linked, held: dict[int, int]) -> Iterator[tuple[int, ...]]:
        return ((sid, y) for sid, ys in linked for y in ys if y > sid and y in held)

    return _every_link(texts, members, n_words, percent, _parts(members, asked, block_shingles), emit, "u long, v long")


def join_counted(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n_words: int = N_WORDS, percent: int = PERCENT,
                 block_shingles: int = BLOCK_SHINGLES, asked: int = ASKED) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links and n_linked_sets of every row of ``docs``.

    n_links: the other rows that the row links to, copies included; n_linked_sets: the different sets among
    them. Links are counted and joined where they are found, so a task returns rows of its sets, not of its
    links. Rows that take no part in links have 0.
    """
    texts, sets, reps, members = _blocks(docs, text, doc_id, n_words, percent, block_shingles)

    def emit(block: int, linked, held: dict[int, int]) -> Iterator[tuple[int, ...]]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.setdefault(x, x)) != x:
                root[x] = x = root[up]
            return x

        count = {}
        for sid, ys in linked:
            for y in ys:
                a, b = find(sid), find(y)
                root[max(a, b)] = min(a, b)
            near = [held[y] for y in ys if y in held]
            count[sid] = len(near), sum(near)
        return ((block, s, find(s), *count.get(s, (0, 0))) for s in root)

    parts = _parts(members, asked, block_shingles)
    found = saved(_every_link(texts, members, n_words, percent, parts, emit, "block long, sid long, root long, n_sets long, n_rows long"), "join-counted")
    counted = found.groupBy("sid").agg(F.sum("n_sets").alias("n_sets"), F.sum("n_rows").alias("n_rows"), F.min("root").alias("root"))
    several = members.join(parts, "block").filter("shards * parts > 1").select("block").distinct()
    edges = saved(found.join(several, "block", "left_semi").select(F.col("sid").alias("u"), F.col("root").alias("v")), "join-edges")
    if not edges.isEmpty():  # blocks of several tasks
        whole = components(edges, "join-components").select(F.col("node").alias("sid"), F.col("root").alias("whole"))
        counted = counted.join(whole, "sid", "left").withColumn("root", F.coalesce("whole", "root")).drop("whole")
    named = reps.join(counted, "sid", "left").select(
        "sid", "doc_id", F.coalesce("root", "sid").alias("root"), F.coalesce("n_sets", F.lit(0)).alias("n_linked_sets"),
        (F.coalesce("n_rows", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "root").select(F.col("sid").alias("set_id"), "component_id", "n_links", "n_linked_sets")
    got = sets.join(named, sets["sid"] == named["set_id"], "left")
    return got.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
                      *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_links", "n_linked_sets")))


def drop_near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One row of each component stays, that with the smallest doc_id; the columns of ``docs``.

    Rows without shingles or without doc_id are in no component and all stay.
    """
    names = docs.columns
    d, h, r = (free_name(names, n) for n in ("__doc", "__hash", "__row"))
    kept = join(docs, text, doc_id, **options).filter("set_id IS NOT NULL")
    kept = kept.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("k")).select(
        F.col("k.doc_id").alias(d), F.col("k.text_hash").alias(h))
    key, t = F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")
    columns = [F.col(f"`{c}`") for c in names]
    alone = key.isNull() | (F.size(words(t)) == 0)
    rows = docs.filter(~alone).select(*columns, key.alias(d), F.xxhash64(t).alias(h)).join(kept, [d, h], "left_semi")
    # rows that repeat the document: the first by a hash of the row
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    one = Window.partitionBy(d, h).orderBy(F.xxhash64(*hashed))
    rows = rows.withColumn(r, F.row_number().over(one)).filter(F.col(r) == 1)
    return rows.select(*columns).unionAll(docs.filter(alone).select(*columns))
