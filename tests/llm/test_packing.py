import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from corpus_fixtures import clashing, documents
from test_huffman import TEXTS, library

from curbwise.llm import packing


def test_histogram_is_covered_exactly():
    rng = random.Random(1)
    for _ in range(20):
        hist = {rng.randint(1, 64): rng.randint(1, 50) for _ in range(30)}
        got = Counter()
        for lengths, count in packing.shortest_pack_first(hist, 64):
            assert sum(lengths) <= 64 and list(lengths) == sorted(lengths, reverse=True) and count > 0
            for n in lengths:
                got[n] += count
        assert got == Counter(hist)


def test_patterns_do_not_grow_with_documents():
    hist = {n: 10**9 + n for n in range(1, 4097)}
    patterns = packing.shortest_pack_first(hist)
    used = sum(n * c for n, c in hist.items())
    assert len(patterns) < 20_000 and used / (4096 * sum(c for _, c in patterns)) > 0.98


def check(rows, got, capacity):
    want = Counter((r[0], tuple(ids)) for r, ids in zip(rows, library([r[1] for r in rows])))
    sums = Counter()
    for (key, ids), n in want.items():
        for at in range(0, len(ids), capacity):
            part = np.array(ids[at:at + capacity], "<u4")
            sums[key, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += n
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == sums
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= capacity
    assert sorted(by) == list(range(len(by)))


def test_every_id_lies_in_one_piece(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("tok" for _ in range(rng.choice([1, 5, 5, 5, 90])))) for i in range(200)]
    rows += [(1000 + i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (5, "same"), (5, "same")]
    df = clashing(documents(spark, rows))
    check(rows, packing.pack(df).collect(), 4096)
    check(rows, packing.pack(df, capacity=64).collect(), 64)


def test_empty_table(spark):
    assert packing.pack(documents(spark, [])).count() == 0
