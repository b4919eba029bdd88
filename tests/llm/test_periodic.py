"""Periodic run detection against a brute-force search of every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from corpus_fixtures import clashing, documents, random_text, sf, word_list

from curbwise.llm import periodic, queries


def smallest_period(w):
    fail = [0] * len(w)
    k = 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = fail[k - 1]
        k += w[i] == w[k]
        fail[i] = k
    return len(w) - fail[-1]


def brute_runs(w, least=24, times=3):
    out = set()
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q) and smallest_period(w[i:i + length]) == q:
                out.add((i, length, q))
            i = j + 1
    return sorted(out)


def planted(rng, n, letters):
    """Random words with runs of any period, some inside the unit of others."""
    w = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(1, 5)):
        a = rng.randrange(n)
        p = rng.choice([1, 2, 3, 7, 40, 95, 96, 97, 130, 191, 192, 200, 260, 400])
        for i in range(a + p, min(n, a + p * rng.randrange(2, 7) + rng.randrange(p))):
            w[i] = w[i - p]
    if rng.random() < 0.3:  # a unit that is nearly all one word
        a, p = rng.randrange(n // 2), rng.randrange(97, 300)
        for i in range(a, n):
            w[i] = 1 if (i - a) % p else 2
    return w


@pytest.mark.parametrize("seed", range(40))
def test_all_runs_are_found(seed):
    rng = random.Random(seed)
    w = planted(rng, rng.randrange(30, 1500), rng.choice([2, 3, 5, 1000]))
    assert periodic.Sequence(np.array(w)).runs() == brute_runs(w)


def test_runs_of_equal_hashes_are_compared_word_by_word(monkeypatch):
    rng = random.Random(5)
    unit = [rng.randrange(50) for _ in range(120)]
    w = [rng.randrange(50) for _ in range(60)] + unit * 4 + [rng.randrange(50) for _ in range(400)]
    right = periodic.Sequence(np.array(w)).runs()
    monkeypatch.setattr(periodic, "_mix", lambda x: x & np.uint64(6))  # words collide
    assert periodic.Sequence(np.array(w)).runs() == right == brute_runs(w)


def test_a_thue_morse_text_has_no_runs():
    w = [bin(i).count("1") & 1 for i in range(1 << 13)]
    assert periodic.Sequence(np.array(w)).runs() == []


def brute_row(doc_id, text):
    w = word_list(text)
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def test_op13_matches_brute_force(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{x}" for x in planted(rng, rng.randrange(1, 700), rng.choice([2, 40, 900])))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \t\n "), (203, "a"), (204, "b " * 500), (205, rows[3][1]), (205, rows[3][1]),
             (206, "x y z " * 30)]
    got = queries.op13_periodic_runs(spark, sf(tmp_path, documents=clashing(documents(spark, rows)).repartition(5)))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 6 + ["string"] * 2
    have = sorted(map(tuple, got.collect()), key=str)
    assert have == sorted((brute_row(*r) for r in rows), key=str)
    assert sum(r[1] > 0 for r in have) > 40


def test_very_long_text_and_empty_table(spark):
    rng = random.Random(9)
    text = random_text(rng, 60_000, 9000) + " tail" * 200_000
    got = periodic.collapse(documents(spark, [(1, text)])).first()
    assert [tuple(r) for r in got.runs] == [(60_000, 200_000, 1)] and got.collapsed.endswith(" tail") and got.collapsed.count("tail") == 1
    assert periodic.collapse(documents(spark, [])).count() == 0
    assert periodic.collapse(documents(spark, [(None, "a " * 30)])).first().strongest.length == 30
