"""The edit embedding: the query against a plain walk, distances, near copies against all pairs."""

import hashlib
import random

import numpy as np
import pytest
from corpus_fixtures import clashing, documents, edit, random_text, sf

from curbwise.llm import edit_embedding as ee, queries


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_fingerprint(embedding, text):
    """Step by step from the first steps of all characters, with the smallest random value found directly."""
    points, first = embedding.steps(text)
    out = [0] * ee.COORDINATES
    if not text:
        return bytes(out)
    symbol = np.repeat(points, np.diff(first)).tolist()  # the coordinate of every step
    for k in range(ee.COORDINATES):
        step = max(s for s, of in zip(embedding._steps.tolist(), embedding._of.tolist()) if of == k and s < len(symbol))
        value = ee._mix(ee._mix(np.array([step + 1], np.uint64)) + np.uint64(symbol[step]))[0]
        out[k] = int(value % np.uint64(255)) + 1
    return bytes(out)


def prose(rng, n):
    return " ".join("".join(rng.choice("eeeetttaaooiinnsshhrrdlucmfwygpb") for _ in range(rng.randrange(2, 10))) for _ in range(n))


TEXTS = ["", None, "a", "ab", "Grüße 你好 🙂" * 3, "plain text of some words", "the same", "the same", "x" * 50, "  \n"]


def test_op11_matches_a_plain_version(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i * 3, t) for i, t in enumerate(TEXTS)] + [(100 + i, random_text(rng, rng.randrange(1, 60))) for i in range(40)]
    got = queries.op11_edit_fingerprints(spark, sf(tmp_path, documents=clashing(documents(spark, rows)).repartition(4)))
    assert got.columns[:7] == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert [f.dataType.simpleString() for f in got.schema][:7] == ["bigint", "bigint", "string", "string", "string", "double", "double"]
    embedding = ee.Embedding()
    ordered = sorted(((i, t or "") for i, t in rows), reverse=True)
    want = []
    for (i, t), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        cut = len(t) // 3
        edited = t[:len(t) - cut] + following[:cut]
        a, b, c = (plain_fingerprint(embedding, x) for x in (t, edited, following))
        near = lambda p, q: sum(x == y for x, y in zip(p, q)) / len(p)
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a.hex(), b.hex(), near(a, b), near(a, c)))
    assert sorted(tuple(r)[:7] for r in got.collect()) == sorted(want)


def test_likeness_follows_the_edits(spark):
    rng = random.Random(7)
    embedding = ee.Embedding()
    few, many, other, tail = [], [], [], []
    for _ in range(60):
        a, b = prose(rng, 300), prose(rng, 300)
        few.append(ee.likeness(embedding.fingerprint(a), embedding.fingerprint(edit(rng, a, 3))))
        many.append(ee.likeness(embedding.fingerprint(a), embedding.fingerprint(edit(rng, a, 60))))
        other.append(ee.likeness(embedding.fingerprint(a), embedding.fingerprint(b)))
        tail.append(ee.likeness(embedding.fingerprint(a), embedding.fingerprint(ee.with_head_of_next(a, b))))
    assert np.median(few) > 0.85 and np.mean(few) > 0.75 > np.mean(many) > 1.5 * np.mean(other)
    assert 0.62 < np.mean(tail) < 0.78 and min(tail) > max(other)


def test_a_piece_at_a_time_gives_the_same_steps(monkeypatch):
    text = random_text(random.Random(1), 500)
    whole, mark = ee.Walk().steps(text), ee.Embedding().fingerprint(text)
    monkeypatch.setattr(ee, "_CHUNK", 37)
    parts = ee.Walk().steps(text)
    assert all(np.array_equal(x, y) for x, y in zip(whole, parts)) and np.array_equal(mark, ee.Embedding().fingerprint(text))


def test_sampled_steps_are_spread_evenly():
    embedding = ee.Embedding()
    for steps in (10, 1000, 10**6, 10**9):
        taken = [max(s for s, k in zip(embedding._steps.tolist(), embedding._of.tolist()) if k == c and s < steps) for c in range(ee.COORDINATES)]
        assert 0.38 < np.mean(taken) / steps < 0.62


@pytest.mark.parametrize("seed", range(20))
def test_the_bound_is_never_below_the_distance(seed):
    rng = random.Random(seed)
    a = "".join(rng.choice("abcd ") for _ in range(rng.randrange(80)))
    b = "".join(c if rng.random() < 0.9 else rng.choice(["", "xy", "c"]) for c in a) if seed % 4 else a[::-1]
    d = plain_distance(a, b)
    assert ee.edit_distance(a, b, 80) == d and ee.edit_distance(a, b, d) == d and (not d or ee.edit_distance(a, b, d - 1) is None)
    assert d <= ee.edit_bound(a, b) <= max(len(a), len(b))
    assert ee.edit_bound(a, a) == 0


def test_near_copies_against_all_pairs(spark):
    rng = random.Random(5)
    rows, of = [], {}
    for g in range(12):
        base = prose(rng, 120)
        for c in range(rng.choice([1, 2, 5])):
            of[len(rows)] = g
            rows.append((len(rows), edit(rng, base, c)))
    rows += [(900, rows[0][1]), (900, rows[0][1]), (901, None), (902, ""), (903, None), (None, "no id"), (904, "short"), (905, "shorz")]
    got = {r.doc_id: r.class_id for r in ee.near_copies(clashing(documents(spark, rows)).repartition(3)).collect()}
    least = {}
    for i, g in of.items():
        least.setdefault(g, i)
    assert all(got[i] in [j for j in of if of[j] == g] for i, g in of.items())  # never of another group
    assert sum(got[i] == least[g] for i, g in of.items()) >= 0.95 * len(of)
    assert got[900] == 0 and got[901] == got[902] == got[903] == 901 and got[904] == 904


def test_a_bucket_of_unlike_texts_is_searched_to_its_end(spark, monkeypatch):
    rng = random.Random(8)
    base = [prose(rng, 60) for _ in range(4)]
    rows = [(i, base[i % 4] + (f" {i}" if i > 3 else "")) for i in range(12)]
    monkeypatch.setattr(ee, "BAND", 1)  # every text shares a bucket with others
    got = {r.doc_id: r.class_id for r in ee.near_copies(documents(spark, rows)).collect()}
    assert got == {i: i % 4 for i in range(12)}


def test_empty_table_single_row_and_long_text(spark):
    assert ee.compare_neighbours(documents(spark, [])).count() == 0 and ee.near_copies(documents(spark, [])).count() == 0
    one = ee.compare_neighbours(documents(spark, [(1, "alone in the table")])).first()
    assert one.near_next == 1.0 and one.n_chars == 18
    long = random_text(random.Random(3), 400_000)
    got = {r.doc_id: r for r in ee.compare_neighbours(documents(spark, [(1, long), (2, "short"), (None, "last")])).collect()}
    assert got[1].n_chars == len(long) and 0.55 < got[1].near_edited <= 1.0 and set(got) == {1, 2, None}
