import random
from collections import defaultdict
from fractions import Fraction

from corpus_fixtures import clashing, documents, random_text, word_list

from curbwise.llm import mixing


def fill(sizes, weights=(1, 2, 3), cap=3):
    """Targets by clamping and resharing until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    rest, free, out = Fraction(sum(sizes.values())), list(names), {}
    while free:
        level = rest / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > cap * sizes[s]]
        if not over:
            return out | {s: level * w[s] for s in free}
        for s in over:
            out[s] = Fraction(cap * sizes[s])
            rest -= out[s]
            free.remove(s)
    return out


def corpus(seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        s = rng.choice(["a"] * 130 + ["b", "é", "ab", "", "z", None] * 8 + ["tiny"])
        rows.append((i, None if i % 41 == 0 else random_text(rng, rng.choice([0, 1, 5, 20, 300])), "en", s))
    return rows + [(7, "one two", "en", "b"), (7, "one two", "en", "b"), (None, "x y z", "en", "b"), (500, "v " * 20000, "en", "z"), (501, "", "en", "blank")]


def test_targets_and_taken(spark):
    rows = corpus()
    got = [r.asDict() for r in mixing.mix(clashing(documents(spark, rows))).collect()]
    size = defaultdict(int)
    for r in rows:
        size[r[3]] += len(word_list(r[1]))
    want = fill(size)
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == size[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert len(got) == len(rows)
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)


def test_reruns_agree(spark):
    df = documents(spark, corpus())
    key = lambda rows: sorted(map(str, rows))
    assert key(mixing.mix(df).collect()) == key(mixing.mix(df.repartition(7)).collect())


def test_repeat_gives_the_taken_words(spark):
    rows = [r for r in corpus() if r[0] is not None and r[0] != 7]
    df = clashing(documents(spark, rows))
    got = mixing.repeat(df)
    assert got.columns == df.columns
    words = defaultdict(int)
    for r in got.collect():
        words[r["doc_id"]] += len(word_list(r["text"]))
    want = {r["doc_id"]: r["taken"] for r in mixing.mix(df).collect() if r["taken"]}
    assert dict(words) == want


def test_cut_texts_are_beginnings_of_their_documents(spark):
    """Lines, runs of spaces, a leading space and characters beyond the first plane stay as they are."""
    rng = random.Random(5)
    rows = [(i, " \n" * (i % 3) + "".join(f"{rng.choice(['w', 'é', '😀', '\x1c', '\u2003'])}{j}" + rng.choice([" ", "\n", "\t\x0b", " \r\n  "])
                                           for j in range(rng.randint(1, 40))), "en", rng.choice("aabc")) for i in range(120)]
    texts = {r[0]: r[1] for r in rows}
    cut = 0
    for r in mixing.repeat(documents(spark, rows)).collect():
        whole = texts[r["doc_id"]]
        if r["text"] != whole:
            cut += 1
            rest = whole[len(r["text"]):]
            assert whole.startswith(r["text"]) and r["text"][-1] not in " \t\n\x0b\x0c\r" and (rest == "" or rest[0] in " \t\n\x0b\x0c\r")
    assert 1 <= cut <= 3  # one document a source at most


def test_empty_table(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    assert mixing.repeat(documents(spark, [])).count() == 0
    assert mixing.mix(documents(spark, [(1, None, "en", "a"), (2, " ", "en", None)])).count() == 2
