import random
from collections import Counter

import numpy as np
import pytest
from corpus_fixtures import clashing, documents, edit, random_text, sf, word_list

from curbwise.llm import ngram_join as J, queries


def shingles(text):
    words = word_list("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(rows):
    """doc_id, set size, component of every row with a doc_id."""
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and None not in (rows[i][0], rows[j][0]) and 100 * len(x & y) >= 80 * len(x | y):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return Counter((r[0], len(sets[i]), None if r[0] is None else least[find(i)]) for i, r in enumerate(rows))


def corpus(seed, families=12):
    rng = random.Random(seed)
    passage = random_text(rng, 60)
    rows = [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "one two"), (1004, "ONE  Two"), (1005, "one two three"), (None, "one two"),
            (1006, "É one two"), (1007, "é one two"), (1008, "long " * 20000), (1009, random_text(rng, 20000))]
    n = 0
    for _ in range(families):
        base = random_text(rng, rng.choice([6, 12, 40, 120, 400])) + (" " + passage if rng.random() < 0.5 else "")
        for _ in range(rng.randint(1, 8)):
            text = edit(rng, base, rng.choice([0, 0, 1, 2, 4])) if rng.random() < 0.9 else base + " tail words added here"
            rows.append((n, text))
            base = text if rng.random() < 0.5 else base  # chains: ends of a component need not link
            n += 1
    rows += [(3, rows[20][1]), (n, rows[-1][1].upper()), (n, rows[-1][1].upper())]
    rng.shuffle(rows)
    return rows


def result(spark, rows, **options):
    got = J.join(clashing(documents(spark, rows)), **options).select("doc_id", "n_shingles", "component_id")
    return Counter(map(tuple, got.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    assert result(spark, rows) == brute(rows)


def test_hot_lists_and_shards_equal_brute_force(spark):
    """90 near copies: lists of HOT and more become nodes; a low limit deals blocks to many shards and parts."""
    rng = random.Random(9)
    base = random_text(rng, 150)
    rows = [(i, edit(rng, base, rng.choice([1, 2, 3, 6, 9]))) for i in range(90)] + corpus(4, 6)
    want = brute(rows)
    assert result(spark, rows, block_shingles=900) == want


def brute_links(rows):
    """(doc_id, rows linked, different sets linked) of every row, and the pairs of different sets that link."""
    sets = [frozenset(shingles(r[1])) if r[0] is not None else frozenset() for r in rows]
    different = list({s for s in sets if s})
    near = {x: [y for y in different if y is not x and 100 * len(x & y) >= 80 * len(x | y)] for x in different}
    copies = Counter(sets)
    counts = Counter((r[0], copies[x] - 1 + sum(copies[y] for y in near[x]), len(near[x])) if x else (r[0], 0, 0) for r, x in zip(rows, sets))
    return counts, {frozenset((x, y)) for x in different for y in near[x]}


@pytest.mark.parametrize("options", [{}, {"block_shingles": 900, "asked": 20}, {"asked": 7}])
def test_every_link_is_counted_and_returned(spark, options):
    """Copies, near copies in several shards and parts; a pair of sets is returned once, whatever its copies."""
    rng = random.Random(19)
    base = random_text(rng, 150)
    rows = [(i, edit(rng, base, rng.choice([0, 1, 2, 3, 6, 9]))) for i in range(70)] + corpus(4, 6)
    counts, pairs = brute_links(rows)
    df = clashing(documents(spark, rows))
    got = J.join_counted(df, **options)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_shingles", "component_id", "n_links", "n_linked_sets")]
    got = got.collect()
    assert Counter((r["doc_id"], r["n_links"], r["n_linked_sets"]) for r in got) == counts
    assert Counter(tuple(r)[:3] for r in got) == brute(rows)
    import pyarrow as pa

    name = {J.set_id(x): frozenset(shingles(r[1])) for r, x in zip(rows, J.shingle_sets(pa.array([r[1] for r in rows], pa.string()))) if len(x)}
    found = [tuple(r) for r in J.links(df, **options).collect()]
    assert all(u < v for u, v in found) and len(found) == len(pairs)
    assert {frozenset((name[u], name[v])) for u, v in found} == pairs


def test_links_of_an_empty_table(spark):
    assert J.links(documents(spark, [])).count() == 0 == J.join_counted(documents(spark, [])).count()


def test_block_search_finds_every_link():
    rng = random.Random(11)
    for trial in range(30):
        base = random_text(rng, 80)
        texts = [edit(rng, base, rng.choice([0, 1, 2, 3, 5, 8])) for _ in range(12)] + [random_text(rng, 30) for _ in range(3)]
        import pyarrow as pa

        sets = J.shingle_sets(pa.array(texts))
        block = J.Block(sets)
        for i, x in enumerate(sets):
            want = [j for j, y in enumerate(sets) if j != i and 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y))]
            assert block.links(i) == want


def test_merge_skip_counts():
    rng = random.Random(3)
    for _ in range(300):
        lists = [sorted(rng.sample(range(30), rng.randint(0, 12))) for _ in range(rng.randint(1, 9))]
        need = rng.randint(1, 6)
        count = Counter(x for s in lists for x in s)
        assert J._merge_skip(lists, need) == {x: c for x, c in count.items() if c >= need}


def test_hot_hash_of_a_chunk_goes_to_its_bucket_once():
    h = np.repeat(np.array([5 << 40, 9 << 50], np.uint64), [J.HOT, 3])
    sids = np.arange(len(h), dtype=np.int64)
    rows = [r for b in J._chunk(h, sids, 4) for r in b.to_pylist()]
    sent = sum(len(r["a"]) // 8 for r in rows if r["kind"] == 1)
    assert sent == 1 + 3 and sum(len(r["a"]) // 8 for r in rows if r["kind"] == 2) == J.HOT - 1


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 600)]
    got = dict(map(tuple, J.components(spark.createDataFrame(edges, "u long, v long")).collect()))
    root = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(root[a], root[b])
            changed |= root[a] != m or root[b] != m
            root[a] = root[b] = m
    assert got == {k: v for k, v in root.items() if any(k in e and e[0] != e[1] for e in edges)}


def test_one_of_each_component_stays(spark):
    rows = corpus(5)
    rows.remove(next(r for r in rows if r[0] == 3))  # the other text of doc 3 could be a component of the same name
    df = clashing(documents(spark, rows))
    got = J.drop_near_copies(df)
    assert got.columns == df.columns
    kept = Counter(r["doc_id"] for r in got.collect())
    comps = {c for d, n, c in brute(rows) if n and d is not None}
    alone = Counter(r[0] for r in rows if r[0] is None or not word_list(r[1]))
    assert kept == Counter(comps) + alone


def test_query_and_empty_table(spark, tmp_path):
    assert queries.op1_ngram_jaccard_join(spark, sf(tmp_path / "a", documents=documents(spark, []))).count() == 0
    d = sf(tmp_path / "b", documents=documents(spark, [(4, "a b c d e f"), (2, "A b c d e f"), (9, None)]))
    assert sorted(map(tuple, queries.op1_ngram_jaccard_join(spark, d).collect())) == [(2, 2, 2, 1), (4, 2, 2, 1), (9, 0, 9, 0)]


def shared_sentences(rng, n, lines=40):
    """Texts that share sentences with many others, a part of each being its own: none links with another."""
    pool = [random_text(rng, 30) for _ in range(lines)]
    return [(i, "\n".join(rng.sample(pool, 4) + [random_text(rng, 26)])) for i in range(n)]


def test_sets_that_only_share_sentences_leave_large_blocks(spark):
    rng = random.Random(21)
    base = random_text(rng, 100)
    rows = shared_sentences(rng, 120) + [(200 + i, edit(rng, base, 1)) for i in range(40)]
    df = documents(spark, rows)
    loose = J._blocks(df, "text", "doc_id", 5, 80, J.BLOCK_SHINGLES)[3]
    assert loose.filter("doc_id < 200").count() > 100  # below the size from which blocks are listed again
    finer = J._blocks(df, "text", "doc_id", 5, 80, J.BLOCK_SHINGLES, whole_from=30)[3]
    assert {r["doc_id"] // 200 for r in finer.collect()} == {1} and finer.count() == len({frozenset(shingles(t)) for i, t in rows if i >= 200})


def test_blocks_listed_again_equal_brute_force(spark, monkeypatch):
    rng = random.Random(22)
    base = random_text(rng, 150)
    rows = [(1000 + i, edit(rng, base, rng.choice([0, 1, 2, 3, 6, 9]))) for i in range(50)] + shared_sentences(rng, 40) + corpus(4, 6)
    real = J._blocks
    monkeypatch.setattr(J, "_blocks", lambda *a: real(*a, whole_from=3))
    assert result(spark, rows) == brute(rows)
    counts, _ = brute_links(rows)
    got = J.join_counted(clashing(documents(spark, rows)), block_shingles=900, asked=7).collect()
    assert Counter((r["doc_id"], r["n_links"], r["n_linked_sets"]) for r in got) == counts


def test_a_set_with_copies_is_on_a_list_once(spark):
    rng = random.Random(23)
    base = random_text(rng, 60)
    texts = [base, edit(rng, base, 1), edit(rng, base, 2)] * 40
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(12, "doc_id")
    J.ship(spark)
    lists = J._lists(J._entries(df, 5, 80, 4).repartition(4, "bucket").sortWithinPartitions("bucket")).collect()
    assert lists and max(Counter((r["sid"], r["hash"]) for r in lists).values()) == 1
    assert max(r["df"] for r in lists) == len(set(texts))


def test_a_set_goes_to_few_tasks(spark):
    """A large group's parts are of more queries, not more of them; parts of more than a third of a shard are dealt further."""
    members = spark.range(20000).selectExpr("1L AS block", "id AS sid", "400L AS n").unionAll(spark.range(600).selectExpr("2L", "id", "40L"))
    got = dict(map(tuple, J._parts(members, J.ASKED, J.BLOCK_SHINGLES).collect()))
    assert got == {1: max(J.PARTS, 6), 2: 3}
    assert dict(map(tuple, J._parts(members, J.ASKED, 900_000).collect()))[1] == 25


def test_dense_lists_are_counted_exactly():
    rng = random.Random(24)
    import pyarrow as pa

    base = random_text(rng, 200)
    sets = J.shingle_sets(pa.array([edit(rng, base, rng.choice([1, 2, 4, 8])) for _ in range(150)] + [random_text(rng, 40) for _ in range(50)]))
    block = J.Block(sets)
    for i, x in enumerate(sets):
        assert block.links(i) == [j for j, y in enumerate(sets) if j != i and 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y))]


def test_shuffle_files_go_with_the_job_that_is_saved(spark):
    from curbwise.llm.common import CLEAN_UP, saved

    before = spark.conf.get(CLEAN_UP)
    got = saved(spark.range(1000).selectExpr("id % 7 AS k").repartition(5, "k").groupBy("k").count(), "files")
    assert got.count() == 7 and spark.conf.get(CLEAN_UP) == before


def test_bit_set_follows_the_members():
    assert [J._filter_bits(n) for n in (0, 5000, 500_000)] == [1 << 16, 1 << 17, 1 << 23] and J._filter_bits(10 ** 9) == J.FILTER_BITS


def test_components_of_stars_take_no_round(spark):
    import os

    from curbwise.llm.common import shared_folder

    edges = spark.createDataFrame([(i, i % 3) for i in range(3, 60)], "u long, v long")
    got = dict(map(tuple, J.components(edges, "stars-test").collect()))
    assert got == {i: i % 3 for i in range(60)}
    assert sum(f.startswith("stars-test") for f in os.listdir(f"{shared_folder(spark)}/llm".removeprefix("file://"))) == 1
