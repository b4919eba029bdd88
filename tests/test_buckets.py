"""Bucketed upsert: rows of the plain merge, files of the touched buckets only, safe to run again."""

import os
import random

import pytest

from curbwise.sources import buckets, sinks

KEYED = "k long, c string, v long, t double"


def _files(root):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _random(rng, n, keys):
    return [(rng.choice([None, *range(keys)]), rng.choice([None, "", "a", "b"]), rng.randrange(10**6), rng.random()) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_rows_equal_the_plain_merge(spark, tmp_path, seed):
    rng, root, key = random.Random(seed), str(tmp_path / "d"), ["k", "c"]
    want = None
    for turn in range(4):
        new = spark.createDataFrame(_random(rng, rng.choice([0, 5, 60]) if turn else 60, 40), KEYED)
        assert sinks.upsert(spark, new, root, key, ["v", "t"], n_buckets=7) == turn + 1
        merged = sinks.latest_by_key(new, key, ["v", "t"]) if want is None else sinks.merge_by_key(want, new, key, ["v", "t"])
        want = spark.createDataFrame(merged.collect(), KEYED)
        got = sinks.read_latest(spark, root)
        assert got.columns == ["k", "c", "v", "t"] and _rows(got) == _rows(want)


def test_only_touched_buckets_are_written(spark, tmp_path):
    root = str(tmp_path / "d")
    base = spark.range(2000).selectExpr("id AS k", "'c' AS c", "id AS v", "0D AS t")
    sinks.upsert(spark, base, root, ["k"], n_buckets=16)
    before = _files(root)
    update = spark.createDataFrame([(5, "new", 1, 1.0), (10**9, "new", 2, 2.0)], KEYED)
    touched = {r[0] for r in update.select(buckets.bucket_of(["k"], 16)).collect()}
    sinks.upsert(spark, update, root, ["k"])
    after = _files(root)
    assert {f: t for f, t in after.items() if f in before} == before  # nothing is written in place
    written = {int(f.split("_bucket=")[1].split("/")[0]) for f in after if f not in before}
    assert written == touched and len(before) >= 15
    got = sinks.read_latest(spark, root)
    assert got.count() == 2001 and got.filter("k = 5").first().c == "new"
    read = got.inputFiles()
    assert len([f for f in read if "version=000002" in f]) == len(touched)


def test_a_failed_version_is_not_seen_and_a_retry_writes_it(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "d")
    sinks.upsert(spark, spark.createDataFrame([(1, "a", 1, 1.0), (2, "b", 1, 1.0)], KEYED), root, ["k"], n_buckets=4)
    before = _rows(sinks.read_latest(spark, root))
    update = spark.createDataFrame([(2, "B", 2, 2.0), (3, "c", 2, 2.0)], KEYED)
    with monkeypatch.context() as m:
        m.setattr(buckets, "_write_manifest", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sinks.upsert(spark, update, root, ["k"])
    assert sinks.versions(spark, root) == [1] and _rows(sinks.read_latest(spark, root)) == before
    assert sinks.upsert(spark, update, root, ["k"]) == 2
    want = [(1, "a", 1, 1.0), (2, "B", 2, 2.0), (3, "c", 2, 2.0)]
    assert _rows(sinks.read_latest(spark, root)) == want
    sinks.upsert(spark, update, root, ["k"])  # again: the same rows
    assert _rows(sinks.read_latest(spark, root)) == want


def test_new_columns_wider_types_and_a_plain_dataset_before(spark, tmp_path):
    root = str(tmp_path / "d")
    sinks.replace(spark, spark.createDataFrame([(1, 1), (2, 2)], "k int, v int"), root)
    sinks.upsert(spark, spark.createDataFrame([(2, 3, "x")], "k int, v int, note string"), root, ["k"], n_buckets=3)
    assert _rows(sinks.read_latest(spark, root)) == [(1, 1, None), (2, 3, "x")]
    sinks.upsert(spark, spark.createDataFrame([(3, 4)], "k int, v int"), root, ["k"])
    sinks.upsert(spark, spark.createDataFrame([(3, 2**40)], "k int, v long"), root, ["k"])  # all buckets again
    got = sinks.read_latest(spark, root)
    assert dict(got.dtypes)["v"] == "bigint" and _rows(got) == [(1, 1, None), (2, 3, "x"), (3, 2**40, None)]


def test_prune_keeps_what_the_kept_version_reads(spark, tmp_path):
    root = str(tmp_path / "d")
    sinks.upsert(spark, spark.range(100).selectExpr("id AS k", "0 AS v"), root, ["k"], n_buckets=8)
    for v in (1, 2, 3):
        sinks.upsert(spark, spark.createDataFrame([(7, v)], "k long, v int"), root, ["k"])
    sinks.prune(spark, root, keep=1)
    assert sinks.versions(spark, root) == [4]
    assert len(_files(root)) == 8  # one file for each bucket that is still read
    got = sinks.read_latest(spark, root)
    assert got.count() == 100 and got.filter("k = 7").first().v == 3
