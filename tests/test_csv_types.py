"""Typed CSV: types and nulls equal to those of a common CSV reader (pandas, default settings)."""

import random

import pandas as pd
import pytest

from curbwise.sources import csv_io, sinks

KINDS = {"bigint": "int64", "double": "float64", "boolean": "bool", "string": "object"}


def _columns(n=400, seed=3):
    rng = random.Random(seed)
    missing = lambda v: v if rng.random() < 0.8 else rng.choice(csv_io.NULL_TOKENS)
    late = ["7"] * (n - 1) + ["seven"]
    return {
        "whole": [str(rng.randrange(-10**12, 10**12)) for _ in range(n)],
        "whole_na": [missing(str(rng.randrange(100))) for _ in range(n)],
        "zeros": [f"{rng.randrange(100):05d}" for _ in range(n)],
        "signs": [rng.choice("+-") + str(rng.randrange(9)) for _ in range(n)],
        "real": [rng.choice(["1.5", "2", "-.5", "3.", "1e3", "-2.5E-2", "0007.25"]) for _ in range(n)],
        "real_na": [missing(f"{rng.random():.6f}") for _ in range(n)],
        "infinite": [rng.choice(["inf", "-inf", "Infinity", "-INF", "2"]) for _ in range(n)],
        "flag": [rng.choice(["True", "FALSE", "true", "False"]) for _ in range(n)],
        "flag_na": [missing(rng.choice(["True", "False"])) for _ in range(n)],
        "flag_or_number": [rng.choice(["True", "1"]) for _ in range(n)],
        "nothing": [rng.choice(csv_io.NULL_TOKENS) for _ in range(n)],
        "late_text": late,
        "late_real": ["7"] * (n - 1) + ["7.5"],
        "huge": ["99999999999999999999"] + ["1"] * (n - 1),
        "suffix": [rng.choice(["1d", "2f", "3L"]) for _ in range(n)],
        "hexadecimal": ["0x1F"] * n,
        "thousands": ["1,000"] * n,
        "date": ["2024-01-05"] * n,
        "blank": [" NA"] * n,
        "words": [missing(rng.choice(['a "quoted" word', "two words", "é", "x,y"])) for _ in range(n)],
    }


def _write(path, columns):
    pd.DataFrame(columns).to_csv(path, index=False)
    return str(path)


def _same(ours, theirs):
    if theirs is None or theirs != theirs:
        return ours is None
    return ours == theirs


@pytest.mark.parametrize("seed", [3, 4])
def test_types_and_nulls_equal_a_common_reader(spark, tmp_path, seed):
    path = _write(tmp_path / "t.csv", _columns(seed=seed))
    got, want = csv_io.read_typed(spark, path), pd.read_csv(path)
    types = dict(got.dtypes)
    for name in want:
        theirs = str(want[name].dtype)
        if theirs in ("str", "string"):
            theirs = "object"
        if name == "whole_na":  # whole numbers stay whole beside missing ones
            assert (theirs, types[name]) == ("float64", "bigint")
        elif name == "flag_na":
            assert (theirs, types[name]) == ("object", "boolean")
        else:
            assert KINDS[types[name]] == theirs, name
    rows = got.collect()
    assert len(rows) == len(want)
    for name in want:
        assert all(_same(r[name], v) for r, v in zip(rows, want[name].tolist())), name


def test_a_column_is_typed_by_all_its_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i, value in enumerate(["1", "2", "N/A", "2.5"]):
        (tmp_path / "in" / f"{i}.csv").write_text(f"k,v\n{i},{value}\n")
    got = csv_io.read_typed(spark, str(tmp_path / "in"))
    assert got.dtypes == [("k", "bigint"), ("v", "double")]
    assert sorted(map(tuple, got.collect())) == [(0, 1.0), (1, 2.0), (2, None), (3, 2.5)]


def test_timestamps_on_request(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c\n2024-01-05,2024-01-05T10:00:00,2024-13-05\nNA,2024-01-06 11:30,x\n")
    assert [t for _, t in csv_io.read_typed(spark, str(tmp_path / "t.csv")).dtypes] == ["string"] * 3
    got = csv_io.read_typed(spark, str(tmp_path / "t.csv"), timestamps=True)
    assert [t for _, t in got.dtypes] == ["timestamp_ntz", "timestamp_ntz", "string"]
    assert got.first().b.hour == 10


def test_lines_inside_quotes_and_splits(spark, tmp_path):
    plain, quoted = tmp_path / "plain.csv", tmp_path / "quoted.csv"
    plain.write_text("n,t\n" + "".join(f'{i},"say ""{i}"", twice"\n' for i in range(20_000)))
    quoted.write_text('n,t\n1,"two\nlines"\n2,"one ""line"""\n')
    assert not csv_io.has_quoted_line_ends(spark, str(plain)) and csv_io.has_quoted_line_ends(spark, str(quoted))
    assert [tuple(r) for r in csv_io.read_typed(spark, str(quoted)).collect()] == [(1, "two\nlines"), (2, 'one "line"')]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = csv_io.read_typed(spark, str(plain))
        assert got.rdd.getNumPartitions() > 4  # a file of many tasks
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got.count() == 20_000 and got.filter("n = 77").first().t == 'say "77", twice'


def test_empty_file_and_header_only(spark, tmp_path):
    (tmp_path / "h.csv").write_text("a,b\n")
    got = csv_io.read_typed(spark, str(tmp_path / "h.csv"))
    assert got.columns == ["a", "b"] and got.count() == 0


def test_published_file_keeps_the_latest_cycle_by_number(spark, tmp_path):
    from curbwise.__main__ import main

    f, root = tmp_path / "lde.csv", str(tmp_path / "pub")
    f.write_text("PROCESSRSN,COUNCILDISTRICT,CYCLENUMBER,REVIEWER\n5,1,9,nine\n5,1,10,ten\n6,N/A,2,N/A\n6,N/A,1,early\n")
    assert main(["publish-file", "lde_site_plan_revisions", "--csv", str(f), "--publish", root, "--master", "local[2]"]) == 0
    got = sinks.read_latest(spark, f"{root}/lde_site_plan_revisions")
    assert dict(got.dtypes) == {"processrsn": "bigint", "councildistrict": "bigint", "cyclenumber": "bigint", "reviewer": "string"}
    assert sorted(map(tuple, got.select("processrsn", "councildistrict", "cyclenumber", "reviewer").collect())) == [
        (5, 1, 10, "ten"), (6, None, 2, None)]


def test_text_in_the_order_column_is_refused(spark, tmp_path):
    rows = spark.createDataFrame([(5, 1, "9"), (5, 1, "10")], "processrsn long, councildistrict long, cyclenumber string")
    with pytest.raises(ValueError, match="cyclenumber"):
        sinks.publish(spark, "lde_site_plan_revisions", rows, str(tmp_path))
