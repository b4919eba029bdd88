import gzip
import os

import pytest
from corpus_fixtures import clashing, sf
from pyspark.sql import functions as F

from curbwise.llm import queries, warc

SCHEMA = "page_id long, url string, html string"
ROWS = [(1, "http://a/1", "<p>x</p>"), (9, "http://a/9", "<p>x</p>"), (5, "http://a/5", "<p>x</p>"), (2, None, None), (3, "http://a/ b\r\nWARC-Type: x", ""),
        (4, "é", "é\r\n\r\nWARC/1.1\r\n\r\n" * 3), (6, "http://big", "long " * 60000), (None, "http://n", "only"), (7, "http://t", "twice"), (7, "http://t", "twice")]


def want(rows, least=0):
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        group = [r[0] for r in rows if (r[2] or "") == (h or "") and r[0] is not None]
        top = max(group, default=None)
        first = len(data) < least or i == top
        out.append((i, len(data), warc.base32_sha1(data), "response" if first else "revisit", None if first else top))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark, tmp_path):
    d = sf(tmp_path, pages=clashing(spark.createDataFrame(ROWS, SCHEMA)))
    got = queries.op7_warc(spark, d)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == want(ROWS)


def test_payloads_come_back(spark, tmp_path):
    path = warc.write_archive(spark.createDataFrame(ROWS, SCHEMA).repartition(3), str(tmp_path / "w"), min_payload=6)
    rows = warc.read_archive(spark, path, types=("response",), verify=True).collect()
    texts = {r["record_id"]: r["payload"].decode() for r in rows}
    kept = [w for w in want(ROWS, 6) if w[3] == "response"]
    assert len(rows) == len(kept)
    assert texts["<urn:page:6>"] == "long " * 60000 and texts["<urn:page:4>"] == ROWS[5][2] and texts["<urn:page:2>"] == ""
    assert all("\n" not in (r["target_uri"] or "") for r in rows)
    for f in os.listdir(path):  # any gzip reader takes the files
        if f.endswith(".gz"):
            assert gzip.open(f"{path}/{f}").read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_predicates_on_headers(spark, tmp_path):
    path = warc.write_archive(spark.createDataFrame(ROWS, SCHEMA), str(tmp_path / "w"))
    assert {r["record_type"] for r in warc.read_archive(spark, path).collect()} == {"warcinfo", "response", "revisit"}
    assert warc.read_archive(spark, path, types=("revisit",)).count() == 3
    assert [r["payload"] for r in warc.read_archive(spark, path, **{"warc_record_id": "<urn:page:9>"}).collect()] == [b"<p>x</p>"]
    reader = warc.WarcReader({"path": path})
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringStartsWith

    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), In(("record_id",), ("<urn:page:9>", "<urn:page:6>")),
                                    StringStartsWith(("target_uri",), "http://a"), GreaterThan(("payload_bytes",), 3)]))
    assert len(left) == 1 and [r.column(1).to_pylist() for r in reader.read(reader.partitions()[0])] == [["<urn:page:9>"]]
    filtered = warc.read_archive(spark, path).filter((F.col("record_type") == "response") & (F.col("payload_bytes") > 100))
    assert {r["record_id"] for r in filtered.collect()} == {"<urn:page:6>"}


def test_unwanted_payloads_are_not_inflated(spark, tmp_path):
    """A damaged payload is met only by a reader that wants it."""
    path = warc.write_archive(spark.createDataFrame([(1, "u", os.urandom(40000).hex()), (2, "v", "fine")], SCHEMA).coalesce(1), str(tmp_path / "w"))
    f = next(f"{path}/{x}" for x in os.listdir(path) if x.endswith(".gz"))
    data = bytearray(open(f, "rb").read())
    data[len(data) // 2] ^= 255
    os.chmod(f, 0o644)
    open(f, "wb").write(data)
    assert sorted(r["record_type"] for r in warc.read_archive(spark, path, payload=False).collect()) == ["response", "response", "warcinfo"]
    with pytest.raises(Exception):
        warc.read_archive(spark, path, verify=True).collect()


def test_byte_ranges_and_members_without_size(tmp_path):
    records = [warc.record_bytes(i, f"http://x/{i}", b"p" * i, i, warc.base32_sha1(b"p" * i), True, None) for i in range(200)]
    for name, pack in (("sized", warc.member), ("plain", gzip.compress)):
        top = tmp_path / name
        top.mkdir()
        members = [pack(r) for r in records]
        offsets = [sum(map(len, members[:i])) for i in range(len(members))]
        (top / "a.warc.gz").write_bytes(b"".join(members))
        (top / "a.warc.gz.idx").write_text("\n".join(map(str, offsets)))
        reader = warc.WarcReader({"path": str(top), "partbytes": "9000", "verify": "true"})
        parts = reader.partitions()
        got = [(r["record_id"], r["payload"]) for p in parts for b in reader.read(p) for r in b.to_pylist()]
        assert len(parts) > 2 and got == [(f"<urn:page:{i}>", b"p" * i) for i in range(200)]


def test_empty_table(spark, tmp_path):
    assert queries.op7_warc(spark, sf(tmp_path, pages=spark.createDataFrame([], SCHEMA))).count() == 0


def test_urls_about_as_long_as_the_bounded_read(spark, tmp_path):
    rows = [(i, "http://a/" + "x" * n, f"<p>{i}</p>") for i, n in enumerate([*range(15_800, 16_500, 7), 17_000, 70_000])]
    path = warc.write_archive(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "w"))
    got = warc.read_archive(spark, path, payload=True, verify=True).filter("record_type = 'response'").collect()
    assert sorted((r["target_uri"], r["payload"].decode()) for r in got) == sorted((u, h) for _, u, h in rows)


def test_large_payloads_come_in_batches_by_bytes(spark, tmp_path, monkeypatch):
    rows = [(i, f"http://a/{i}", str(i) * 3000) for i in range(40)]
    path = warc.write_archive(spark.createDataFrame(rows, SCHEMA).coalesce(1), str(tmp_path / "w"))
    monkeypatch.setattr(warc, "BATCH_BYTES", 10_000)
    reader = warc.WarcReader({"path": path})
    batches = [b for span in reader.partitions() for b in reader.read(span)]
    assert len(batches) >= 10 and sum(b.num_rows for b in batches) >= 40


def test_paths_are_those_of_the_default_file_system(spark):
    assert warc.on_default("/x/y", "file:///") == warc.resolved(spark, "/x/y") == "/x/y"
    assert warc.on_default("/x/y", "hdfs://name:8020/") == "hdfs://name:8020/x/y"
    assert warc.on_default("s3a://b/x", "hdfs://name:8020") == "s3a://b/x"
    assert warc.on_default("file:/x", "hdfs://name:8020") == "file:/x"
    with pytest.raises(ValueError):
        warc.on_default("x/y", "hdfs://name:8020")
