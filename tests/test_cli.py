"""Command line: tag, run and publish over an extracted permit model."""

import os
import subprocess
import sys

from curbwise.plans import scoring
from curbwise.schemas import PERMIT_SCHEMAS
from curbwise.sources import sinks
from curbwise.sources.jdbc import extract_to_parquet
from curbwise.sources.tables import PermitTables

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"
AS_OF = "2022-06-01 00:00:00"


def _cli(*args):
    out = subprocess.run([sys.executable, "-m", "curbwise", *args, "--master", "local[2]"],
                         capture_output=True, text=True, timeout=600, cwd=ROOT)
    assert out.returncode == 0, out.stderr[-3000:]
    return out.stdout


def test_cli_tag_run_publish(spark, tmp_path):
    fixture = PermitTables.from_fixture(spark, SF)
    model, pub, csv = str(tmp_path / "model"), str(tmp_path / "pub"), str(tmp_path / "csv")
    extract_to_parquet(fixture, model, [n for n in PERMIT_SCHEMAS if n != "road_segment"])

    assert "segment_zone_tags version 1" in _cli("tag", "--full", "--tables", model, "--publish", pub,
                                                 "--as-of", AS_OF)
    assert "inspector_priority version 1" in _cli("run", "inspector_priority", "--tables", model,
                                                  "--publish", pub, "--as-of", AS_OF)
    assert "applications_received version 1" in _cli("run", "applications_received", "--tables", model,
                                                      "--publish", pub, "--csv", csv)

    published = sinks.read_latest(spark, f"{pub}/inspector_priority")
    expected = scoring.inspector_priority(fixture, AS_OF)
    cols = sorted(expected.columns)

    def rows(df):
        return sorted(map(repr, map(tuple, df.select(*cols).collect())))
    assert rows(published) == rows(expected)
    assert spark.read.option("header", True).csv(csv).count() == \
        sinks.read_latest(spark, f"{pub}/applications_received").count()


def _run(monkeypatch, spark, *args):
    """The command in this process, on the test's session."""
    import curbwise.session as session
    from curbwise.__main__ import main
    monkeypatch.setattr(session, "get_spark", lambda *a, **k: spark)
    assert main(list(args)) == 0


def test_cli_daily_counts_of_a_sheet(spark, tmp_path, monkeypatch):
    sheet = tmp_path / "sheet.csv"
    sheet.write_text('id,Created On,note\n1,01/05/24 9:30 AM,"a ""b"""\n2,"Jan 5, 2024",x\n3,N/A,y\n')
    _run(monkeypatch, spark, "daily-counts", "ds_requests", "--csv", str(sheet), "--date-column", "Created On", "--publish", str(tmp_path / "pub"))
    (row,) = sinks.read_latest(spark, str(tmp_path / "pub" / "ds_requests")).collect()
    assert (str(row.date), row.count_permits) == ("2024-01-05", 2)


def test_cli_snapshot_has_the_time_of_the_file(spark, tmp_path, monkeypatch):
    f = tmp_path / "active.csv"
    f.write_text("foldertype,activepermits\nDS,3\nEX,4\nRW,5\n")
    os.utime(f, (1_704_110_400, 1_704_110_400))  # 2024-01-01 12:00 UTC
    for _ in range(2):
        _run(monkeypatch, spark, "snapshot", "--file", str(f), "--publish", str(tmp_path / "pub"))
    (row,) = sinks.read_latest(spark, str(tmp_path / "pub" / "active_permits_snapshot")).collect()
    assert (row.ds, row.ex, row.rw, row.published_date) == (3.0, 4.0, 5.0, "2024-01-01T06:00:00.000")


def test_cli_publishes_a_configured_file(spark, tmp_path, monkeypatch):
    f = tmp_path / "tags.csv"
    f.write_text("segment_id,full_street_name\n1,\"A, St\"\n2,B\n")
    for text in (None, "segment_id,full_street_name\n2,C\n"):
        if text:
            f.write_text(text)
        _run(monkeypatch, spark, "publish-file", "segment_zone_tags", "--csv", str(f), "--publish", str(tmp_path / "pub"))
    got = sinks.read_latest(spark, str(tmp_path / "pub" / "segment_zone_tags"))
    assert sorted(map(tuple, got.collect())) == [(1, "A, St"), (2, "C")]
