"""Properties over whole fixture outputs."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

import __spark_entry__ as E
from curbwise.plans import scoring, weekly
from curbwise.sources.tables import PermitTables

SF = "/root/testdata/sf0.01"
AS_OF = "2022-06-01 00:00:00"


def test_scores_bounded_and_total_is_sum(spark):
    df = E.queries()["inspector_priority"](spark, SF)
    parts = sum(F.col(c) for c in scoring.SCORE_COLUMNS)
    bad = df.filter((F.col("total_score") != parts) | (F.col("total_score") < 1)
                    | (F.col("total_score") > 45)).count()
    assert bad == 0
    lo, hi = df.agg(F.min("total_score"), F.max("total_score")).first()
    assert 1 <= lo < hi <= 45


def test_weekly_totals_equal_daily_totals(spark):
    t = PermitTables.from_fixture(spark, SF)
    summary = weekly.weekly_summary_report(t)
    totals = summary.agg(*[F.sum(c).alias(c) for c in summary.columns if c != "date"]).first().asDict()
    apps = E.queries()["applications_received"](spark, SF)
    issued = E.queries()["issued_permits"](spark, SF)

    def by_type(df, ty):
        return df.filter(F.col("foldertype") == ty).agg(F.sum("issuedrowpermits")).first()[0] or 0
    requests = {name: weekly.daily_counts(getattr(t, tbl), "created").agg(F.sum("count_permits")).first()[0]
                for name, tbl in [("c", "request_ds_commercial"), ("e", "request_extension"),
                                  ("r", "request_ds_residential")]}
    assert totals["ds_applications_received"] == by_type(apps, "DS") + requests["c"] + requests["r"]
    assert totals["ex_applications_received"] == by_type(apps, "EX")
    assert totals["rw_permits_issued"] == by_type(issued, "RW")
    assert totals["extension_requests"] == requests["e"]


def test_entry_in_a_bare_session(tmp_path):
    """entry() under a session built without any of the library's settings."""
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled','false')"
        ".config('spark.sql.session.timeZone','America/Chicago').getOrCreate()\n"
        "import __spark_entry__ as E\n"
        "df = E.entry(spark)\n"
        "print('ROWS', df.count(), len(df.columns))\n" % os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600,
                         cwd=str(tmp_path))
    line = [x for x in out.stdout.splitlines() if x.startswith("ROWS")]
    assert line, out.stderr[-2000:]
    rows, cols = map(int, line[0].split()[1:])
    assert rows > 0 and cols == 30
