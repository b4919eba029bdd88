"""Differential test: every registered query vs its DuckDB oracle.

Runs at sf0.001 by default (fast); set CURBWISE_CHECK_SF=/root/testdata/sf0.01
for the driver's scale.
"""

import os

import pytest

import __spark_entry__ as E
from curbwise import oracle_sql, registry
from oracle_check import compare

SF = os.environ.get("CURBWISE_CHECK_SF", "/root/testdata/sf0.001")
QUERIES = registry.queries()
ORACLE = oracle_sql.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, SF, QUERIES, ORACLE)
    assert r["schema_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["spark_rows"] == r["oracle_rows"]
    assert r["hash_match"]


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_score" in df.columns
