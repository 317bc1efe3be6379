"""Every registered query equals its independent DuckDB statement on the same inputs."""

import os

import pytest

import __spark_entry__ as entry
from adtally.catalog import CATALOG
from tests.compare import assert_same, duck_rows, spark_rows
from tests.conftest import ROOT, SF_SMALL

QUERIES = {n: q for n, q in entry.queries().items() if n in CATALOG}
ORACLE = entry.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(CATALOG) and set(QUERIES) <= set(ORACLE), sorted(set(QUERIES) - set(ORACLE))


def test_the_oracle_states_everything_for_itself():
    for name in os.listdir(f"{ROOT}/oracle"):
        if name.endswith(".py"):
            assert "adtally" not in open(f"{ROOT}/oracle/{name}").read()


@pytest.fixture(scope="module")
def con(duck):
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert_same(spark_rows(df), duck_rows(con, ORACLE[name]), name)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["publisher", "ctr_pct", "clicks", "impressions", "risk_level"]
    assert 0 < len(rows) <= 15
    assert {r.risk_level for r in rows} <= {"CRITICAL - Fraud", "High Risk", "Monitor", "Normal"}
