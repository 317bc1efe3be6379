"""Physical-plan properties that matter at scale, checked for every registered query."""

import pytest

from adtally import catalog
from tests.conftest import SF_SMALL

BATCH = [n for n in catalog.CATALOG if not n.startswith("stream_")]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_no_python_udf(spark, name):
    p = plan(catalog.run(name, spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p, f"{name} uses {bad}"


def test_dedup_limits_rows_before_the_shuffle(spark):
    from adtally.plans import staging
    from adtally.sources.registry import from_testdata

    for p in (plan(catalog.run("stg_ad_events", spark, SF_SMALL)),          # loaded raw tables
              plan(staging.stg_ad_events(from_testdata(spark, SF_SMALL)))):  # derived on the fly
        assert "Partial" in p and "Final" in p
        # the partial limit sits below (after, in the string) the exchange on event_id
        assert p.find("Exchange hashpartitioning(event_id") < p.rfind("WindowGroupLimit")


def test_fact_scan_prunes_columns(spark):
    p = plan(catalog.run("fct_ad_events_daily", spark, SF_SMALL))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line and "/ad_events]" in line]
    # the daily fact never reads browser or ad unit; the scan's ReadSchema must leave them out
    assert scan and all("ReadSchema" in line and "browser" not in line and "ad_unit_id" not in line
                        for line in scan)


@pytest.mark.parametrize("name", sorted(catalog.STORED))
def test_consumers_read_stored_tables(spark, name):
    p = plan(catalog.run(name, spark, SF_SMALL))
    assert "WindowGroupLimit" not in p  # no dedup of raw events in a chart, test, KPI or detector
    if name in ("test_not_null", "test_unique"):
        # the only generated rows are one result row for each test, after the aggregates
        assert all("inline" in line for line in p.splitlines() if "Generate " in line)


def test_aggregations_are_partial_then_final(spark):
    p = plan(catalog.run("fct_publisher_performance", spark, SF_SMALL))
    assert p.count("HashAggregate") >= 4  # partial + final for each of the two roll-ups


def test_date_filter_reaches_the_scan_of_written_marts(spark):
    from pyspark.sql import functions as F

    m = catalog.models_for(spark, SF_SMALL)
    from adtally.sources import io
    fct = io.materialize("fct_ad_events_daily", m.fct_ad_events_daily)
    p = plan(fct.filter(F.col("event_date") == F.lit("2024-01-05").cast("date")).filter(F.col("publisher_id") == 3))
    assert "PartitionFilters: [isnotnull(event_date" in p
    assert "PushedFilters: [IsNotNull(publisher_id), EqualTo(publisher_id,3)]" in p
