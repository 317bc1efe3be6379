"""Stored tables are written when a query first reads them, and hold what the scheduled build writes."""

import os

from adtally import catalog
from adtally.plans import pipeline, timeseries
from adtally.session import scratch_path
from adtally.sources.load import StoredRaw, load_raw
from adtally.sources.registry import RAW_TABLES, from_testdata
from tests.compare import assert_same, spark_rows
from tests.conftest import SF_SMALL

TABLES = [name for stage in pipeline.STAGES for name in stage]


def test_a_query_writes_only_the_tables_that_it_reads(spark):
    root, marts = scratch_path(spark, "lazy_raw"), scratch_path(spark, "lazy_marts")
    m = pipeline.StoredModels(StoredRaw(from_testdata(spark, SF_SMALL), root), marts)
    found = spark_rows(timeseries.rolling_7d_metrics(m))
    assert os.listdir(root) == ["ad_events"] and os.listdir(marts) == ["fct_publisher_performance"]
    whole = pipeline.build_marts(load_raw(spark, from_testdata(spark, SF_SMALL)), scratch_path(spark, "whole"))
    assert_same(found, spark_rows(timeseries.rolling_7d_metrics(whole)), "rolling")


def test_tables_are_the_scheduled_builds_in_any_order(spark):
    raw = load_raw(spark, from_testdata(spark, SF_SMALL))
    built = pipeline.build_marts(raw, scratch_path(spark, "built"))
    expected = {name: spark_rows(built.model(name)) for name in TABLES}
    for order in (TABLES, TABLES[::-1]):
        m = pipeline.StoredModels(raw, scratch_path(spark, "any_order"))
        for name in order:
            assert m.model(name).schema == built.model(name).schema
            assert_same(spark_rows(m.model(name)), expected[name], name)
        assert m.table("dim_campaigns") is m.dim_campaigns


def test_staged_events_are_grouped_once(spark):
    m = pipeline.StoredModels(load_raw(spark, from_testdata(spark, SF_SMALL)), scratch_path(spark, "grouped"))
    assert m.stg_ad_events.columns and m.dim_campaigns.columns
    assert sorted(m.written) == ["dim_campaigns", "fct_ad_events_daily", "stg_ad_events"]


def test_registered_queries_read_stored_tables(spark):
    m = catalog.marts_for(spark, SF_SMALL)
    assert isinstance(m, pipeline.StoredModels) and isinstance(m.raw, StoredRaw)
    assert m.fct_publisher_performance.inputFiles() == m.table("fct_publisher_performance").inputFiles() != []
    assert set(m.raw.write_all().__dict__) == {"_given", *RAW_TABLES}
