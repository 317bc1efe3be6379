"""The fact kept by signed changes equals a rebuild; an incremental run reads only files that hold touched events."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adtally import catalog
from adtally.plans import incremental, live_fact, marts, staging
from adtally.session import scratch_path
from adtally.sources.event_store import EventStore, as_ntz
from adtally.sources.registry import from_testdata
from tests.compare import assert_same, spark_rows
from tests.conftest import SF_SMALL
from tests.test_incremental import _events

SINCE = dt.datetime(2024, 1, 20)


def rebuilt(events, raw):
    return marts.fct_ad_events_daily(staging.stg_ad_events(raw.replace(ad_events=events)))


@pytest.fixture
def kept(spark):
    """A store and its fact up to ``SINCE``."""
    raw = from_testdata(spark, SF_SMALL)
    root = scratch_path(spark, "live")
    store = EventStore(spark, f"{root}/store")
    store.load(raw.ad_events.where(F.col("_loaded_at") <= as_ntz(SINCE)), "first")
    fact = live_fact.LiveFact(store, f"{root}/fact")
    fact.run()
    return raw, store, fact


def test_runs_equal_a_rebuild_and_change_only_touched_dates(spark, kept):
    raw, store, fact = kept
    assert_same(spark_rows(fact.fact()), spark_rows(rebuilt(store.events(), raw)), "first run")
    before = fact.ledger.read()[1]["dates"]
    preview = fact.touched_by(SINCE)
    assert preview.count() == 0
    assert store.load(raw.ad_events.where(F.col("_loaded_at") > as_ntz(SINCE)), "second")
    touched = incremental.touched_dates(raw.ad_events, SINCE)
    assert_same(spark_rows(fact.touched_by(SINCE)), spark_rows(incremental.fct_daily_for_dates(raw, touched)), "preview")
    after = fact.run()["dates"]
    assert_same(spark_rows(fact.fact()), spark_rows(rebuilt(raw.ad_events, raw)), "second run")
    dates = {r[0].isoformat() for r in touched.collect()}
    assert {d for d in before if after.get(d) != before[d]} <= dates and set(before) - dates
    assert fact.run() == fact.ledger.read()[1] and not store.load(raw.ad_events, "second")


def test_retries_that_move_empty_or_repeat_events_and_null_ids(spark):
    raw = from_testdata(spark, SF_SMALL)
    root = scratch_path(spark, "moves")
    store, day = EventStore(spark, f"{root}/store"), lambda d, h=10: dt.datetime(2024, 1, d, h)
    fact = live_fact.LiveFact(store, f"{root}/fact")
    loads = [[("a", day(1), day(2)), ("b", day(3), day(4)), (None, day(3), day(4)), ("old", day(6), day(9)), ("untimed", None, day(2))],
             [("a", day(5), day(6)), ("new", day(3), day(7)), ("old", day(7), day(8)), (None, day(4), day(5))],  # old: an earlier version comes late
             [("hot", day(1 + i % 5), day(10) + dt.timedelta(minutes=i)) for i in range(300)],
             [("hot", day(2), day(12))] * 3]
    rows = []
    for n, load in enumerate(loads):
        rows += load
        store.load(_events(raw, load), str(n))
        fact.run()
        expected = rebuilt(_events(raw, rows), raw)
        assert_same(spark_rows(fact.fact()), spark_rows(expected), f"load {n}")
    assert "2024-01-01" not in fact.ledger.read()[1]["dates"]


def test_a_run_that_died_is_run_again(spark, kept, monkeypatch):
    raw, store, fact = kept
    store.load(raw.ad_events.where(F.col("_loaded_at") > as_ntz(SINCE)), "second")
    monkeypatch.setattr(fact.ledger, "change", lambda edit: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        fact.run()
    monkeypatch.undo()
    fact.run()
    assert_same(spark_rows(fact.fact()), spark_rows(rebuilt(raw.ad_events, raw)), "run again")


def test_columns_come_and_go(spark, kept):
    raw, store, fact = kept
    mobile = F.when(F.col("device_type") == "mobile", 1).otherwise(0).cast("long")

    def expected(events):
        stg = staging.stg_ad_events(raw.replace(ad_events=events))
        plain = marts.fct_ad_events_daily(stg)
        keys = [F.coalesce(F.col(c), F.lit(0)).alias(c) if c in ("campaign_id", "advertiser_id") else F.col(c) for c in marts.FACT_KEYS]
        extra = stg.select(*keys, mobile.alias("mobile_events")).groupBy(*marts.FACT_KEYS).agg(F.sum("mobile_events").alias("mobile_events"))
        return plain.join(extra, list(marts.FACT_KEYS))

    wider = live_fact.LiveFact(store, fact.root, {"mobile_events": mobile})
    wider.run()  # no new batch: the column alone, on all dates
    assert_same(spark_rows(wider.fact()), spark_rows(expected(store.events())), "gained")
    store.load(raw.ad_events.where(F.col("_loaded_at") > as_ntz(SINCE)), "second")
    wider.run()
    assert_same(spark_rows(wider.fact()), spark_rows(expected(raw.ad_events)), "gained and grown")
    fact.run()
    assert_same(spark_rows(fact.fact()), spark_rows(rebuilt(raw.ad_events, raw)), "lost")
    assert "mobile_events" not in fact.fact().columns and fact.ledger.read()[1]["columns"] == list(fact.measures)


def test_without_backfill_old_dates_are_null(spark, kept):
    raw, store, fact = kept
    wider = live_fact.LiveFact(store, fact.root, {"clicks_seen": F.lit(1).cast("long")})
    store.load(raw.ad_events.where(F.col("_loaded_at") > as_ntz(SINCE)), "second")
    wider.run(backfill=False)
    found = wider.fact()
    assert found.where("clicks_seen IS NULL").count() > 0 and found.where("clicks_seen IS NOT NULL").count() > 0
    assert_same(spark_rows(found.drop("clicks_seen")), spark_rows(rebuilt(raw.ad_events, raw)), "others")


def test_only_files_with_touched_ids_are_read(spark, kept):
    raw, store, fact = kept
    assert store.files_holding(store.events().limit(0).select("event_id")) == []
    every = {r[0] for r in store.read().select("_metadata.file_path").distinct().collect()}
    one = raw.ad_events.where(F.col("_loaded_at") == raw.ad_events.agg(F.min("_loaded_at")).first()[0]).select("event_id").limit(5)
    ids = [r[0] for r in one.collect()]
    touched = store.files_holding(spark.createDataFrame([(i,) for i in ids], "event_id string"))
    held = {r[0] for r in store.read().where(F.col("event_id").isin(ids)).select("_metadata.file_path").distinct().collect()}
    assert set(touched) == held and len(every) > 10 > len(held)
    assert {r.event_id for r in store.read_files(touched).collect()} >= set(ids)
    assert store.files_holding(spark.createDataFrame([("no such id",)], "event_id string")) == []
    assert set(store.files_holding(store.events().select("event_id"))) == every


def test_since_prunes_load_dates(spark, kept):
    _, store, _ = kept
    plan = store.after(SINCE)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan and "load_date#" in plan.split("PartitionFilters")[1][:80]


def test_the_query_reads_the_fact_and_few_files(spark):
    plan = catalog.run("fct_daily_incremental", spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "gen=" in plan
