"""Incremental fact maintenance equals a full rebuild; materialised marts equal lazy ones."""

import datetime as dt

from pyspark.sql import functions as F

from adtally.plans import incremental, marts, pipeline, staging
from adtally.plans.models import Models
from adtally.session import scratch_path
from adtally.sources import io
from adtally.sources.registry import from_testdata
from tests.compare import assert_same, spark_rows
from tests.conftest import SF_SMALL


def test_incremental_update_equals_full_rebuild(spark):
    raw = from_testdata(spark, SF_SMALL)
    since = dt.datetime(2024, 1, 20, 0, 0, 0)
    # state before the run: only what was loaded up to ``since``
    before = raw.replace(ad_events=raw.ad_events.filter(F.col("_loaded_at") <= F.lit("2024-01-20 00:00:00")
                                                        .cast("timestamp_ntz")))
    path = scratch_path(spark, "fct_incremental_test")
    io.write_mart("fct_ad_events_daily", marts.fct_ad_events_daily(staging.stg_ad_events(before)), path)
    updated = incremental.update_fact_table(raw, path, since)
    full = marts.fct_ad_events_daily(staging.stg_ad_events(raw))
    assert_same(spark_rows(updated), spark_rows(full), "incremental")


def test_touched_dates_include_moved_events(spark):
    # a retry that moves an event to another day must recompute both days
    rows = [("a", dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 2)),
            ("a", dt.datetime(2024, 1, 5, 10), dt.datetime(2024, 1, 6)),
            ("b", dt.datetime(2024, 1, 3, 10), dt.datetime(2024, 1, 4))]
    df = spark.createDataFrame(rows, "event_id string, event_timestamp timestamp_ntz, _loaded_at timestamp_ntz")
    got = {r.event_date for r in incremental.touched_dates(df, dt.datetime(2024, 1, 5)).collect()}
    assert got == {dt.date(2024, 1, 1), dt.date(2024, 1, 5)}


def test_pipeline_build_matches_lazy_models(spark):
    raw = from_testdata(spark, SF_SMALL)
    built = pipeline.build_marts(raw, scratch_path(spark, "build_test"))
    lazy = Models(raw)
    for name in ("fct_ad_events_daily", "fct_publisher_performance", "dim_publishers", "dim_campaigns"):
        assert_same(spark_rows(built.model(name)), spark_rows(lazy.model(name)), name)


def test_month_partition_column(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), 1, 1), (dt.date(2024, 2, 1), 1, 1)], "event_date date, publisher_id int, campaign_id int")
    path = scratch_path(spark, "by_month")
    io.write_mart("fct_ad_events_daily", df, path, by_month=True)
    assert {str(r.event_month) for r in spark.read.parquet(path).collect()} == {"202401", "202402"}


def _events(raw, rows):
    """Rows (event_id, event_timestamp, loaded) as raw events that are otherwise like the first fixture event."""
    like = raw.ad_events.limit(1).collect()[0].asDict()
    made = [{**like, "event_id": e, "event_timestamp": t, "_loaded_at": l} for e, t, l in rows]
    return raw.spark.createDataFrame([tuple(m[c] for c in raw.ad_events.columns) for m in made], raw.ad_events.schema)


def test_update_drops_dates_that_a_retry_emptied(spark):
    raw = from_testdata(spark, SF_SMALL)
    day = lambda d: dt.datetime(2024, 1, d, 10)
    first = [("a", day(1), day(2)), ("b", day(3), day(4))]
    before = raw.replace(ad_events=_events(raw, first))
    after = raw.replace(ad_events=_events(raw, first + [("a", day(5), day(6))]))
    path = scratch_path(spark, "emptied")
    io.write_mart("fct_ad_events_daily", marts.fct_ad_events_daily(staging.stg_ad_events(before)), path)
    updated = incremental.update_fact_table(after, path, day(5))
    assert_same(spark_rows(updated), spark_rows(marts.fct_ad_events_daily(staging.stg_ad_events(after))), "emptied date")
    assert {r.event_date.day for r in updated.collect()} == {3, 5}


def test_update_with_a_hot_retried_id(spark):
    raw = from_testdata(spark, SF_SMALL)
    rows = [("hot", dt.datetime(2024, 1, 1 + i % 5, 10), dt.datetime(2024, 1, 10) + dt.timedelta(minutes=i)) for i in range(400)]
    hot = raw.replace(ad_events=raw.ad_events.union(_events(raw, rows)).repartition(6))
    path = scratch_path(spark, "hot_id")
    io.write_mart("fct_ad_events_daily", marts.fct_ad_events_daily(staging.stg_ad_events(raw)), path)
    updated = incremental.update_fact_table(hot, path, dt.datetime(2024, 1, 9))
    assert_same(spark_rows(updated), spark_rows(marts.fct_ad_events_daily(staging.stg_ad_events(hot))), "hot id")


def test_refresh_replaces_the_table(spark):
    raw = from_testdata(spark, SF_SMALL)
    root = scratch_path(spark, "refreshed")
    pipeline.build_marts(raw, root)
    cut = raw.replace(ad_events=raw.ad_events.where("event_timestamp < timestamp_ntz '2024-01-10 00:00:00'"))
    again = pipeline.build_marts(cut, root).fct_ad_events_daily
    assert_same(spark_rows(again), spark_rows(Models(cut).fct_ad_events_daily), "second build")


def test_archive_moves_dates_once(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 1, 1), (dt.date(2024, 1, 1), 2, 2)],
                               "event_date date, publisher_id int, campaign_id int")
    hot, archive = scratch_path(spark, "hot"), scratch_path(spark, "archive")
    io.write_mart("fct_ad_events_daily", df, hot)
    for _ in range(2):  # a repeated run changes nothing
        stored = io.read_table(spark, hot, df)
        incremental.archive_partitions(stored, archive, as_of=dt.date(2024, 1, 31), keep_days=730, hot_path=hot)
        assert [r.publisher_id for r in io.read_table(spark, archive, df).collect()] == [1]
        assert [r.publisher_id for r in io.read_table(spark, hot, df).collect()] == [2]


def test_models_follow_the_source_files(spark):
    from adtally import catalog
    from adtally.sources.fixtures import read_table

    folder = scratch_path(spark, "growing")
    for name in ("events", "nation", "part"):
        read_table(spark, SF_SMALL, name).write.parquet(f"{folder}/{name}.parquet")
    assert catalog.run("duplicate_rate", spark, folder).first().unique_events == 1000
    moved = read_table(spark, SF_SMALL, "events").selectExpr("event_id + 1000 AS event_id", "* EXCEPT (event_id)")
    moved.select(read_table(spark, SF_SMALL, "events").columns).write.mode("append").parquet(f"{folder}/events.parquet")
    assert catalog.run("duplicate_rate", spark, folder).first().unique_events == 2000
    assert catalog.run("table_row_counts", spark, folder).where("table_name = 'stg_ad_events'").first().row_count == 2000


def test_replay_batch_appends_and_dedup_stays_right(spark):
    from adtally.plans import profiling
    from adtally.sources.load import append_batch, load_testdata, replay_batch

    root = scratch_path(spark, "appended")
    raw = from_testdata(spark, SF_SMALL)
    raw.ad_events.write.parquet(root)
    m = Models(raw)
    sample = profiling.replay_sample(m, n=50)
    assert_same(spark_rows(sample), spark_rows(profiling.replay_sample(Models(raw.replace(ad_events=raw.ad_events.repartition(7))), n=50)), "layout")
    grown = append_batch(spark, replay_batch(sample, dt.datetime(2025, 1, 1)), root)
    assert grown.count() == 1016 + 50
    after = staging.dedup_events(grown)
    assert after.count() == 1000
    assert after.where("_loaded_at = timestamp_ntz '2025-01-01 00:00:00'").count() == sample.select("event_id").distinct().count()
    assert_same(spark_rows(after.drop("_loaded_at")), spark_rows(staging.dedup_events(raw.ad_events).drop("_loaded_at")), "replay")


def test_registry_binds_stored_tables(spark):
    from adtally.sources.registry import RAW_TABLES, from_tables

    raw = from_testdata(spark, SF_SMALL)
    paths = {n: scratch_path(spark, n) for n in RAW_TABLES}
    for n in RAW_TABLES:
        getattr(raw, n).write.parquet(paths[n])
    bound = from_tables(spark, paths)
    assert_same(spark_rows(Models(bound).dim_campaigns), spark_rows(Models(raw).dim_campaigns), "bound")


def test_cluster_conf_scales_with_input():
    from adtally.session import cluster_conf
    big = cluster_conf(100 * 2**40, total_cores=4000)          # 100 TB on 1000 x 4 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)  # about 256 MB each, no cap
    small = cluster_conf(10 * 2**20, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16      # at least two waves of tasks


def test_submitted_settings_stand():
    import subprocess
    import sys

    from tests.conftest import ROOT
    code = ("from adtally.session import get_spark; s = get_spark('local[1]'); "
            "print('CONF', s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.driver.memory'))")
    env = {**__import__("os").environ, "PYTHONPATH": ROOT,
           "PYSPARK_SUBMIT_ARGS": "--conf spark.sql.shuffle.partitions=777 --driver-memory 600m pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120).stdout
    assert "CONF 777 600m" in out


def test_no_machine_local_checkpoints_off_local_masters():
    import pytest

    from adtally.session import checkpoint_root, is_local

    class Context:
        master, applicationId = "spark://host:7077", "app-none"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})()

    assert is_local("local[4]") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")
    with pytest.raises(RuntimeError):
        checkpoint_root(Session())


def test_rounding_beyond_eight_digits(spark):
    from adtally.functions.expr import round_half_up
    got = spark.range(1).select(round_half_up(F.lit(1.23456e10), 2).alias("x")).first().x
    assert got == 1.23456e10


def test_cluster_conf_keys_are_settable(spark):
    from adtally.session import cluster_conf
    conf = cluster_conf(10 * 2**40, total_cores=400)
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
            assert spark.conf.get(k) == v
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
