"""Live alerts: the same hours as the batch query for any order of the files, alerts while the stream runs, nothing late is lost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adtally.session import scratch_path
from adtally.sources.fixtures import raw_table, read_table
from adtally.sources.registry import from_testdata
from adtally.sources.schemas import RAW_SCHEMAS
from adtally.streaming import alerts, jobs
from tests.compare import assert_same, spark_rows
from tests.conftest import SF_SMALL


def pieces(spark, name, order, modulo):
    """Event files in a given order; with ``modulo`` each spans all days, else each is some days."""
    folder = scratch_path(spark, name)
    events = read_table(spark, SF_SMALL, "events")
    part = F.col("event_id") % 4 if modulo else F.least(F.lit(3), F.floor((F.dayofmonth("ts") - 1) / 8))
    for i in order:
        events.where(part == i).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    return folder


def expected(spark):
    return jobs.ctr_windows(jobs.ctr_counts(from_testdata(spark, SF_SMALL).ad_events))


@pytest.mark.parametrize("name,order,modulo", [("by_day", (0, 1, 2, 3), False), ("backwards", (3, 2, 1, 0), False), ("mixed", (2, 0, 3, 1), True)])
def test_any_order_of_files_gives_the_batch_result(spark, name, order, modulo):
    folder, out = pieces(spark, f"alerts_{name}", order, modulo), scratch_path(spark, f"alerts_out_{name}")
    done = alerts.live_alert_stream(spark, folder, out=out, max_files=1)
    assert_same(spark_rows(done), spark_rows(expected(spark)), name)
    changes = jobs.read_batches(spark, f"{out}/data", spark.createDataFrame([], alerts.CHANGES))
    kinds = {r.kind: r.n for r in changes.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert kinds["open"] > 0 and kinds.get("closed", 0) > 0
    if name != "by_day":
        assert kinds["late"] > 0


def test_alerts_stand_in_the_output_of_the_batch_that_causes_them(spark):
    out, source = scratch_path(spark, "alerts_live"), scratch_path(spark, "alerts_live_source")
    like = raw_table(spark, SF_SMALL, "ad_events").limit(1).collect()[0].asDict()
    at = dt.datetime(2024, 1, 2, 10)

    def load(kinds, hour, when):
        rows = [tuple({**like, "event_id": f"{when}{i}", "publisher_id": 1, "event_type": k, "event_timestamp": hour, "_loaded_at": when}.values()) for i, k in enumerate(kinds)]
        spark.createDataFrame(rows, raw_table(spark, SF_SMALL, "ad_events").schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        events = spark.readStream.schema(raw_table(spark, SF_SMALL, "ad_events").schema).parquet(source)
        return alerts.run_alerts(spark, events, out, grace=dt.timedelta(hours=3), delay="0 seconds")

    load(["impression"] * 10, at, at + dt.timedelta(hours=1))
    assert [r.is_alert for r in run().collect()] == [False]
    load(["click"], at, at + dt.timedelta(hours=2))
    load(["impression"], dt.datetime(2024, 3, 1), at + dt.timedelta(hours=2))  # dated ahead: closes nothing
    assert run().where("is_alert").select("impressions", "clicks", "kind").collect() == [(10, 1, "open")]
    load(["impression"], at + dt.timedelta(hours=9), at + dt.timedelta(hours=10))  # the clock passes the hour's end and grace
    assert run().where(F.col("window_start") == F.lit(at)).where("kind = 'closed'").count() == 1
    load(["impression"] * 10, at, at + dt.timedelta(hours=11))
    rows = run()
    assert rows.where("kind = 'late'").select("impressions", "clicks").collect() == [(10, 0)]
    total = alerts.totals(rows).where(F.col("window_start") == F.lit(at)).first()
    assert (total.impressions, total.clicks) == (20, 1)
    assert alerts.totals(rows).where("window_start >= timestamp_ntz '2024-03-01 00:00:00'").first().impressions == 1


def test_null_times_are_late_and_missing_loads_do_not_move_the_clock(spark):
    source, out = scratch_path(spark, "alerts_null_source"), scratch_path(spark, "alerts_null")
    schema = RAW_SCHEMAS["ad_events"]
    like = raw_table(spark, SF_SMALL, "ad_events").limit(1).collect()[0].asDict()
    like |= {"event_timestamp": dt.datetime(2024, 1, 2, 10), "_loaded_at": dt.datetime(2024, 1, 2, 11)}
    rows = [{**like, "event_timestamp": None}, {**like, "_loaded_at": None, "event_type": "click"}, {**like, "publisher_id": None, "event_type": None}]
    spark.createDataFrame([tuple(r.values()) for r in rows], schema).coalesce(1).write.parquet(source)
    done = alerts.run_alerts(spark, spark.readStream.schema(schema).parquet(source), out).collect()
    assert sorted((r.window_start is None, r.kind) for r in done) == [(False, "open"), (False, "open"), (True, "late")]
