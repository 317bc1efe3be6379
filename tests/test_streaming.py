"""Streaming jobs equal their batch counterparts for any split and order of the input."""

import pytest

from adtally.plans import staging
from adtally.session import scratch_path
from adtally.sources.fixtures import read_table
from adtally.sources.registry import from_testdata
from adtally.streaming import jobs
from tests.compare import assert_same, spark_rows
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def pieces(spark):
    """The events as a folder of four files in id-modulo order: every file spans all days and loads."""
    folder = scratch_path(spark, "events_in_pieces")
    events = read_table(spark, SF_SMALL, "events")
    for i in (2, 0, 3, 1):
        events.where(f"event_id % 4 = {i}").coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    return folder


def batch_events(spark):
    return from_testdata(spark, SF_SMALL).ad_events


BATCH = {
    "ctr": lambda e: jobs.ctr_windows(jobs.ctr_counts(e)),
    "dedup": lambda e: staging.dedup_events(e).drop("_loaded_at"),
    "lag": jobs.lag_counts,
}
STREAM = {"ctr": jobs.ctr_alert_stream, "dedup": jobs.dedup_stream, "lag": jobs.lag_stream}


@pytest.mark.parametrize("name", sorted(STREAM))
def test_stream_over_one_file(spark, name):
    assert_same(spark_rows(STREAM[name](spark, SF_SMALL)), spark_rows(BATCH[name](batch_events(spark))), name)


@pytest.mark.parametrize("name", sorted(STREAM))
def test_stream_over_four_micro_batches_loses_nothing(spark, pieces, name):
    out = scratch_path(spark, f"stream_{name}")
    got = STREAM[name](spark, pieces, out=out, max_files=1)
    folders = {r[0] for r in spark.read.parquet(out + "/data").select("batch_id").distinct().collect()}
    assert len(folders) == 4
    assert_same(spark_rows(got), spark_rows(BATCH[name](batch_events(spark))), name)


def test_future_dated_rows_stay(spark, pieces):
    got = jobs.dedup_stream(spark, pieces, max_files=1)
    assert got.where("event_timestamp >= timestamp_ntz '2024-02-01 00:00:00'").count() == 4


def test_replayed_batch_replaces_itself_and_compaction_keeps_the_result(spark):
    path = scratch_path(spark, "replayed")
    events = batch_events(spark)
    write = jobs.reduced_batches(path, jobs.lag_counts)
    for batch_id, rows in ((0, events.where("publisher_id <= 10")), (1, events.where("publisher_id > 10")), (1, events.where("publisher_id > 10"))):
        write(rows, batch_id)
    like = jobs.lag_counts(events)
    assert_same(spark_rows(jobs.sum_lag_counts(jobs.read_batches(spark, path, like))), spark_rows(like), "replay")
    jobs.compact(spark, path, like, jobs.sum_lag_counts)
    assert [r[0] for r in spark.read.parquet(path).select("batch_id").distinct().collect()] == [jobs.COMPACTED]
    assert_same(spark_rows(jobs.sum_lag_counts(jobs.read_batches(spark, path, like))), spark_rows(like), "compacted")


def test_no_batch_yet_reads_as_empty(spark):
    like = jobs.lag_counts(batch_events(spark))
    assert jobs.read_batches(spark, scratch_path(spark, "nothing"), like).count() == 0
