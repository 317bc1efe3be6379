"""Batches are held once: replayed streams after a fold, repeated appends, two writers, a crash between the steps."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from adtally.session import create_text, scratch_path
from adtally.sources import load
from adtally.sources.fixtures import raw_table, read_table
from adtally.sources.ledger import BatchLedger, Ledger, NamedLedger, in_ranges, joined_ranges
from adtally.sources.registry import from_testdata
from adtally.streaming import jobs
from tests.compare import assert_same, spark_rows
from tests.conftest import SF_SMALL


def test_ranges():
    assert joined_ranges([[0, 2]], [[3, 3], [7, 8]], [[5, 5]]) == [[0, 3], [5, 5], [7, 8]]
    assert in_ranges([[0, 3]], 3) and not in_ranges([[0, 3]], 4) and not in_ranges([], 0)


def test_a_file_is_created_once(spark):
    path = scratch_path(spark, "created") + "/a/1.json"
    assert create_text(spark, path, "first") and not create_text(spark, path, "second")


def test_two_writers_keep_both_changes(spark):
    root = scratch_path(spark, "two_writers")
    first, second = Ledger(spark, root), Ledger(spark, root)

    def edit(document):
        if "b" not in document:
            second.change(lambda d: {**d, "b": 1})  # another writer comes between read and write
        return {**document, "a": 1}

    first.change(edit)
    assert first.read() == (2, {"a": 1, "b": 1})


def stream(spark, source, out):
    return jobs.ctr_alert_stream(spark, source, out=out, max_files=1)


def test_a_replayed_batch_of_a_folded_stream_changes_nothing(spark):
    """The last batch is written and folded, but its commit is lost: the restart replays it."""
    source, out = scratch_path(spark, "replay_source"), scratch_path(spark, "replay_out")
    events = read_table(spark, SF_SMALL, "events")
    for i in range(4):
        events.where(f"event_id % 4 = {i}").coalesce(1).write.mode("append").parquet(f"{source}/events.parquet")
    stream(spark, source, out)
    like = jobs.ctr_counts(from_testdata(spark, SF_SMALL).ad_events)
    for name in ("3", ".3.crc"):
        shutil.move(f"{out}/_checkpoint/commits/{name}", f"{out}/lost-{name}")
    jobs.compact(spark, f"{out}/data", like, jobs.sum_ctr_counts)
    assert_same(spark_rows(stream(spark, source, out)), spark_rows(jobs.ctr_windows(like)), "after replay")
    more = events.withColumn("event_id", F.col("event_id") + 1000)
    more.coalesce(1).write.mode("append").parquet(f"{source}/events.parquet")
    grown = spark_rows(stream(spark, source, out))
    jobs.compact(spark, f"{out}/data", like, jobs.sum_ctr_counts)
    assert list(BatchLedger(spark, f"{out}/data").folders().values()) == [[[0, 4]]]
    assert_same(grown, spark_rows(jobs.ctr_windows(jobs.ctr_counts(raw_table(spark, source, "ad_events")))), "grown")
    assert_same(grown, spark_rows(jobs.ctr_windows(jobs.sum_ctr_counts(jobs.read_batches(spark, f"{out}/data", like)))), "folded again")


def test_a_crash_before_the_swap_leaves_the_batches(spark, monkeypatch):
    path = scratch_path(spark, "crash")
    events = from_testdata(spark, SF_SMALL).ad_events
    write = jobs.reduced_batches(path, jobs.lag_counts)
    write(events.where("publisher_id <= 10"), 0)
    write(events.where("publisher_id > 10"), 1)
    like = jobs.lag_counts(events)

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(BatchLedger, "fold", crash)
    with pytest.raises(RuntimeError):
        jobs.compact(spark, path, like, jobs.sum_lag_counts)
    monkeypatch.undo()
    for _ in range(2):
        assert_same(spark_rows(jobs.sum_lag_counts(jobs.read_batches(spark, path, like))), spark_rows(like), "crashed")
        jobs.compact(spark, path, like, jobs.sum_lag_counts)


def test_a_repeated_append_is_skipped(spark):
    path = scratch_path(spark, "append_once")
    raw = from_testdata(spark, SF_SMALL)
    raw.ad_events.write.parquet(path)
    batch = load.replay_batch(raw.ad_events.limit(50), dt.datetime(2025, 1, 1))
    for _ in range(2):
        assert load.append_batch(spark, batch, path, batch_id="2025-01-01").count() == 1016 + 50
    assert load.append_batch(spark, batch, path, batch_id="2025-01-02").count() == 1016 + 100
    assert set(NamedLedger(spark, path + ".batches").batches()) == {"2025-01-01", "2025-01-02"}


def test_literal_rows(spark):
    rows = load.literal_rows(spark, "publishers", [
        (1, "A", "news", "a.example", "AM", "GB", "2024-01-01 00:00:00", dt.datetime(2024, 2, 1)), {"publisher_id": "2", "publisher_name": None}])
    assert rows.schema == load.RAW_SCHEMAS["publishers"]
    first, second = rows.orderBy("publisher_id").collect()
    assert (first.created_at, first.updated_at) == (dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)) and second.publisher_id == 2 and second.country is None
    assert load.literal_rows(spark, "ad_units", []).count() == 0
    with pytest.raises(ValueError):
        load.literal_rows(spark, "publishers", [{"nope": 1}])
    with pytest.raises(ValueError):
        load.literal_rows(spark, "publishers", [(1, "short")])
