"""Clustered files, unique ids by load, duplicates of a hot id."""

import datetime as dt
import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from adtally import catalog
from adtally.plans import profiling
from adtally.plans.models import Models
from adtally.session import scratch_path
from adtally.sources import clustered
from adtally.sources.event_store import EventStore
from adtally.sources.registry import from_testdata
from tests.compare import assert_same, spark_rows
from tests.conftest import SF_MID, SF_SMALL
from tests.test_incremental import _events


def spared(path, column, value):
    """Share of the row groups whose statistics exclude a value."""
    groups = [g for f in glob.glob(f"{path}/*.parquet") for g in [pq.ParquetFile(f).metadata]]
    found = []
    for meta in groups:
        for i in range(meta.num_row_groups):
            stats = next(c.statistics for c in (meta.row_group(i).column(j) for j in range(meta.num_columns)) if c.path_in_schema == column)
            found.append(not stats.min <= value <= stats.max)
    return sum(found) / len(found)


def test_files_are_spared_for_either_column(spark):
    events = from_testdata(spark, SF_MID).ad_events
    sorted_path, path = scratch_path(spark, "sorted"), scratch_path(spark, "clustered")
    events.repartitionByRange(16, "event_timestamp", "publisher_id").sortWithinPartitions("event_timestamp", "publisher_id").write.parquet(sorted_path)
    clustered.write_clustered(events, path, ["event_timestamp", "publisher_id"], 16)
    at = dt.datetime(2024, 1, 10, 12)
    assert spared(path, "publisher_id", 7) >= 0.5 > 0.1 >= spared(sorted_path, "publisher_id", 7)
    assert spared(path, "event_timestamp", at) >= 0.5
    stored = spark.read.schema(events.schema).parquet(path)
    assert_same(spark_rows(stored), spark_rows(events), "clustered")
    ranges = clustered.file_ranges(stored, ["publisher_id"]).collect()
    assert sum(r.rows for r in ranges) == events.count() and all(r.first_publisher_id <= r.last_publisher_id for r in ranges)


def test_hot_null_and_single_values(spark):
    rows = [(None, 1, "x")] * 500 + [(dt.datetime(2024, 1, 1), 1, None)] * 500 + [(dt.datetime(2024, 1, d), 1, f"s{d}") for d in range(1, 20)]
    df = spark.createDataFrame(rows, "at timestamp_ntz, one int, name string").withColumn("id", F.monotonically_increasing_id())
    path = scratch_path(spark, "hot_values")
    clustered.write_clustered(df, path, ["at", "one", "name"], 4)
    sizes = [r.rows for r in clustered.file_ranges(spark.read.schema(df.schema).parquet(path), ["id"]).collect()]
    assert sum(sizes) == 1019 and max(sizes) <= 500
    clustered.write_clustered(df.limit(0), path, ["at", "name"], 4)
    assert spark.read.schema(df.schema).parquet(path).count() == 0


def test_repeated_ids_of_a_load(spark):
    raw = from_testdata(spark, SF_SMALL)
    day = lambda d: dt.datetime(2024, 1, d, 10)
    store = EventStore(spark, scratch_path(spark, "unique"))
    store.load(_events(raw, [("a", day(1), day(2)), ("b", day(1), day(2)), ("b", day(1), day(3)), (None, day(1), day(2))]), "one")
    fresh = _events(raw, [("a", day(1), day(4)), ("c", day(1), day(4)), ("d", day(1), day(4)), ("d", day(1), day(4)), (None, day(1), day(4))])
    assert sorted(map(tuple, store.repeated_ids(fresh).collect())) == [("a", 2), ("d", 2)]
    assert store.repeated_ids(fresh.limit(0)).count() == 0


def test_duplicates_of_a_hot_id_are_dealt(spark):
    raw = from_testdata(spark, SF_SMALL)
    rows = [("hot", dt.datetime(2024, 1, 1 + i % 5, 10), dt.datetime(2024, 1, 10) + dt.timedelta(minutes=i % 50)) for i in range(500)]
    m = Models(raw.replace(ad_events=raw.ad_events.union(_events(raw, rows))))
    found = {r.event_id: r for r in profiling.duplicate_nature(m).collect()}
    assert tuple(found["hot"])[1:] == (500, 5, 1, 50)
    plan = profiling.duplicate_nature(catalog.models_for(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "salt" in plan.split("LeftSemi")[1][:120]
