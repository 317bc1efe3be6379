"""Click-through alerts while the stream runs: keyed state with timers on load time.

Counts are kept by publisher and hour. Each micro-batch gives the hours it changed (kind ``open``, with the counts so far and whether
the rate is above the threshold), so an alert stands in the output as soon as the batch that causes it is done. An hour is closed
when the clock has passed its end by ``grace``: a timer gives its last counts (``closed``) and its state is dropped. What comes for a
closed hour is given beside (``late``, as counts to add). Readers take the last counts of each hour and add the late ones, so
nothing is lost whatever the order of the files, and the result equals the batch query.

The clock is the watermark of the load time, not of the event time: events dated days ahead keep their hours open until loads
get there, and do not make later events late. The watermark node sees every row, but the rows reach the state without the
watermark's mark on a column, for Spark would drop those behind it instead of letting them be given as late.

Scale: each task counts its rows by publisher and hour before the shuffle, so a publisher with a third of all events is a few rows
for each task; the state holds open hours only; output rows are written once for each batch (see ``sources/ledger.py``).

Defined results: a null event time has no hour and is late at once; rows without load time do not move the clock.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from adtally.session import temporary_path
from adtally.streaming import jobs

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the library

HOUR = dt.timedelta(hours=1)
GRACE = dt.timedelta(days=2)  # how long after its end an hour stays open, in load time
DELAY = "1 hour"  # how far the clock stays behind the newest load
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COUNTS = "publisher_id int, window_start timestamp_ntz, impressions long, clicks long"
CHANGES = f"{COUNTS}, kind string, change long, is_alert boolean"
_EPOCH = dt.datetime(1970, 1, 1)


def _milliseconds(at: dt.datetime) -> int:
    return (at - _EPOCH) // dt.timedelta(milliseconds=1)


def hourly_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by publisher and hour of each batch of events."""
    for batch in batches:
        kind = batch.column("event_type")
        table = pa.table({
            "publisher_id": batch.column("publisher_id"), "window_start": pc.floor_temporal(batch.column("event_timestamp"), unit="hour"),
            "impressions": pc.fill_null(pc.equal(kind, "impression"), False).cast(pa.int64()),
            "clicks": pc.fill_null(pc.equal(kind, "click"), False).cast(pa.int64())})
        done = table.group_by(["publisher_id", "window_start"]).aggregate([("impressions", "sum"), ("clicks", "sum")])
        done = done.select(["publisher_id", "window_start", "impressions_sum", "clicks_sum"]).rename_columns(["publisher_id", "window_start", "impressions", "clicks"])
        yield from done.combine_chunks().to_batches()


class HourlyCounts(StatefulProcessor):
    """State of one publisher's hour: (impressions, clicks, number of changes)."""

    def __init__(self, grace: dt.timedelta, threshold: float):
        self.grace, self.threshold = grace, threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "impressions long, clicks long, change long")

    def _row(self, key: tuple, impressions: int, clicks: int, kind: str, change: int) -> Row:
        alert = impressions > 0 and clicks * 100.0 / impressions > self.threshold
        return Row(publisher_id=key[0], window_start=key[1], impressions=impressions, clicks=clicks, kind=kind, change=change, is_alert=alert)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        impressions = clicks = 0
        for row in rows:
            impressions, clicks = impressions + row.impressions, clicks + row.clicks
        closes = None if key[1] is None else _milliseconds(key[1] + HOUR + self.grace)
        if closes is None or closes <= timerValues.getCurrentWatermarkInMs():
            yield self._row(key, impressions, clicks, "late", 0)
            return
        change = 0
        if self.counts.exists():
            before = self.counts.get()
            impressions, clicks, change = impressions + before[0], clicks + before[1], before[2]
        else:
            self.handle.registerTimer(closes)
        self.counts.update((impressions, clicks, change + 1))
        yield self._row(key, impressions, clicks, "open", change + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.counts.exists():
            impressions, clicks, change = self.counts.get()
            self.counts.clear()
            yield self._row(key, impressions, clicks, "closed", change + 1)

    def close(self) -> None:
        pass


def alert_changes(events: DataFrame, grace: dt.timedelta = GRACE, delay: str = DELAY, threshold: float = jobs.CTR_ALERT_PCT) -> DataFrame:
    """Streaming rows of ``CHANGES`` from streaming raw events."""
    clocked = events.select("publisher_id", "event_timestamp", "event_type", F.col("_loaded_at").cast("timestamp").alias("loaded")).withWatermark("loaded", delay)
    return (clocked.mapInArrow(hourly_counts, COUNTS).groupBy("publisher_id", "window_start")
            .transformWithState(HourlyCounts(grace, threshold), CHANGES, "Update", "EventTime"))


def totals(changes: DataFrame) -> DataFrame:
    """Counts of every hour: the last ones given, and what came late."""
    late = F.col("kind") == "late"
    order = F.when(late, F.lit(-1)).otherwise(F.col("change"))
    last = F.max_by(F.struct(F.when(late, F.lit(0)).otherwise(F.col("impressions")).alias("impressions"),
                             F.when(late, F.lit(0)).otherwise(F.col("clicks")).alias("clicks")), order)
    summed = changes.groupBy("publisher_id", "window_start").agg(
        last.alias("last"), F.coalesce(F.sum(F.when(late, F.col("impressions"))), F.lit(0)).alias("late_impressions"),
        F.coalesce(F.sum(F.when(late, F.col("clicks"))), F.lit(0)).alias("late_clicks"))
    return summed.select("window_start", (F.col("window_start") + F.expr("INTERVAL '1' HOUR")).alias("window_end"), "publisher_id",
                         (F.col("last.impressions") + F.col("late_impressions")).alias("impressions"),
                         (F.col("last.clicks") + F.col("late_clicks")).alias("clicks"))


def run_alerts(spark: SparkSession, events: DataFrame, out: str, grace: dt.timedelta = GRACE, delay: str = DELAY) -> DataFrame:
    """Run the alert stream over everything available; returns all its rows so far."""
    given = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        jobs.run_available_now(alert_changes(events, grace, delay).writeStream.outputMode("update")
                               .foreachBatch(jobs.reduced_batches(out + "/data", lambda rows: rows)), out + "/_checkpoint")
    finally:
        if given is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", given)
    return jobs.read_batches(spark, out + "/data", spark.createDataFrame([], CHANGES))


def live_alert_stream(spark: SparkSession, sf_dir: str, out: str | None = None, max_files: int | None = None) -> DataFrame:
    """J1 with state: hourly rates and alerts from the stream's changes."""
    changes = run_alerts(spark, jobs.raw_event_stream(spark, sf_dir, max_files), out or temporary_path(spark, "stream_live_alerts"))
    return jobs.ctr_windows(totals(changes).where("window_start IS NOT NULL"))
