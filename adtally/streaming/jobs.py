"""Structured Streaming variants: CTR alerting, retry dedup and load-lag monitoring.

Source: the raw event derivation runs unchanged over ``readStream`` of the event files (the same SQL text, so
the stream and the batch models see identical rows).

No query keeps state or a watermark: the data holds future-dated rows, and a watermark that follows
them would count all later rows as late and lose them. Every micro-batch is reduced on its own, written
under its batch id and entered in a ledger (see ``sources/ledger.py``); readers fold the folders that the ledger
names. So the results equal the batch queries for any order and split of the input, also when batches are replayed.
Alerts while the stream runs are those of ``streaming/alerts.py``, which keeps state.

* ``ctr_alert_stream``   clicks and impressions per publisher and hour; batches are summed on read.
* ``dedup_stream``       the newest load of every event id in a batch; of several batches the newest again,
  as the batch model does.
* ``lag_stream``         load-lag buckets (``_loaded_at - event_timestamp``); batches are summed on read.

``compact`` folds the batches into one, also of a running stream. ``run_available_now`` drives a query over
everything currently in the source and stops; results land under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.functions.expr import pct, ratio_pct
from adtally.plans.staging import dedup_events
from adtally.session import child_names, delete_path, is_directory, temporary_path
from adtally.sources import fixtures
from adtally.sources.ledger import BatchLedger

CTR_ALERT_PCT = 5.0  # alert when hourly CTR exceeds 5 %
COMPACTED = -1  # number of the first folder of folded batches; later ones go down


def raw_event_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw events as a stream; ``events.parquet`` is a folder of part files or one file."""
    source = f"{sf_dir}/events.parquet"
    reader = spark.readStream.schema(spark.read.parquet(source).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if is_directory(spark, source):
        events = reader.parquet(source)
    else:  # a file source watches a folder; the glob keeps it to the event file
        events = reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return spark.sql(fixtures.RAW_AD_EVENTS_SPARK_SQL, events=events)


# ---- hourly click-through rate ---------------------------------------------------------------
def ctr_counts(events: DataFrame, window: str = "1 hour") -> DataFrame:
    et = F.col("event_type")
    return (events.groupBy(F.window(F.col("event_timestamp").cast("timestamp"), window).alias("w"), "publisher_id")
            .agg(F.count_if(et == "impression").alias("impressions"), F.count_if(et == "click").alias("clicks"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "publisher_id", "impressions", "clicks"))


def sum_ctr_counts(batches: DataFrame) -> DataFrame:
    return (batches.groupBy("window_start", "window_end", "publisher_id")
            .agg(F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks")))


def ctr_windows(counts: DataFrame, threshold: float = CTR_ALERT_PCT) -> DataFrame:
    return counts.select(
        "window_start", "window_end", "publisher_id", "impressions", "clicks",
        pct("clicks", "impressions", 4).alias("ctr_pct"),
        ((F.col("impressions") > 0) & (ratio_pct("clicks", "impressions") > threshold)).alias("is_alert"))


# ---- load lag ----------------------------------------------------------------------------------
def lag_bucket(events: DataFrame) -> F.Column:
    hours = (F.unix_timestamp(F.col("_loaded_at").cast("timestamp")) -
             F.unix_timestamp(F.col("event_timestamp").cast("timestamp"))) / F.lit(3600.0)
    return (F.when(hours < 0, F.lit("loaded_before_event"))
            .when(hours <= 24, F.lit("within_1d"))
            .when(hours <= 48, F.lit("1d_to_2d"))
            .when(hours <= 168, F.lit("2d_to_7d"))
            .otherwise(F.lit("over_7d")))


def lag_counts(events: DataFrame) -> DataFrame:
    return (events.groupBy(lag_bucket(events).alias("lag_bucket"))
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(F.col("is_filled") == 1).alias("filled_rows")))


def sum_lag_counts(batches: DataFrame) -> DataFrame:
    return batches.groupBy("lag_bucket").agg(F.sum("rows").alias("rows"), F.sum("filled_rows").alias("filled_rows"))


def newest_loads(batches: DataFrame) -> DataFrame:
    return dedup_events(batches)


# ---- batches on disk ---------------------------------------------------------------------------
def reduced_batches(path: str, reduce: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: the reduced batch is written to a folder of its id and entered in the ledger.

    A replayed batch that the ledger holds, also in folded form, is skipped; what an earlier try left is replaced.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        ledger = BatchLedger(batch.sparkSession, path)
        if not ledger.holds(batch_id):
            reduce(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            ledger.add(f"batch_id={batch_id}", batch_id)
    return write


def read_batches(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Rows of the folders that the ledger names."""
    return _read_folders(spark, path, list(BatchLedger(spark, path).folders()), like)


def _read_folders(spark: SparkSession, path: str, folders: list[str], like: DataFrame) -> DataFrame:
    if not folders:  # no batch yet
        return spark.createDataFrame([], like.schema)
    return spark.read.schema(like.schema).parquet(*[f"{path}/{f}" for f in folders]).select(*like.columns)


def compact(spark: SparkSession, path: str, like: DataFrame, fold: Callable[[DataFrame], DataFrame]) -> None:
    """Fold the batches into one folder, also while the stream runs.

    The folded folder is written under a new number below zero, the ledger then names it in place of the others, and these
    are deleted last. A crash at any point leaves readers with one of the two states.
    """
    ledger = BatchLedger(spark, path)
    folders = list(ledger.folders())
    if not folders:
        return
    number = min([COMPACTED + 1, *[int(name.split("=")[1]) for name in child_names(spark, path) if name.startswith("batch_id=")]]) - 1
    fold(_read_folders(spark, path, folders, like)).select(*like.columns).write.mode("overwrite").parquet(f"{path}/batch_id={number}")
    ledger.fold(folders, f"batch_id={number}")
    for folder in folders:
        delete_path(spark, f"{path}/{folder}")


def run_available_now(query_builder, checkpoint: str) -> None:
    """Run a query over everything available now, then stop."""
    q = query_builder.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _run(spark: SparkSession, sf_dir: str, out: str, reduce, max_files: int | None) -> tuple[str, DataFrame]:
    events = raw_event_stream(spark, sf_dir, max_files)
    run_available_now(events.writeStream.foreachBatch(reduced_batches(out + "/data", reduce)), out + "/_checkpoint")
    return out + "/data", reduce(spark.createDataFrame([], events.schema))


def ctr_alert_stream(spark: SparkSession, sf_dir: str, out: str | None = None, max_files: int | None = None) -> DataFrame:
    """Run the hourly CTR stream to the end of the available input; return its table."""
    data, like = _run(spark, sf_dir, out or temporary_path(spark, "stream_ctr_alert"), ctr_counts, max_files)
    return ctr_windows(sum_ctr_counts(read_batches(spark, data, like)))


def dedup_stream(spark: SparkSession, sf_dir: str, out: str | None = None, max_files: int | None = None) -> DataFrame:
    """Retry-copy dedup on the stream; returns the deduplicated events (without _loaded_at)."""
    data, like = _run(spark, sf_dir, out or temporary_path(spark, "stream_dedup"), newest_loads, max_files)
    return newest_loads(read_batches(spark, data, like)).drop("_loaded_at")


def lag_stream(spark: SparkSession, sf_dir: str, out: str | None = None, max_files: int | None = None) -> DataFrame:
    """J3 (stream): load-lag buckets of everything available."""
    data, like = _run(spark, sf_dir, out or temporary_path(spark, "stream_lag"), lag_counts, max_files)
    return sum_lag_counts(read_batches(spark, data, like))
