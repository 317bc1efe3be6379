"""Incremental maintenance of the daily fact, retention tiering and a write/read round trip.

Incremental rule (instead of the proposed ``event_date > max(event_date)`` high-water mark,
which loses late rows and is pushed past real days by future-dated events):

1. *touched dates*: every event date of a row loaded after ``since``, plus every date of an
   older version of such an event (a retry may move an event to another day);
2. recompute the fact for exactly those dates (dedup still sees every copy);
3. overwrite only those ``event_date`` partitions, and drop touched dates that have no rows any more.

Two scans of the raw events in all, a narrow one and the dedup's. Both reduce in every map task first, so a hot
retried id is a few rows. Joins carry no hints: Spark broadcasts a side only under its size threshold.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.functions.expr import money_sum
from adtally.plans import marts, staging
from adtally.plans.models import Models
from adtally.sources import io
from adtally.sources.event_store import EventStore
from adtally.sources.registry import RawSources

# ---- fixed values: defaults for the registered incremental / retention queries -----------
INCREMENTAL_SINCE = dt.datetime(2024, 1, 25, 0, 0, 0)
RETENTION_AS_OF = dt.date(2024, 1, 31)
RETENTION_DAYS = 730
# ---- end fixed values ----------------------------------------------------------------------


def _ts(value: dt.datetime) -> F.Column:
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def touched_dates(raw_events: DataFrame, since: dt.datetime) -> DataFrame:
    """All dates of the events that have a load after ``since``, in one narrow scan.

    Each map task reduces an id to its dates, so a hot retried id is a few values per task.
    """
    per_event = raw_events.groupBy("event_id").agg(
        F.max(F.col("_loaded_at") > _ts(since)).alias("is_new"),
        F.collect_set(F.to_date("event_timestamp")).alias("dates"))
    return per_event.where("is_new").select(F.explode("dates").alias("event_date")).distinct()


def fct_daily_for_dates(raw: RawSources, dates: DataFrame) -> DataFrame:
    """Fact rows of the given dates: an event counts on the date of its newest version, so one scan with the
    usual dedup decides, and only the events of these dates are aggregated."""
    return marts.fct_ad_events_daily(staging.stg_ad_events(raw).join(dates, "event_date", "left_semi"))


def fct_daily_incremental(m: Models, since: dt.datetime = INCREMENTAL_SINCE) -> DataFrame:
    """Fact rows recomputed for the dates touched by loads after ``since``."""
    return fct_daily_for_dates(m.raw, touched_dates(m.raw.ad_events, since))


def update_fact_table(raw: RawSources, path: str, since: dt.datetime) -> DataFrame:
    """Apply an incremental run to a written daily-fact table at ``path``."""
    touched = io.materialize("touched_dates", touched_dates(raw.ad_events, since))
    changed = io.materialize("fct_ad_events_daily", fct_daily_for_dates(raw, touched))
    io.replace_partitions("fct_ad_events_daily", changed, path)
    emptied = touched.join(changed.select("event_date").distinct(), "event_date", "left_anti")
    io.drop_dates(raw.spark, path, [r.event_date for r in emptied.collect()])  # calendar days
    return io.read_table(raw.spark, path, changed)


def repeated_since(store: EventStore, since: dt.datetime = INCREMENTAL_SINCE) -> DataFrame:
    """F1 / G1 for the loads after ``since``: their ids that are not unique, tested against the earlier loads' index."""
    earlier = [b for b in store.ledger.batches() if b != "after"]
    return store.repeated_ids(store.after(since), batches=earlier)


def mart_roundtrip(m: Models) -> DataFrame:
    """Materialise the daily fact (partitioned by date, sorted by key) and read it back."""
    return io.materialize("fct_ad_events_daily", m.fct_ad_events_daily)


def retention_tier(date_col: F.Column, as_of: dt.date, keep_days: int) -> F.Column:
    cutoff = F.date_sub(F.lit(as_of.isoformat()).cast("date"), keep_days)
    return F.when(date_col < cutoff, F.lit("archive")).otherwise(F.lit("hot"))


def retention_split(m: Models, as_of: dt.date = RETENTION_AS_OF, keep_days: int = RETENTION_DAYS) -> DataFrame:
    """Rows, days and revenue of the daily fact per storage tier (archive beyond keep_days)."""
    f = m.fct_ad_events_daily.withColumn("tier", retention_tier(F.col("event_date"), as_of, keep_days))
    return f.groupBy("tier").agg(F.count(F.lit(1)).alias("fact_rows"),
                                 F.count_distinct("event_date").alias("days"),
                                 F.min("event_date").alias("first_date"),
                                 F.max("event_date").alias("last_date"),
                                 money_sum("total_revenue_usd").alias("revenue"))


def archive_partitions(fact: DataFrame, archive_path: str, as_of: dt.date = RETENTION_AS_OF,
                       keep_days: int = RETENTION_DAYS, hot_path: str | None = None) -> None:
    """Move fact dates older than the retention window to ``archive_path``.

    Each date replaces its partition in the archive, so a repeated run changes nothing. With ``hot_path``
    (where ``fact`` is stored) the moved dates are then dropped there; without it they are copied.
    """
    old = fact.filter(retention_tier(F.col("event_date"), as_of, keep_days) == "archive")
    dates = [r.event_date for r in old.select("event_date").distinct().collect()]  # calendar days
    io.replace_partitions("fct_ad_events_daily", old, archive_path)
    if hot_path:
        io.drop_dates(fact.sparkSession, hot_path, dates)
