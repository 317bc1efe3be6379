"""Time-series and dimension extensions proposed by the design notes (P items).

* publisher history (type-2 versions), rolling 7/30-day publisher metrics
* device, geography, valid-vs-total traffic breakdowns, a date dimension, publisher cohorts

Rolling windows run over the publisher-day fact (one row per publisher and day), not over
events, with a RANGE frame on the day number so missing days are handled correctly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.functions.expr import money_sum, pct, pct_nullif
from adtally.operators.dedup import version_history
from adtally.plans.models import Models


ROLLING_BLOCK = 4  # a block of days is this many windows long


def publishers_scd2(m: Models) -> DataFrame:
    """Every publisher version with valid_from / valid_to (NULL = current)."""
    return version_history(m.raw.publishers, ["publisher_id"], "updated_at").select(
        "publisher_id", "publisher_name", "publisher_category", "primary_domain", "account_manager",
        "country", "valid_from", "valid_to", "is_current")


def halo_blocks(day: Column, days: int, block_days: int) -> Column:
    """The blocks of days that need a day's row: its own, and the next if its windows reach back to the row."""
    own = F.floor(day / block_days).cast("int")
    reaches = F.pmod(day, F.lit(block_days)) > block_days - days
    return F.when(reaches, F.array(own, own + 1)).otherwise(F.array(own))


def with_missing_days(perf: DataFrame, counts: Sequence[str]) -> DataFrame:
    """Publisher-days with a row of zeros for every day between a publisher's first and last that has none."""
    span = perf.groupBy("publisher_id").agg(F.min("event_date").alias("first"), F.max("event_date").alias("last"))
    kinds = dict(perf.dtypes)
    zeros = span.select(F.explode(F.sequence("first", "last")).alias("event_date"), "publisher_id",
                        *[F.lit(0).cast(kinds[c]).alias(c) for c in counts], F.lit(0).alias("active"))
    every = perf.select("event_date", "publisher_id", *counts, F.lit(1).alias("active")).unionByName(zeros)
    return every.groupBy("event_date", "publisher_id").agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in counts], F.max("active").alias("active"))


def rolling_metrics(m: Models, days: int, missing_days: bool = False) -> DataFrame:
    """C4: trailing ``days``-day sums per publisher (inclusive of the current day).

    A publisher's days are cut in blocks, and the last ``days - 1`` days of a block are given to the next as well, so windows
    of one publisher are spread over tasks however long its history is. ``missing_days`` adds the days without events.
    """
    counts = ["impressions", "clicks", "filled_impressions", "total_revenue_usd"]
    perf = m.fct_publisher_performance
    perf = with_missing_days(perf, counts) if missing_days else perf.select("event_date", "publisher_id", *counts, F.lit(1).alias("active"))
    day = F.unix_date("event_date")
    block_days = ROLLING_BLOCK * days
    placed = perf.select("*", day.alias("day_no"), F.explode(halo_blocks(day, days, block_days)).alias("block"))
    w = Window.partitionBy("publisher_id", "block").orderBy("day_no").rangeBetween(-(days - 1), 0)
    r = placed.select(
        "event_date", "publisher_id", "block", "day_no",
        F.sum("impressions").over(w).alias("impressions"),
        F.sum("clicks").over(w).alias("clicks"),
        F.sum("filled_impressions").over(w).alias("filled_impressions"),
        F.sum("total_revenue_usd").over(w).cast("decimal(38,6)").alias("revenue"),
        F.sum("active").over(w).alias("active_days")).where(F.col("block") == F.floor(F.col("day_no") / block_days))
    return r.select("event_date", "publisher_id", F.lit(days).alias("window_days"), "impressions", "clicks",
                    "revenue", "active_days",
                    pct("clicks", "impressions", 4).alias("ctr_pct"),
                    pct("filled_impressions", "impressions", 2).alias("fill_rate_pct"))


def rolling_7d_filled(m: Models) -> DataFrame:
    """C4 with the days on which a publisher had no events."""
    return rolling_metrics(m, 7, missing_days=True)


def rolling_7d_metrics(m: Models) -> DataFrame:
    return rolling_metrics(m, 7)


def rolling_30d_metrics(m: Models) -> DataFrame:
    return rolling_metrics(m, 30)


def _traffic_measures(df: DataFrame, *keys) -> DataFrame:
    et = F.col("event_type")
    g = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(et == "impression").alias("impressions"),
        F.count_if((et == "impression") & (F.col("is_filled") == 1)).alias("filled_impressions"),
        F.count_if(et == "click").alias("clicks"),
        F.count_if(et == "viewable_impression").alias("viewable_impressions"),
        money_sum("revenue_usd").alias("revenue"))
    return g.withColumn("ctr_pct", pct("clicks", "impressions", 4)) \
            .withColumn("fill_rate_pct", pct("filled_impressions", "impressions", 2)) \
            .withColumn("viewability_rate_pct", pct("viewable_impressions", "impressions", 2))


def device_performance(m: Models) -> DataFrame:
    """Performance by device type."""
    return _traffic_measures(m.stg_ad_events, "device_type")


def geo_revenue(m: Models) -> DataFrame:
    """Performance by country, case-normalised."""
    e = m.stg_ad_events.withColumn("country", F.upper("country_code"))
    return _traffic_measures(e, "country")


def valid_vs_total_traffic(m: Models) -> DataFrame:
    """Per day, all traffic next to traffic from non-suspicious publishers."""
    et = F.col("event_type")
    valid = F.col("is_suspicious_traffic") == 0
    g = m.stg_ad_events.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(valid).alias("valid_events"),
        F.count_if(et == "impression").alias("total_impressions"),
        F.count_if(valid & (et == "impression")).alias("valid_impressions"),
        F.count_if(et == "click").alias("total_clicks"),
        F.count_if(valid & (et == "click")).alias("valid_clicks"),
        money_sum("revenue_usd").alias("total_revenue"),
        F.sum(F.when(valid, F.col("revenue_usd")).otherwise(F.lit(0).cast("decimal(18,6)")))
         .cast("decimal(38,6)").alias("valid_revenue"))
    return g.select("*", pct("total_clicks", "total_impressions", 4).alias("total_ctr_pct"),
                    pct("valid_clicks", "valid_impressions", 4).alias("valid_ctr_pct"),
                    pct_nullif("valid_events", "total_events", 2).alias("valid_share_pct"))


def dim_dates(m: Models) -> DataFrame:
    """One row per calendar day between the first and last event date."""
    span = m.stg_ad_events.agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("date_day"))
    return days.select(
        "date_day",
        F.year("date_day").alias("year"), F.month("date_day").alias("month"),
        F.dayofmonth("date_day").alias("day_of_month"),
        F.dayofweek("date_day").alias("day_of_week"),
        F.weekofyear("date_day").alias("iso_week"),
        F.when(F.dayofweek("date_day").isin(1, 7), 1).otherwise(0).alias("is_weekend"),
        F.date_format("date_day", "yyyyMM").alias("year_month"))


def publisher_cohorts(m: Models) -> DataFrame:
    """Publishers by creation month x activity month: active publishers and revenue."""
    pubs = m.stg_publishers.select("publisher_id", F.trunc(F.to_date("created_at"), "month").alias("cohort_month"))
    act = m.fct_publisher_performance.select(
        "publisher_id", F.trunc("event_date", "month").alias("activity_month"), "total_revenue_usd", "total_events")
    j = act.join(pubs, "publisher_id")
    return j.groupBy("cohort_month", "activity_month").agg(
        F.count_distinct("publisher_id").alias("active_publishers"),
        F.sum("total_events").alias("events"),
        F.sum("total_revenue_usd").cast("decimal(38,6)").alias("revenue"))
