"""Profiling queries over raw and modelled events (data-exploration write-up + metrics).

Global one-row results are single aggregates (partial per task, one tiny final merge).
Global shares use a window over an already aggregated, small relation (e.g. three event
types), never over raw rows. Distinct counts are exact (Spark plans them as an expand +
two-level hash aggregate, which spreads a hot key across tasks).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtally.functions.expr import mean_double, money_sum, pct, pct_nullif, ratio_pct, round_half_up
from adtally.plans.models import Models

DUPLICATE_ALERT_PCT = 1.0  # alert when more than 1 % of loaded rows are duplicates


def dup_event_ids(m: Models) -> DataFrame:
    """event ids loaded more than once."""
    return (m.raw.ad_events.groupBy("event_id").agg(F.count(F.lit(1)).alias("cnt"))
            .filter(F.col("cnt") > 1))


def duplicate_rate(m: Models, alert_pct: float = DUPLICATE_ALERT_PCT) -> DataFrame:
    """F2 (+ G8 alert): total rows, unique ids, duplicates, duplicate share."""
    r = m.raw.ad_events.agg(F.count(F.lit(1)).alias("total_events"),
                            F.count_distinct("event_id").alias("unique_events"))
    dup = F.col("total_events") - F.col("unique_events")
    return r.select("total_events", "unique_events", dup.alias("duplicate_count"),
                    F.when(F.col("total_events") > 0, round_half_up(ratio_pct(dup, "total_events"), 2))
                     .alias("duplicate_pct"),
                    F.when(F.col("total_events") > 0, ratio_pct(dup, "total_events") > alert_pct)
                     .otherwise(F.lit(False)).alias("duplicate_alert"))


def duplicate_nature(m: Models, salts: int = 16) -> DataFrame:
    """for each duplicated id, how many distinct timestamps / revenues / load times.

    The few repeated ids are found first; only their rows are expanded for the distinct counts. Rows meet their id by id
    and salt, so the copies of a hot id are dealt to as many tasks; the distinct counts then shuffle by id and value.
    """
    salt = F.pmod(F.xxhash64("event_timestamp", "revenue_usd", "_loaded_at", "publisher_id"), F.lit(salts)).cast("int")
    repeated = dup_event_ids(m).select("event_id", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    rows = m.raw.ad_events.select("event_id", "event_timestamp", "revenue_usd", "_loaded_at", salt.alias("salt"))
    return rows.join(repeated, ["event_id", "salt"], "left_semi").groupBy("event_id").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.count_distinct("event_timestamp").alias("distinct_timestamps"),
        F.count_distinct("revenue_usd").alias("distinct_revenues"),
        F.count_distinct("_loaded_at").alias("distinct_load_times"))


def ctr_by_publisher_domain(m: Models, k: int = 20) -> DataFrame:
    """top-k publisher x domain pairs by CTR, with volume, revenue and fill rate."""
    et = F.col("event_type")
    g = m.raw.ad_events.groupBy("publisher_id", "site_domain").agg(
        F.count(F.lit(1)).alias("events"),
        money_sum("revenue_usd").alias("revenue"),
        round_half_up(mean_double("revenue_usd"), 4).alias("avg_revenue"),
        F.count_if(F.col("is_filled") == 1).alias("filled"),
        F.count_if(et == "click").alias("clicks"),
        F.count_if(et == "impression").alias("impressions"))
    return (g.select("publisher_id", "site_domain", "events", "revenue", "avg_revenue",
                     round_half_up(ratio_pct("filled", "events"), 2).alias("fill_rate_pct"),
                     "clicks", "impressions", pct("clicks", "impressions", 4).alias("ctr_pct"))
            .orderBy(F.col("ctr_pct").desc(), "publisher_id", "site_domain").limit(k))


def negative_revenue_scale(m: Models) -> DataFrame:
    """negative-revenue rows, their total, and share of all rows (one pass)."""
    neg = F.col("revenue_usd") < 0
    return m.raw.ad_events.agg(
        F.count_if(neg).alias("negative_revenue_events"),
        F.sum(F.when(neg, F.col("revenue_usd"))).cast("decimal(38,6)").alias("total_negative_revenue"),
        F.count(F.lit(1)).alias("total_events"),
    ).select("negative_revenue_events", "total_negative_revenue",
             F.when(F.col("total_events") > 0, ratio_pct("negative_revenue_events", "total_events"))
              .alias("pct_of_total"))


def null_pattern(m: Models) -> DataFrame:
    """NULL campaign / NULL advertiser / unfilled counts side by side."""
    return m.raw.ad_events.agg(
        F.count_if(F.col("campaign_id").isNull()).alias("null_campaigns"),
        F.count_if(F.col("advertiser_id").isNull()).alias("null_advertisers"),
        F.count_if(F.col("is_filled") == 0).alias("unfilled_events"),
        F.count_if(F.col("campaign_id").isNull() & F.col("advertiser_id").isNull() & (F.col("is_filled") == 0))
         .alias("all_three"),
        F.count(F.lit(1)).alias("total"))


def revenue_by_fill_and_type(m: Models) -> DataFrame:
    """revenue statistics by fill state and event type."""
    return (m.raw.ad_events.groupBy("is_filled", "event_type").agg(
                F.count(F.lit(1)).alias("events"),
                money_sum("revenue_usd").alias("total_revenue"),
                round_half_up(mean_double("revenue_usd"), 6).alias("avg_revenue"),
                F.min("revenue_usd").alias("min_revenue"),
                F.max("revenue_usd").alias("max_revenue"))
            .orderBy(F.col("is_filled").desc(), "event_type"))


def negative_revenue_events(m: Models, k: int = 20) -> DataFrame:
    """F8: the k most negative revenue rows."""
    return (m.raw.ad_events.filter(F.col("revenue_usd") < 0)
            .orderBy(F.col("revenue_usd").asc(), F.col("event_id").asc(), F.col("_loaded_at").asc())
            .limit(k)
            .select("event_id", "event_type", "publisher_id", "site_domain", "campaign_id", "revenue_usd",
                    "bid_floor_usd", "is_filled", "event_timestamp"))


def revenue_by_event_type(m: Models) -> DataFrame:
    """revenue model by event type."""
    return m.raw.ad_events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        money_sum("revenue_usd").alias("total_revenue"),
        mean_double("revenue_usd").alias("avg_revenue"))


def time_coverage(m: Models) -> DataFrame:
    """first / last event and the day span between them."""
    r = m.raw.ad_events.agg(F.min("event_timestamp").alias("earliest"),
                            F.max("event_timestamp").alias("latest"))
    return r.select("earliest", "latest",
                    F.datediff(F.to_date("latest"), F.to_date("earliest")).alias("days_span"))


def top_domains(m: Models, k: int = 5) -> DataFrame:
    """top-k site domains by loaded rows."""
    return (m.raw.ad_events.groupBy("site_domain").agg(F.count(F.lit(1)).alias("events"))
            .orderBy(F.col("events").desc(), "site_domain").limit(k))


def daily_volume(m: Models) -> DataFrame:
    """average rows per day over the covered span (inclusive of both ends)."""
    r = m.raw.ad_events.agg(F.count(F.lit(1)).alias("total_events"),
                            F.min(F.to_date("event_timestamp")).alias("first_day"),
                            F.max(F.to_date("event_timestamp")).alias("last_day"))
    days = F.datediff("last_day", "first_day") + F.lit(1)
    return r.select("total_events", "first_day", "last_day", days.alias("days"),
                    round_half_up(F.col("total_events").cast("double") / days.cast("double"), 2)
                    .alias("avg_events_per_day"))


def table_row_counts(m: Models) -> DataFrame:
    """row counts of raw and staged tables (``count(*)`` checks)."""
    parts = [(n, getattr(m.raw, n)) for n in ("ad_events", "publishers", "campaigns", "ad_units")]
    parts += [(n, m.model(n)) for n in ("stg_ad_events", "stg_publishers", "stg_campaigns", "stg_ad_units")]
    out = None
    for name, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def network_fill_rate(m: Models) -> DataFrame:
    """Impression-weighted fill rate over all publisher-days."""
    r = m.fct_publisher_performance.agg(F.sum("filled_impressions").alias("filled_impressions"),
                                        F.sum("impressions").alias("impressions"))
    return r.select("filled_impressions", "impressions",
                    pct_nullif("filled_impressions", "impressions", 2).alias("fill_rate_pct"))


def revenue_concentration(m: Models, k: int = 5) -> DataFrame:
    """Share of network revenue earned by the top-k publishers.

    The top k come from ``orderBy().limit(k)`` (k rows per task, no global sort or window);
    the k rows and all per-publisher totals are tagged, unioned and summed in one aggregate
    (no cross join, no single-partition window over the publishers).
    """
    per_pub = m.fct_publisher_performance.groupBy("publisher_id").agg(
        F.sum("total_revenue_usd").alias("revenue"))
    top = (per_pub.orderBy(F.col("revenue").desc(), F.col("publisher_id").asc()).limit(k)
           .select(F.lit(True).alias("is_top"), "revenue"))
    tagged = top.unionByName(per_pub.select(F.lit(False).alias("is_top"), "revenue"))
    r = tagged.agg(F.sum(F.when(F.col("is_top"), F.col("revenue"))).cast("decimal(38,6)").alias("top_revenue"),
                   F.sum(F.when(~F.col("is_top"), F.col("revenue"))).cast("decimal(38,6)").alias("total_revenue"),
                   F.count_if(~F.col("is_top")).alias("publishers"))
    return r.select(F.lit(k).alias("top_k"), "top_revenue", "total_revenue", "publishers",
                    pct_nullif("top_revenue", "total_revenue", 2).alias("top_share_pct"))


def revenue_unit_economics(m: Models) -> DataFrame:
    """Revenue per event type: average, per-1000 (CPM-style) and share of revenue."""
    g = m.raw.ad_events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), money_sum("revenue_usd").alias("revenue"))
    total = F.sum("revenue").over(Window.partitionBy(F.lit(1)))
    avg = F.col("revenue").cast("double") / F.col("events").cast("double")
    return g.select("event_type", "events", "revenue",
                    round_half_up(avg, 4).alias("revenue_per_event"),
                    round_half_up(avg * F.lit(1000.0), 2).alias("revenue_per_mille"),
                    pct_nullif("revenue", total, 2).alias("revenue_share_pct"))


def replay_sample(m: Models, n: int = 2000, seed: int = 42) -> DataFrame:
    """H6: ``n`` raw rows in random order (the random-order limit that picks a replay batch).

    The order is a digest of seed, event id and load time, so it depends on the rows alone, not on
    files or tasks. Planned as a top-n per task, never a global sort.
    """
    loaded = F.date_format("_loaded_at", "yyyy-MM-dd HH:mm:ss")
    draw = F.md5(F.concat_ws("/", F.lit(str(seed)), F.col("event_id"), loaded))
    return (m.raw.ad_events.withColumn("__draw", draw)
            .orderBy("__draw", "event_id", "_loaded_at").limit(n).drop("__draw"))


def preview(m: Models, name: str = "fct_ad_events_daily", n: int = 5) -> DataFrame:
    """the first ``n`` rows of a model by its leading columns."""
    df = m.model(name)
    return df.orderBy(*df.columns[:7]).limit(n)
