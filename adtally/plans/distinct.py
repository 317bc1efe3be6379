"""Mergeable distinct counts: HyperLogLog sketches kept by day and publisher, united for any span.

A sketch of ``LG_K`` = 12 takes at most about 2.6 KB and estimates with a relative standard error of 1.04 / sqrt(2^12) = 1.6 %
(small sets are counted almost exactly). That holds for united sketches, too, however many they are, so one pass over the
events serves every later question: any publishers, any days. Exact counts (``count_distinct``) need the events again each time.

Defined results: null values are not counted; a group without values has estimate 0; the union of no sketches is 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.plans.models import Models

LG_K = 12
RELATIVE_ERROR = 1.04 / 2 ** (LG_K / 2)
COUNTED = ("event_id", "site_domain", "ad_unit_id", "campaign_id")  # what is worth counting in raw events


def daily_sketches(events: DataFrame, counted: Sequence[str] = COUNTED, lg_k: int = LG_K) -> DataFrame:
    """Rows and one sketch for each counted column, by event date and publisher (partial sketches before the shuffle)."""
    return events.groupBy(F.to_date("event_timestamp").alias("event_date"), "publisher_id").agg(
        F.count(F.lit(1)).alias("rows"), *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(f"{c}_sketch") for c in counted])


def united(sketches: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Rows and estimated distinct counts over the given sketches, by any of their keys (or a span made of them)."""
    names = [c[: -len("_sketch")] for c in sketches.columns if c.endswith("_sketch")]
    return sketches.groupBy(*by).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                                     *[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{n}_sketch")), F.lit(0)).alias(f"{n}_estimate") for n in names])


def distinct_by_span(m: Models) -> DataFrame:
    """Distinct events and ad units by publisher and week: exact, and whether the united sketches agree within four errors."""
    events = m.raw.ad_events
    week = F.date_trunc("week", F.col("event_date")).cast("date").alias("week")
    keys = ["week", "publisher_id"]
    estimated = united(daily_sketches(events, ("event_id", "ad_unit_id")).select("*", week), keys)
    exact = events.select(F.to_date("event_timestamp").alias("event_date"), "publisher_id", "event_id", "ad_unit_id").select("*", week).groupBy(*keys).agg(
        F.count_distinct("event_id").alias("distinct_events"), F.count_distinct("ad_unit_id").alias("distinct_ad_units"))

    def near(estimate: str, count: str) -> Column:
        return F.abs(F.col(estimate) - F.col(count)) <= F.greatest(F.lit(1.0), F.col(count) * F.lit(4 * RELATIVE_ERROR))

    return exact.join(estimated, keys).select(
        *keys, F.col("rows").alias("loaded_rows"), "distinct_events", "distinct_ad_units",
        near("event_id_estimate", "distinct_events").alias("events_agree"), near("ad_unit_id_estimate", "distinct_ad_units").alias("ad_units_agree"))
