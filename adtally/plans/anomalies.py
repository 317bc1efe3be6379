"""Seeded data conditions the reference leaves without a query, one detector each.

All run on deduplicated events. Lookups against publishers / campaigns / ad units are
equi-joins on the dimension key; Spark broadcasts the dimension only while its estimated
size is under ``spark.sql.autoBroadcastJoinThreshold`` (and AQE re-checks the real size),
otherwise it falls back to a sort-merge join, so nothing unbounded is ever broadcast.
The burst detector aggregates before comparing, so a hot publisher is pre-combined on the
map side.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.functions.expr import mean_double, money_sum, round_half_up
from adtally.plans.models import Models
from adtally.plans.staging import SUSPICIOUS_PUBLISHER_IDS, high_risk_publishers

AS_OF = dt.date(2024, 1, 31)


def _day_after(as_of: dt.date) -> F.Column:
    return F.lit((as_of + dt.timedelta(days=1)).isoformat() + " 00:00:00").cast("timestamp_ntz")


def country_case_anomalies(m: Models) -> DataFrame:
    """Country codes not in upper case, grouped by raw value."""
    e = m.stg_ad_events.filter(F.col("country_code") != F.upper("country_code"))
    return e.groupBy("country_code").agg(F.count(F.lit(1)).alias("events"),
                                         money_sum("revenue_usd").alias("revenue")) \
            .select("country_code", F.upper("country_code").alias("normalized_country_code"),
                    "events", "revenue")


def domain_mismatch(m: Models) -> DataFrame:
    """Events whose site domain differs from the publisher's primary domain."""
    pubs = m.stg_publishers.select("publisher_id", "primary_domain")
    return (m.stg_ad_events.join(pubs, "publisher_id")
            .filter(F.col("site_domain") != F.col("primary_domain"))
            .select("event_id", "publisher_id", "site_domain", "primary_domain", "event_date"))


def future_events(m: Models, as_of: dt.date = AS_OF) -> DataFrame:
    """S3: events stamped on or after the day after ``as_of``."""
    return (m.stg_ad_events.filter(F.col("event_timestamp") >= _day_after(as_of))
            .select("event_id", "publisher_id", "event_timestamp", "_loaded_at"))


def orphan_campaign_events(m: Models) -> DataFrame:
    """Events pointing at a campaign id missing from the campaign table."""
    camps = m.stg_campaigns.select("campaign_id")
    return (m.stg_ad_events.filter(F.col("campaign_id").isNotNull())
            .join(camps, "campaign_id", "left_anti")
            .select("event_id", "campaign_id", "advertiser_id", "publisher_id", "event_date"))


def out_of_flight_delivery(m: Models) -> DataFrame:
    """Delivery dated outside the campaign's flight (start..end inclusive)."""
    camps = m.stg_campaigns.select("campaign_id", "campaign_start_date", "campaign_end_date", "campaign_status")
    return (m.stg_ad_events.join(camps, "campaign_id")
            .filter(~F.col("event_date").between(F.col("campaign_start_date"), F.col("campaign_end_date")))
            .select("event_id", "campaign_id", "event_date", "campaign_start_date", "campaign_end_date",
                    "campaign_status"))


def traffic_bursts(m: Models, ratio: float = 10.0, min_events: int = 20) -> DataFrame:
    """Hourly (publisher, device, country, browser) groups far above the publisher's
    mean hourly group size."""
    hourly = m.stg_ad_events.groupBy(
        "publisher_id", F.date_trunc("hour", "event_timestamp").alias("event_hour"),
        "device_type", "country_code", "browser").agg(F.count(F.lit(1)).alias("events"))
    means = hourly.groupBy("publisher_id").agg(mean_double("events").alias("publisher_mean"))
    return (hourly.join(means, "publisher_id")
            .filter((F.col("events") >= min_events) &
                    (F.col("events").cast("double") > F.col("publisher_mean") * F.lit(ratio)))
            .select("publisher_id", "event_hour", "device_type", "country_code", "browser", "events",
                    round_half_up("publisher_mean", 4).alias("publisher_mean")))


def ad_unit_mismatch(m: Models) -> DataFrame:
    """Events served on an ad unit that belongs to another publisher."""
    units = m.stg_ad_units.select("ad_unit_id", F.col("publisher_id").alias("unit_publisher_id"))
    return (m.stg_ad_events.join(units, "ad_unit_id")
            .filter(F.col("publisher_id") != F.col("unit_publisher_id"))
            .select("event_id", "ad_unit_id", "publisher_id", "unit_publisher_id", "event_date"))


def advertiser_mismatch(m: Models) -> DataFrame:
    """Events whose advertiser differs from the campaign's advertiser."""
    camps = m.stg_campaigns.select("campaign_id", F.col("advertiser_id").alias("campaign_advertiser_id"))
    return (m.stg_ad_events.join(camps, "campaign_id")
            .filter(F.col("advertiser_id") != F.col("campaign_advertiser_id"))
            .select("event_id", "campaign_id", "advertiser_id", "campaign_advertiser_id", "event_date"))


def targeting_violations(m: Models) -> DataFrame:
    """Delivery to a device type or country outside the campaign's targeting lists."""
    camps = m.stg_campaigns.select(
        "campaign_id",
        F.split("targeting_device_types", ",").alias("devices"),
        F.split("targeting_countries", ",").alias("countries"))
    j = m.stg_ad_events.join(camps, "campaign_id")
    dev_bad = ~F.array_contains("devices", F.col("device_type"))
    cty_bad = ~F.array_contains("countries", F.col("country_code"))
    return (j.filter(dev_bad | cty_bad)
            .select("event_id", "campaign_id", "device_type", "country_code",
                    F.when(dev_bad, 1).otherwise(0).alias("device_violation"),
                    F.when(cty_bad, 1).otherwise(0).alias("country_violation")))


def inactive_unit_events(m: Models) -> DataFrame:
    """Events served on an inactive ad unit."""
    units = m.stg_ad_units.filter(F.col("is_active") == 0).select("ad_unit_id")
    return (m.stg_ad_events.join(units, "ad_unit_id", "left_semi")
            .select("event_id", "ad_unit_id", "publisher_id", "event_date"))


def below_floor_events(m: Models) -> DataFrame:
    """Filled events paid below the bid floor."""
    return (m.stg_ad_events.filter((F.col("is_filled") == 1) & (F.col("revenue_usd") < F.col("bid_floor_usd")))
            .select("event_id", "publisher_id", "event_type", "revenue_usd", "bid_floor_usd"))


def suspicious_flag_static(m: Models) -> DataFrame:
    """The fixed suspicious-publisher list next to the computed rule (CTR > 10 %), per
    publisher, with where they agree. Publishers come from the publisher dimension."""
    computed = high_risk_publishers(m.stg_ad_events).withColumn("computed", F.lit(1))
    p = m.stg_publishers.select("publisher_id").join(computed, "publisher_id", "left")
    static = F.col("publisher_id").isin(list(SUSPICIOUS_PUBLISHER_IDS))
    comp = F.col("computed").isNotNull()
    return p.select(
        "publisher_id",
        F.when(static, 1).otherwise(0).alias("in_static_list"),
        F.when(comp, 1).otherwise(0).alias("computed_high_risk"),
        F.when(static & comp, "both").when(static, "static_only").when(comp, "computed_only")
         .otherwise("neither").alias("agreement"))
