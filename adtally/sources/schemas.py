"""Typed schemas of the four raw source tables.

Unsigned ids map to ``int`` (Spark has no unsigned types), 0/1 flags stay ``int`` (data
tests accept the values 0 and 1), money is ``decimal(18,6)`` / ``decimal(18,2)`` and all
timestamps are zone-less (``timestamp_ntz``) so day boundaries do not depend on a session
time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW_PUBLISHERS = T.StructType([
    T.StructField("publisher_id", T.IntegerType()),
    T.StructField("publisher_name", T.StringType()),
    T.StructField("publisher_category", T.StringType()),
    T.StructField("primary_domain", T.StringType()),
    T.StructField("account_manager", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

RAW_CAMPAIGNS = T.StructType([
    T.StructField("campaign_id", T.IntegerType()),
    T.StructField("campaign_name", T.StringType()),
    T.StructField("advertiser_id", T.IntegerType()),
    T.StructField("advertiser_name", T.StringType()),
    T.StructField("campaign_start_date", T.DateType()),
    T.StructField("campaign_end_date", T.DateType()),
    T.StructField("campaign_budget_usd", T.DecimalType(18, 2)),
    T.StructField("campaign_status", T.StringType()),
    T.StructField("targeting_device_types", T.StringType()),
    T.StructField("targeting_countries", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

RAW_AD_UNITS = T.StructType([
    T.StructField("ad_unit_id", T.StringType()),
    T.StructField("publisher_id", T.IntegerType()),
    T.StructField("ad_unit_name", T.StringType()),
    T.StructField("ad_format", T.StringType()),
    T.StructField("ad_size", T.StringType()),
    T.StructField("placement_type", T.StringType()),
    T.StructField("is_active", T.IntegerType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

RAW_AD_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_timestamp", T.TimestampNTZType()),
    T.StructField("publisher_id", T.IntegerType()),
    T.StructField("site_domain", T.StringType()),
    T.StructField("ad_unit_id", T.StringType()),
    T.StructField("campaign_id", T.IntegerType()),
    T.StructField("advertiser_id", T.IntegerType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("browser", T.StringType()),
    T.StructField("revenue_usd", T.DecimalType(18, 6)),
    T.StructField("bid_floor_usd", T.DecimalType(18, 6)),
    T.StructField("is_filled", T.IntegerType()),
    T.StructField("_loaded_at", T.TimestampNTZType()),
])

RAW_SCHEMAS = {
    "publishers": RAW_PUBLISHERS,
    "campaigns": RAW_CAMPAIGNS,
    "ad_units": RAW_AD_UNITS,
    "ad_events": RAW_AD_EVENTS,
}
