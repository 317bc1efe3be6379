"""Raw ad tables derived deterministically from the driver's read-only parquet tables.

The reference seeds its raw tables with a random generator; here the same seeded conditions
(retry copies, unfilled slots, negative revenue, orphan campaigns, a bot burst, late loads,
casing and id mismatches) are derived by rule from ``events``, ``nation`` and ``part`` so
that events and campaigns grow with the input scale (publishers and ad units come from the whole of
``nation``). Three events in ten go to one campaign, one campaign in fifty is never served, and one event in 211
names a campaign that does not exist. The rules are fixed values: they must stay
exactly as below so Spark and the DuckDB oracle see identical inputs.

Each text is a Spark SQL statement over DataFrame parameters (``{events}`` etc.), run with
``spark.sql(text, events=df)`` so no global temp view is registered.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# ---- fixed values: fixture derivation rules (must match the oracle's copy) -------------
RAW_AD_EVENTS_CTES = """
WITH base AS (
  SELECT event_id AS eid, ts, value, event_type AS st,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
         CAST(1 + event_id % 20 AS INT) AS pub
  FROM {events}),
typed AS (
  SELECT *, CASE
      WHEN pub = 20 THEN CASE WHEN st = 'view' THEN 'impression' ELSE 'click' END
      WHEN st = 'error' THEN 'viewable_impression'
      WHEN st = 'click' AND pub IN (5,9,11,13,15,17,19) THEN 'click'
      WHEN st = 'click' AND pub IN (3,4,6) AND k < 30 THEN 'click'
      WHEN st = 'click' AND k < 3 THEN 'click'
      ELSE 'impression' END AS et,
    CASE WHEN k < 15 THEN NULL
         WHEN eid % 211 = 0 THEN CAST(-1 - eid % 3 AS INT)
         WHEN eid % 10 < 3 OR eid DIV 5 % 50 = 49 THEN 1
         ELSE CAST(1 + eid DIV 5 AS INT) END AS camp
  FROM base),
shaped AS (
  SELECT CAST(eid AS STRING) AS event_id, et AS event_type,
    CASE WHEN pub = 13 AND k >= 50 THEN TIMESTAMP_NTZ '2024-01-15 02:00:00' + (eid % 14400) * INTERVAL '1' SECOND
         WHEN eid % 333 = 0 THEN ts + INTERVAL '31' DAY
         ELSE ts END AS event_timestamp,
    pub AS publisher_id,
    concat('site', CAST(CASE WHEN eid % 97 = 0 THEN pub % 20 + 1 ELSE pub END AS STRING), '.example') AS site_domain,
    concat('au_', CAST(CASE WHEN eid % 89 = 0 THEN pub % 20 + 1 ELSE pub END AS STRING), '_', CAST(1 + k % 3 AS STRING)) AS ad_unit_id,
    camp AS campaign_id,
    CAST(CASE WHEN camp IS NULL THEN NULL WHEN camp < 0 THEN 10 - camp
         WHEN eid % 151 = 0 THEN 1 + camp % 10 ELSE 1 + (camp - 1) % 10 END AS INT) AS advertiser_id,
    CASE WHEN pub = 13 AND k >= 50 THEN 'mobile' WHEN k % 9 < 3 THEN 'desktop' WHEN k % 9 < 7 THEN 'mobile' WHEN k % 9 = 7 THEN 'tablet' ELSE 'ctv' END AS device_type,
    CASE WHEN pub = 13 AND k >= 50 THEN 'BR'
         WHEN eid % 41 = 0 THEN 'us'
         WHEN eid % 7 < 3 THEN 'US' WHEN eid % 7 = 3 THEN 'GB' WHEN eid % 7 = 4 THEN 'DE' WHEN eid % 7 = 5 THEN 'FR' ELSE 'JP' END AS country_code,
    CASE WHEN pub = 13 AND k >= 50 THEN 'Samsung Internet' WHEN k % 8 < 3 THEN 'Chrome' WHEN k % 8 < 5 THEN 'Safari' WHEN k % 8 = 5 THEN 'Firefox' ELSE 'Edge' END AS browser,
    CAST(CASE WHEN k < 15 THEN 0 WHEN et = 'impression' AND eid % 80 = 1 THEN -1 ELSE 1 END
         * CASE WHEN et = 'click' THEN value / 100 WHEN et = 'viewable_impression' THEN value / 10000 ELSE value / 10000 END AS DECIMAL(18,6)) AS revenue_usd,
    CAST((10 + k % 50) AS DECIMAL(18,6)) / 10000 AS bid_floor_raw,
    CAST(CASE WHEN k < 15 THEN 0 ELSE 1 END AS INT) AS is_filled,
    CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ) + CASE WHEN eid % 333 = 0 THEN INTERVAL '39' DAY WHEN eid % 61 = 0 THEN INTERVAL '4' DAY ELSE INTERVAL '1' DAY END + INTERVAL '6' HOUR AS loaded_at,
    eid
  FROM typed)
"""

# Base rows plus one retry copy (loaded 6 hours later) of every event with event_id % 65 = 0.
RAW_AD_EVENTS_UNION_TAIL = """
SELECT event_id, event_type, event_timestamp, publisher_id, site_domain, ad_unit_id, campaign_id, advertiser_id,
       device_type, country_code, browser, revenue_usd, CAST(bid_floor_raw AS DECIMAL(18,6)) AS bid_floor_usd, is_filled, loaded_at AS _loaded_at
FROM shaped
UNION ALL
SELECT event_id, event_type, event_timestamp, publisher_id, site_domain, ad_unit_id, campaign_id, advertiser_id,
       device_type, country_code, browser, revenue_usd, CAST(bid_floor_raw AS DECIMAL(18,6)), is_filled, loaded_at + INTERVAL '6' HOUR
FROM shaped WHERE eid % 65 = 0
"""

# Same rows in one pass over ``events``: a generator emits the retry copy next to its
# original instead of a second scan + union (half the scan and expression work).
RAW_AD_EVENTS_GENERATE_TAIL = """
SELECT event_id, event_type, event_timestamp, publisher_id, site_domain, ad_unit_id, campaign_id, advertiser_id,
       device_type, country_code, browser, revenue_usd, CAST(bid_floor_raw AS DECIMAL(18,6)) AS bid_floor_usd, is_filled,
       loaded_at + copy_no * INTERVAL '6' HOUR AS _loaded_at
FROM shaped LATERAL VIEW explode(CASE WHEN eid % 65 = 0 THEN array(0, 1) ELSE array(0) END) copies AS copy_no
"""

RAW_PUBLISHERS_SQL = """
SELECT CAST(n_nationkey + 1 AS INT) AS publisher_id, concat('Publisher ', CAST(n_nationkey + 1 AS STRING)) AS publisher_name,
 CASE WHEN n_regionkey = 4 THEN 'mobile_gaming' WHEN n_regionkey = 3 THEN 'entertainment' ELSE 'gaming' END AS publisher_category,
 concat('site', CAST(n_nationkey + 1 AS STRING), '.example') AS primary_domain, concat('AM ', CAST(n_nationkey % 7 AS STRING)) AS account_manager,
 CASE WHEN n_nationkey % 3 = 0 THEN 'GB' ELSE 'US' END AS country,
 TIMESTAMP_NTZ '2023-01-15 00:00:00' + n_nationkey * INTERVAL '1' DAY AS created_at, TIMESTAMP_NTZ '2023-06-01 00:00:00' + n_nationkey * INTERVAL '1' DAY AS updated_at FROM {nation}
UNION ALL
SELECT CAST(7 AS INT), 'Publisher 7 Renamed', 'gaming', 'site7.example', 'AM 6', 'GB', TIMESTAMP_NTZ '2023-01-21 00:00:00', TIMESTAMP_NTZ '2024-01-10 00:00:00'
"""

RAW_CAMPAIGNS_SQL = """
SELECT CAST(p_partkey + 1 AS INT) AS campaign_id, p_name AS campaign_name, CAST(1 + p_partkey % 10 AS INT) AS advertiser_id,
 concat('Advertiser ', CAST(1 + p_partkey % 10 AS STRING)) AS advertiser_name,
 DATE '2023-12-15' + CAST(p_partkey % 40 AS INT) AS campaign_start_date, DATE '2024-01-05' + CAST(p_partkey % 40 AS INT) AS campaign_end_date,
 CAST(CASE WHEN p_partkey % 31 = 30 THEN 0 ELSE p_retailprice END AS DECIMAL(18,2)) AS campaign_budget_usd,
 CASE WHEN p_partkey % 9 = 7 THEN 'completed' ELSE 'active' END AS campaign_status,
 CASE WHEN p_partkey % 3 = 0 THEN 'desktop' WHEN p_partkey % 3 = 1 THEN 'desktop,mobile' ELSE 'desktop,mobile,ctv' END AS targeting_device_types,
 CASE WHEN p_partkey % 2 = 0 THEN 'US,GB' ELSE 'US,GB,DE,FR' END AS targeting_countries,
 TIMESTAMP_NTZ '2023-12-01 00:00:00' AS created_at
FROM {part}
"""

# Three units per publisher: a generator (explode) rather than a join with a literal table.
RAW_AD_UNITS_SQL = """
SELECT concat('au_', CAST(n_nationkey + 1 AS STRING), '_', CAST(i AS STRING)) AS ad_unit_id, CAST(n_nationkey + 1 AS INT) AS publisher_id,
 concat('Unit ', CAST(n_nationkey + 1 AS STRING), '/', CAST(i AS STRING)) AS ad_unit_name, CASE WHEN i = 3 THEN 'video' WHEN n_nationkey % 4 = 2 AND i = 2 THEN 'native' ELSE 'display' END AS ad_format,
 CASE WHEN i = 1 THEN '728x90' WHEN i = 2 THEN '300x250' ELSE '640x480' END AS ad_size, CASE WHEN i = 1 THEN 'above_fold' ELSE 'in_content' END AS placement_type,
 CAST(CASE WHEN n_nationkey = 4 AND i = 3 THEN 0 ELSE 1 END AS INT) AS is_active, TIMESTAMP_NTZ '2023-02-01 00:00:00' AS created_at
FROM {nation} LATERAL VIEW explode(array(1, 2, 3)) units AS i
"""
# ---- end fixed values ------------------------------------------------------------------

RAW_AD_EVENTS_SQL = RAW_AD_EVENTS_CTES + RAW_AD_EVENTS_UNION_TAIL  # reference form (oracle)
RAW_AD_EVENTS_SPARK_SQL = RAW_AD_EVENTS_CTES + RAW_AD_EVENTS_GENERATE_TAIL

_INPUTS = {
    "ad_events": (RAW_AD_EVENTS_SPARK_SQL, "events"),
    "publishers": (RAW_PUBLISHERS_SQL, "nation"),
    "campaigns": (RAW_CAMPAIGNS_SQL, "part"),
    "ad_units": (RAW_AD_UNITS_SQL, "nation"),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw table (``ad_events`` / ``publishers`` / ``campaigns`` / ``ad_units``)."""
    text, source = _INPUTS[name]
    return spark.sql(text, **{source: read_table(spark, sf_dir, source)})
