"""Oracle SQL per registered query name (DuckDB dialect, self-contained)."""

from __future__ import annotations

from oracle.sql import build, cnt, money, pct, pct_nullif, rnd

ORACLE: dict[str, str] = {}


def oracle(name: str, final: str, *deps: str) -> None:
    ORACLE[name] = build(final, *deps)


# ---- sources / staging / marts ----------------------------------------------------------
oracle("raw_events_union", "SELECT * FROM raw_ad_events", "raw_ad_events")
for _m in ("stg_ad_events", "stg_publishers", "stg_campaigns", "stg_ad_units",
           "fct_ad_events_daily", "fct_publisher_performance", "dim_publishers",
           "dim_campaigns", "dim_ad_units"):
    oracle(_m, f"SELECT * FROM {_m}", _m)

# ---- dashboard --------------------------------------------------------------------------
# the fixed short names of the dashboard
LABELS = """VALUES ('GameSpot Digital', 'GameSpot'), ('IGN Entertainment', 'IGN'), ('Polygon Media', 'Polygon'),
           ('Eurogamer Network', 'Eurogamer'), ('Kotaku Digital', 'Kotaku'), ('The Gamer Network', 'The Gamer')"""
oracle("chart_revenue_top5", f"""
, days AS (SELECT *, sum(total_revenue_usd) OVER (PARTITION BY publisher_id) AS lifetime FROM fct_publisher_performance),
placed AS (SELECT *, dense_rank() OVER (ORDER BY lifetime DESC, publisher_id) AS place FROM days)
SELECT event_date, ifnull(short, publisher_name) AS publisher, {money('total_revenue_usd')} AS revenue
FROM placed JOIN dim_publishers USING (publisher_id) LEFT JOIN ({LABELS}) AS labels(name, short) ON name = publisher_name
WHERE place <= 5 GROUP BY ALL""", "fct_publisher_performance", "dim_publishers")

oracle("chart_fill_rate", f"""
, per_publisher AS (
  SELECT publisher_id, sum(filled_impressions) AS filled, sum(impressions) AS shown FROM fct_publisher_performance GROUP BY ALL
), per_name AS (
  SELECT any_value((SELECT publisher_name FROM dim_publishers d WHERE d.publisher_id = t.publisher_id)) AS publisher,
         {pct_nullif('sum(filled)', 'sum(shown)', 2)} AS fill_rate_pct
  FROM per_publisher t SEMI JOIN dim_publishers USING (publisher_id)
  GROUP BY (SELECT publisher_name FROM dim_publishers d WHERE d.publisher_id = t.publisher_id)
)
SELECT publisher, fill_rate_pct FROM per_name
""", "fct_publisher_performance", "dim_publishers")

oracle("chart_click_fraud_risk", f"""
, bounds(above, tier) AS (VALUES (-1, 'Normal'), (5, 'Monitor'), (10, 'High Risk'), (100, 'CRITICAL - Fraud'))  -- fixed values
, measured AS (
  SELECT publisher_id, publisher_name AS publisher, clicks, impressions, clicks::DOUBLE * 100.0 / impressions AS exact
  FROM dim_publishers WHERE impressions > 10
), tiered AS (
  SELECT publisher_id, any_value(publisher) AS publisher, any_value({rnd('exact', 2)}) AS ctr_pct, any_value(clicks) AS clicks,
         any_value(impressions) AS impressions, arg_max(tier, above) AS risk_level
  FROM measured JOIN bounds ON exact > above GROUP BY publisher_id
)
SELECT * EXCLUDE (publisher_id) FROM tiered QUALIFY row_number() OVER (ORDER BY ctr_pct DESC, publisher_id) <= 15
""", "dim_publishers")

oracle("inventory_snapshot", """
SELECT entity, count_value FROM (
  SELECT 'publishers' AS entity, CAST(count(*) AS DOUBLE) AS count_value FROM raw_publishers
  UNION ALL SELECT 'campaigns', CAST(count(*) AS DOUBLE) FROM raw_campaigns
  UNION ALL SELECT 'ad_units', CAST(count(*) AS DOUBLE) FROM raw_ad_units) t
""", "raw_publishers", "raw_campaigns", "raw_ad_units")

# ---- data tests -------------------------------------------------------------------------
# the declared column tests, stated here for themselves: model, column, tests
DECLARED = """
stg_ad_events event_id unique not_null
stg_ad_events event_type not_null in:impression,click,viewable_impression
stg_ad_events event_timestamp not_null
stg_ad_events event_date not_null
stg_ad_events publisher_id not_null parent:stg_publishers
stg_ad_events is_filled not_null in:0,1
stg_ad_events is_suspicious_traffic in:0,1
stg_ad_events has_negative_revenue in:0,1
stg_publishers publisher_id unique not_null
stg_publishers publisher_name not_null
stg_campaigns campaign_id unique not_null
stg_campaigns campaign_name not_null
stg_ad_units ad_unit_id unique not_null
stg_ad_units publisher_id not_null parent:stg_publishers
dim_publishers publisher_id unique not_null
dim_publishers publisher_name not_null
dim_campaigns campaign_id unique not_null
dim_campaigns campaign_name not_null
dim_ad_units ad_unit_id unique not_null
fct_ad_events_daily event_date not_null
fct_ad_events_daily publisher_id not_null
fct_publisher_performance event_date not_null
fct_publisher_performance publisher_id not_null
"""



def _failures(model: str, column: str, rule: str) -> str:
    kind, _, arg = rule.partition(":")
    if kind == "unique":
        return f"SELECT count(*) FILTER (WHERE n > 1) FROM (SELECT count(*) AS n FROM {model} WHERE {column} IS NOT NULL GROUP BY {column})"
    if kind == "not_null":
        return f"SELECT count(*) - count({column}) FROM {model}"
    if kind == "in":
        listed = ", ".join(f"'{v}'" for v in arg.split(","))
        return f"SELECT count(DISTINCT {column}) FROM {model} WHERE CAST({column} AS VARCHAR) NOT IN ({listed})"
    return f"SELECT count(*) FROM {model} c ANTI JOIN {arg} p ON c.{column} = p.{column} WHERE c.{column} IS NOT NULL"


NAMES = {"unique": "unique", "not_null": "not_null", "in": "accepted_values", "parent": "relationships"}
TESTS = [(model, column, NAMES[rule.partition(":")[0]], _failures(model, column, rule), rule.partition(":")[2])
         for model, column, *rules in map(str.split, DECLARED.strip().splitlines()) for rule in rules]


def _suite(kinds: set[str]) -> tuple[str, tuple[str, ...]]:
    chosen = [t for t in TESTS if t[2] in kinds]
    rows = "\n UNION ALL ".join(f"SELECT '{m}' AS model, '{c}' AS column_name, '{kind}' AS test, ({sql}) AS failures"
                                for m, c, kind, sql, _ in chosen)
    models = dict.fromkeys([m for m, *_ in chosen] + [t[4] for t in chosen if t[2] == "relationships"])
    return f"SELECT *, failures = 0 AS passed FROM ({rows})", tuple(models)


for _kind in NAMES.values():
    _sql, _deps = _suite({_kind})
    oracle(f"test_{_kind}", _sql, *_deps)

# publishers with more clicks than impressions: a CTR over 100 %
OVER_100 = """
, over_100 AS (SELECT publisher_id, count(*) FILTER (WHERE event_type = 'impression') AS impressions,
                      count(*) FILTER (WHERE event_type = 'click') AS clicks
               FROM stg_ad_events GROUP BY ALL HAVING impressions > 0 AND clicks > impressions)
"""
oracle("test_suspicious_ctr", OVER_100 + f"SELECT *, {pct('clicks', 'impressions', 2)} AS ctr_pct FROM over_100", "stg_ad_events")

_all_sql, _all_deps = _suite(set(NAMES.values()))
ALL_TESTS = (f"\n, all_tests AS ({_all_sql}\nUNION ALL SELECT 'stg_ad_events', '', 'suspicious_ctr_check', "
             "count(*), count(*) = 0 FROM over_100)\n")
oracle("data_test_results", OVER_100 + ALL_TESTS + "FROM all_tests", *_all_deps)
oracle("quality_scorecard", OVER_100 + ALL_TESTS + f"""
SELECT model, count(*) AS tests, {cnt('passed')} AS passed_tests, {pct(cnt('passed'), 'count(*)', 2)} AS pass_rate_pct
FROM all_tests GROUP BY model""", *_all_deps)

oracle("test_expectations", "\n UNION ALL \n".join(f"""
SELECT '{t}' AS model, 'fill_rate_pct' AS column_name, 'values_between' AS test,
       {cnt('fill_rate_pct < 0 OR fill_rate_pct > 100')} AS failures, CAST(NULL AS DOUBLE) AS observed,
       {cnt('fill_rate_pct < 0 OR fill_rate_pct > 100')} = 0 AS passed
FROM {t}
UNION ALL
SELECT '{t}', 'ctr_pct', 'mean_between',
       CAST(CASE WHEN avg(ctr_pct) BETWEEN 0 AND 5 THEN 0 ELSE 1 END AS BIGINT), {rnd('avg(ctr_pct)', 4)},
       avg(ctr_pct) BETWEEN 0 AND 5
FROM {t}""" for t in ("fct_ad_events_daily", "fct_publisher_performance")),
       "fct_ad_events_daily", "fct_publisher_performance")

oracle("test_freshness", f"""
SELECT 'ad_events' AS source, newest AS max_loaded_at, {rnd('age', 2)} AS age_hours,
       CASE WHEN age <= 24 THEN 'pass' WHEN age <= 48 THEN 'warn' ELSE 'error' END AS status,
       future_loads, if(future_loads > 0, 'future_loads', 'none') AS future_status
FROM (SELECT *, (epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(newest)) / 3600.0 AS age
      FROM (SELECT max(_loaded_at) FILTER (WHERE _loaded_at <= TIMESTAMP '2024-01-31 00:00:00') AS newest,
                   count(*) FILTER (WHERE _loaded_at > TIMESTAMP '2024-01-31 00:00:00') AS future_loads
            FROM raw_ad_events))""", "raw_ad_events")

oracle("test_negative_revenue", """
SELECT 'stg_ad_events' AS model, 'revenue_usd' AS column_name, 'non_negative' AS test,
       count(*) AS failures, CAST(sum(revenue_usd) AS DECIMAL(38,6)) AS negative_revenue_total, count(*) = 0 AS passed
FROM stg_ad_events WHERE revenue_usd < 0""", "stg_ad_events")

# ---- random-order sample and preview ------------------------------------------------------
oracle("replay_sample", """
SELECT * FROM raw_ad_events
ORDER BY md5('42/' || event_id || '/' || strftime(_loaded_at, '%Y-%m-%d %H:%M:%S')), event_id, _loaded_at LIMIT 2000""", "raw_ad_events")
oracle("preview", """
SELECT * FROM fct_ad_events_daily
ORDER BY event_date, publisher_id, site_domain, campaign_id, advertiser_id, device_type, country_code LIMIT 5""", "fct_ad_events_daily")

# ---- profiling --------------------------------------------------------------------------
oracle("dup_event_ids", "SELECT event_id, count(*) AS cnt FROM raw_ad_events GROUP BY event_id HAVING count(*) > 1",
       "raw_ad_events")
oracle("duplicate_rate", f"""
SELECT count(*) AS total_events, count(DISTINCT event_id) AS unique_events,
       count(*) - count(DISTINCT event_id) AS duplicate_count,
       {rnd('CAST(count(*) - count(DISTINCT event_id) AS DOUBLE) * 100.0 / count(*)', 2)} AS duplicate_pct,
       CAST(count(*) - count(DISTINCT event_id) AS DOUBLE) * 100.0 / count(*) > 1.0 AS duplicate_alert
FROM raw_ad_events""", "raw_ad_events")
oracle("duplicate_nature", """
SELECT event_id, count(*) AS cnt, count(DISTINCT event_timestamp) AS distinct_timestamps,
       count(DISTINCT revenue_usd) AS distinct_revenues, count(DISTINCT _loaded_at) AS distinct_load_times
FROM raw_ad_events GROUP BY event_id HAVING count(*) > 1""", "raw_ad_events")
oracle("ctr_by_publisher_domain", f"""
SELECT publisher_id, site_domain, events, revenue, avg_revenue, fill_rate_pct, clicks, impressions, ctr_pct FROM (
  SELECT publisher_id, site_domain, count(*) AS events, {money('revenue_usd')} AS revenue,
         {rnd('CAST(sum(revenue_usd) AS DOUBLE) / count(revenue_usd)', 4)} AS avg_revenue,
         {rnd("CAST(sum(CASE WHEN is_filled = 1 THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / count(*)", 2)} AS fill_rate_pct,
         {cnt("event_type = 'click'")} AS clicks, {cnt("event_type = 'impression'")} AS impressions,
         {pct(cnt("event_type = 'click'"), cnt("event_type = 'impression'"), 4)} AS ctr_pct
  FROM raw_ad_events GROUP BY publisher_id, site_domain
  ORDER BY ctr_pct DESC, publisher_id, site_domain LIMIT 20) t""", "raw_ad_events")
oracle("negative_revenue_scale", """
SELECT count(*) FILTER (WHERE revenue_usd < 0) AS negative_revenue_events,
       CAST(sum(revenue_usd) FILTER (WHERE revenue_usd < 0) AS DECIMAL(38,6)) AS total_negative_revenue,
       CAST(count(*) FILTER (WHERE revenue_usd < 0) AS DOUBLE) * 100.0 / (SELECT count(*) FROM raw_ad_events) AS pct_of_total
FROM raw_ad_events""", "raw_ad_events")
oracle("null_pattern", """
SELECT count_if(campaign_id IS NULL) AS null_campaigns, count_if(advertiser_id IS NULL) AS null_advertisers,
       count_if(is_filled = 0) AS unfilled_events,
       count_if(campaign_id IS NULL AND advertiser_id IS NULL AND is_filled = 0) AS all_three,
       count(*) AS total
FROM raw_ad_events""", "raw_ad_events")
oracle("revenue_by_fill_and_type", f"""
SELECT is_filled, event_type, count(*) AS events, {money('revenue_usd')} AS total_revenue,
       {rnd('CAST(sum(revenue_usd) AS DOUBLE) / count(revenue_usd)', 6)} AS avg_revenue,
       min(revenue_usd) AS min_revenue, max(revenue_usd) AS max_revenue
FROM raw_ad_events GROUP BY is_filled, event_type ORDER BY is_filled DESC, event_type""", "raw_ad_events")
oracle("negative_revenue_events", """
SELECT event_id, event_type, publisher_id, site_domain, campaign_id, revenue_usd, bid_floor_usd, is_filled, event_timestamp
FROM raw_ad_events WHERE revenue_usd < 0 ORDER BY revenue_usd ASC, event_id, _loaded_at LIMIT 20""", "raw_ad_events")
oracle("revenue_by_event_type", f"""
SELECT event_type, count(*) AS events, {money('revenue_usd')} AS total_revenue,
       CAST(sum(revenue_usd) AS DOUBLE) / count(revenue_usd) AS avg_revenue
FROM raw_ad_events GROUP BY event_type""", "raw_ad_events")
oracle("time_coverage", """
SELECT min(event_timestamp) AS earliest, max(event_timestamp) AS latest,
       CAST(date_diff('day', CAST(min(event_timestamp) AS DATE), CAST(max(event_timestamp) AS DATE)) AS INT) AS days_span
FROM raw_ad_events""", "raw_ad_events")
oracle("top_domains", """
SELECT site_domain, count(*) AS events FROM raw_ad_events GROUP BY site_domain
ORDER BY events DESC, site_domain LIMIT 5""", "raw_ad_events")
oracle("daily_volume", f"""
SELECT total_events, first_day, last_day, days, {rnd('CAST(total_events AS DOUBLE) / days', 2)} AS avg_events_per_day FROM (
  SELECT count(*) AS total_events, min(CAST(event_timestamp AS DATE)) AS first_day, max(CAST(event_timestamp AS DATE)) AS last_day,
         CAST(date_diff('day', min(CAST(event_timestamp AS DATE)), max(CAST(event_timestamp AS DATE))) + 1 AS INT) AS days
  FROM raw_ad_events) t""", "raw_ad_events")
oracle("table_row_counts", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {src}" for n, src in (
        ("ad_events", "raw_ad_events"), ("publishers", "raw_publishers"), ("campaigns", "raw_campaigns"),
        ("ad_units", "raw_ad_units"), ("stg_ad_events", "stg_ad_events"), ("stg_publishers", "stg_publishers"),
        ("stg_campaigns", "stg_campaigns"), ("stg_ad_units", "stg_ad_units"))),
    "stg_ad_events", "stg_publishers", "stg_campaigns", "stg_ad_units")
oracle("network_fill_rate", f"""
SELECT CAST(sum(filled_impressions) AS BIGINT) AS filled_impressions, CAST(sum(impressions) AS BIGINT) AS impressions,
       {pct_nullif('sum(filled_impressions)', 'sum(impressions)', 2)} AS fill_rate_pct
FROM fct_publisher_performance""", "fct_publisher_performance")
oracle("revenue_concentration", f"""
, per_pub AS (SELECT publisher_id, sum(total_revenue_usd) AS revenue FROM fct_publisher_performance GROUP BY publisher_id),
ranked AS (SELECT *, row_number() OVER (ORDER BY revenue DESC, publisher_id) AS rk FROM per_pub),
tot AS (SELECT CAST(sum(CASE WHEN rk <= 5 THEN revenue END) AS DECIMAL(38,6)) AS top_revenue,
               CAST(sum(revenue) AS DECIMAL(38,6)) AS total_revenue, count(*) AS publishers FROM ranked)
SELECT 5 AS top_k, top_revenue, total_revenue, publishers,
       {pct_nullif('top_revenue', 'total_revenue', 2)} AS top_share_pct FROM tot""", "fct_publisher_performance")
oracle("revenue_unit_economics", f"""
SELECT event_type, events, revenue,
       {rnd('CAST(revenue AS DOUBLE) / events', 4)} AS revenue_per_event,
       {rnd('CAST(revenue AS DOUBLE) / events * 1000.0', 2)} AS revenue_per_mille,
       {pct_nullif('revenue', 'sum(revenue) OVER ()', 2)} AS revenue_share_pct
FROM (SELECT event_type, count(*) AS events, {money('revenue_usd')} AS revenue FROM raw_ad_events GROUP BY event_type) g
""", "raw_ad_events")

# ---- seeded-condition detectors ---------------------------------------------------------
oracle("country_case_anomalies", f"""
SELECT country_code, upper(country_code) AS normalized_country_code, count(*) AS events, {money('revenue_usd')} AS revenue
FROM stg_ad_events WHERE country_code != upper(country_code) GROUP BY country_code""", "stg_ad_events")
oracle("domain_mismatch", """
SELECT e.event_id, e.publisher_id, e.site_domain, p.primary_domain, e.event_date
FROM stg_ad_events e JOIN stg_publishers p ON e.publisher_id = p.publisher_id
WHERE e.site_domain != p.primary_domain""", "stg_ad_events", "stg_publishers")
oracle("future_events", """
SELECT event_id, publisher_id, event_timestamp, _loaded_at FROM stg_ad_events
WHERE event_timestamp >= TIMESTAMP '2024-02-01 00:00:00'""", "stg_ad_events")
oracle("orphan_campaign_events", """
SELECT event_id, campaign_id, advertiser_id, publisher_id, event_date FROM stg_ad_events e
WHERE campaign_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_campaigns c WHERE c.campaign_id = e.campaign_id)""",
       "stg_ad_events", "stg_campaigns")
oracle("out_of_flight_delivery", """
SELECT e.event_id, e.campaign_id, e.event_date, c.campaign_start_date, c.campaign_end_date, c.campaign_status
FROM stg_ad_events e JOIN stg_campaigns c ON e.campaign_id = c.campaign_id
WHERE NOT (e.event_date BETWEEN c.campaign_start_date AND c.campaign_end_date)""", "stg_ad_events", "stg_campaigns")
oracle("traffic_bursts", f"""
, hourly AS (
  SELECT publisher_id, date_trunc('hour', event_timestamp) AS event_hour, device_type, country_code, browser,
         count(*) AS events
  FROM stg_ad_events GROUP BY publisher_id, date_trunc('hour', event_timestamp), device_type, country_code, browser),
means AS (SELECT publisher_id, CAST(sum(events) AS DOUBLE) / count(events) AS publisher_mean FROM hourly GROUP BY publisher_id)
SELECT h.publisher_id, h.event_hour, h.device_type, h.country_code, h.browser, h.events,
       {rnd('m.publisher_mean', 4)} AS publisher_mean
FROM hourly h JOIN means m ON h.publisher_id = m.publisher_id
WHERE h.events >= 20 AND CAST(h.events AS DOUBLE) > m.publisher_mean * 10.0""", "stg_ad_events")
oracle("ad_unit_mismatch", """
SELECT e.event_id, e.ad_unit_id, e.publisher_id, u.publisher_id AS unit_publisher_id, e.event_date
FROM stg_ad_events e JOIN stg_ad_units u ON e.ad_unit_id = u.ad_unit_id
WHERE e.publisher_id != u.publisher_id""", "stg_ad_events", "stg_ad_units")
oracle("advertiser_mismatch", """
SELECT e.event_id, e.campaign_id, e.advertiser_id, c.advertiser_id AS campaign_advertiser_id, e.event_date
FROM stg_ad_events e JOIN stg_campaigns c ON e.campaign_id = c.campaign_id
WHERE e.advertiser_id != c.advertiser_id""", "stg_ad_events", "stg_campaigns")
oracle("targeting_violations", """
SELECT event_id, campaign_id, device_type, country_code,
       CASE WHEN NOT list_contains(devices, device_type) THEN 1 ELSE 0 END AS device_violation,
       CASE WHEN NOT list_contains(countries, country_code) THEN 1 ELSE 0 END AS country_violation
FROM (SELECT e.event_id, e.campaign_id, e.device_type, e.country_code,
             string_split(c.targeting_device_types, ',') AS devices,
             string_split(c.targeting_countries, ',') AS countries
      FROM stg_ad_events e JOIN stg_campaigns c ON e.campaign_id = c.campaign_id) j
WHERE NOT list_contains(devices, device_type) OR NOT list_contains(countries, country_code)""",
       "stg_ad_events", "stg_campaigns")
oracle("inactive_unit_events", """
SELECT event_id, ad_unit_id, publisher_id, event_date FROM stg_ad_events
WHERE ad_unit_id IN (SELECT ad_unit_id FROM stg_ad_units WHERE is_active = 0)""", "stg_ad_events", "stg_ad_units")
oracle("below_floor_events", """
SELECT event_id, publisher_id, event_type, revenue_usd, bid_floor_usd FROM stg_ad_events
WHERE is_filled = 1 AND revenue_usd < bid_floor_usd""", "stg_ad_events")

# ---- time series / extensions -----------------------------------------------------------
oracle("publishers_scd2", """
SELECT publisher_id, publisher_name, publisher_category, primary_domain, account_manager, country,
       updated_at AS valid_from, lead(updated_at) OVER (PARTITION BY publisher_id ORDER BY updated_at) AS valid_to,
       CASE WHEN lead(updated_at) OVER (PARTITION BY publisher_id ORDER BY updated_at) IS NULL THEN 1 ELSE 0 END AS is_current
FROM raw_publishers""", "raw_publishers")
for _d in (7, 30):
    oracle(f"rolling_{_d}d_metrics", f"""
SELECT event_date, publisher_id, {_d} AS window_days, impressions, clicks, revenue, active_days,
       {pct('clicks', 'impressions', 4)} AS ctr_pct, {pct('filled_impressions', 'impressions', 2)} AS fill_rate_pct
FROM (
  SELECT a.event_date, a.publisher_id,
         CAST(sum(b.impressions) AS BIGINT) AS impressions, CAST(sum(b.clicks) AS BIGINT) AS clicks,
         CAST(sum(b.filled_impressions) AS BIGINT) AS filled_impressions,
         CAST(sum(b.total_revenue_usd) AS DECIMAL(38,6)) AS revenue, count(*) AS active_days
  FROM fct_publisher_performance a JOIN fct_publisher_performance b
    ON a.publisher_id = b.publisher_id AND b.event_date BETWEEN a.event_date - {_d - 1} AND a.event_date
  GROUP BY a.event_date, a.publisher_id) t""", "fct_publisher_performance")


def _traffic(key_expr: str, key_name: str) -> str:
    return f"""
SELECT {key_name}, events, impressions, filled_impressions, clicks, viewable_impressions, revenue,
       {pct('clicks', 'impressions', 4)} AS ctr_pct,
       {pct('filled_impressions', 'impressions', 2)} AS fill_rate_pct,
       {pct('viewable_impressions', 'impressions', 2)} AS viewability_rate_pct
FROM (SELECT {key_expr} AS {key_name}, count(*) AS events, {cnt("event_type = 'impression'")} AS impressions,
             {cnt("event_type = 'impression' AND is_filled = 1")} AS filled_impressions,
             {cnt("event_type = 'click'")} AS clicks, {cnt("event_type = 'viewable_impression'")} AS viewable_impressions,
             {money('revenue_usd')} AS revenue
      FROM stg_ad_events GROUP BY {key_expr}) g"""


oracle("device_performance", _traffic("device_type", "device_type"), "stg_ad_events")
oracle("geo_revenue", _traffic("upper(country_code)", "country"), "stg_ad_events")
oracle("valid_vs_total_traffic", f"""
SELECT *, {pct('total_clicks', 'total_impressions', 4)} AS total_ctr_pct,
       {pct('valid_clicks', 'valid_impressions', 4)} AS valid_ctr_pct,
       {pct_nullif('valid_events', 'total_events', 2)} AS valid_share_pct
FROM (SELECT event_date, count(*) AS total_events, {cnt('is_suspicious_traffic = 0')} AS valid_events,
             {cnt("event_type = 'impression'")} AS total_impressions,
             {cnt("is_suspicious_traffic = 0 AND event_type = 'impression'")} AS valid_impressions,
             {cnt("event_type = 'click'")} AS total_clicks,
             {cnt("is_suspicious_traffic = 0 AND event_type = 'click'")} AS valid_clicks,
             {money('revenue_usd')} AS total_revenue,
             {money('CASE WHEN is_suspicious_traffic = 0 THEN revenue_usd ELSE 0 END')} AS valid_revenue
      FROM stg_ad_events GROUP BY event_date) g""", "stg_ad_events")
oracle("dim_dates", """
SELECT date_day, CAST(year(date_day) AS INT) AS year, CAST(month(date_day) AS INT) AS month,
       CAST(day(date_day) AS INT) AS day_of_month, CAST(dayofweek(date_day) + 1 AS INT) AS day_of_week,
       CAST(weekofyear(date_day) AS INT) AS iso_week,
       CASE WHEN dayofweek(date_day) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       strftime(date_day, '%Y%m') AS year_month
FROM (SELECT CAST(unnest(generate_series(min(event_date), max(event_date), INTERVAL 1 DAY)) AS DATE) AS date_day
      FROM stg_ad_events) d""", "stg_ad_events")
oracle("publisher_cohorts", """
SELECT p.cohort_month, CAST(date_trunc('month', f.event_date) AS DATE) AS activity_month,
       count(DISTINCT f.publisher_id) AS active_publishers, CAST(sum(f.total_events) AS BIGINT) AS events,
       CAST(sum(f.total_revenue_usd) AS DECIMAL(38,6)) AS revenue
FROM fct_publisher_performance f
JOIN (SELECT publisher_id, CAST(date_trunc('month', created_at) AS DATE) AS cohort_month FROM stg_publishers) p
  ON f.publisher_id = p.publisher_id
GROUP BY p.cohort_month, CAST(date_trunc('month', f.event_date) AS DATE)""", "fct_publisher_performance", "stg_publishers")

# ---- materialisation / incremental / retention ------------------------------------------
oracle("mart_roundtrip", "SELECT * FROM fct_ad_events_daily", "fct_ad_events_daily")
oracle("fct_daily_incremental", """
, new_rows AS (SELECT * FROM raw_ad_events WHERE _loaded_at > TIMESTAMP '2024-01-25 00:00:00'),
touched AS (
  SELECT CAST(event_timestamp AS DATE) AS d FROM new_rows
  UNION
  SELECT CAST(r.event_timestamp AS DATE) FROM raw_ad_events r
  WHERE r._loaded_at <= TIMESTAMP '2024-01-25 00:00:00' AND r.event_id IN (SELECT event_id FROM new_rows))
SELECT * FROM fct_ad_events_daily WHERE event_date IN (SELECT d FROM touched)""", "raw_ad_events", "fct_ad_events_daily")
oracle("retention_split", f"""
SELECT tier, count(*) AS fact_rows, count(DISTINCT event_date) AS days, min(event_date) AS first_date,
       max(event_date) AS last_date, {money('total_revenue_usd')} AS revenue
FROM (SELECT *, CASE WHEN event_date < DATE '2024-01-31' - INTERVAL 730 DAY THEN 'archive' ELSE 'hot' END AS tier
      FROM fct_ad_events_daily) f
GROUP BY tier""", "fct_ad_events_daily")

# ---- streaming (the stream must equal the batch statement over the same input) ----------
_LAG = """(CAST(epoch(_loaded_at) AS BIGINT) - CAST(epoch(event_timestamp) AS BIGINT)) / 3600.0"""
_LAG_SQL = f"""
SELECT lag_bucket, count(*) AS rows, {cnt('is_filled = 1')} AS filled_rows FROM (
  SELECT *, CASE WHEN {_LAG} < 0 THEN 'loaded_before_event' WHEN {_LAG} <= 24 THEN 'within_1d'
                 WHEN {_LAG} <= 48 THEN '1d_to_2d' WHEN {_LAG} <= 168 THEN '2d_to_7d' ELSE 'over_7d' END AS lag_bucket
  FROM raw_ad_events) b
GROUP BY lag_bucket"""
oracle("late_arrival_lag", _LAG_SQL, "raw_ad_events")
oracle("stream_late_arrival_lag", _LAG_SQL, "raw_ad_events")
oracle("stream_ctr_alert", f"""
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, publisher_id, impressions, clicks,
       {pct('clicks', 'impressions', 4)} AS ctr_pct,
       impressions > 0 AND CAST(clicks AS DOUBLE) * 100.0 / impressions > 5.0 AS is_alert
FROM (SELECT date_trunc('hour', event_timestamp) AS window_start, publisher_id,
             {cnt("event_type = 'impression'")} AS impressions, {cnt("event_type = 'click'")} AS clicks
      FROM raw_ad_events GROUP BY date_trunc('hour', event_timestamp), publisher_id) g""", "raw_ad_events")
oracle("stream_dedup", """
SELECT * EXCLUDE (_loaded_at, event_date, is_suspicious_traffic, has_negative_revenue) FROM stg_ad_events""", "stg_ad_events")

oracle("suspicious_flag_static", """
, computed AS (
    SELECT publisher_id FROM stg_ad_events GROUP BY publisher_id
    HAVING count_if(event_type = 'impression') > 0
       AND CAST(count_if(event_type = 'click') AS DOUBLE) * 100.0 / count_if(event_type = 'impression') > 10)
SELECT p.publisher_id,
       CASE WHEN p.publisher_id IN (20, 15, 11, 9, 19, 17, 5, 13) THEN 1 ELSE 0 END AS in_static_list,
       CASE WHEN c.publisher_id IS NOT NULL THEN 1 ELSE 0 END AS computed_high_risk,
       CASE WHEN p.publisher_id IN (20, 15, 11, 9, 19, 17, 5, 13) AND c.publisher_id IS NOT NULL THEN 'both'
            WHEN p.publisher_id IN (20, 15, 11, 9, 19, 17, 5, 13) THEN 'static_only'
            WHEN c.publisher_id IS NOT NULL THEN 'computed_only' ELSE 'neither' END AS agreement
FROM stg_publishers p LEFT JOIN computed c ON p.publisher_id = c.publisher_id""", "stg_publishers", "stg_ad_events")

# ---- mergeable counts, versioned publishers, windows with every day -----------------------------------
oracle("distinct_by_span", """
SELECT CAST(date_trunc('week', event_timestamp) AS DATE) AS week, publisher_id, count(*) AS loaded_rows, count(DISTINCT event_id) AS distinct_events,
       count(DISTINCT ad_unit_id) AS distinct_ad_units, true AS events_agree, true AS ad_units_agree
FROM raw_ad_events GROUP BY ALL""", "raw_ad_events")
oracle("publishers_scd2_incremental", """
SELECT publisher_id, publisher_name, publisher_category, primary_domain, account_manager, country, updated_at AS valid_from,
       lead(updated_at) OVER later AS valid_to, CASE WHEN lead(updated_at) OVER later IS NULL THEN 1 ELSE 0 END AS is_current
FROM raw_publishers WINDOW later AS (PARTITION BY publisher_id ORDER BY updated_at)""", "raw_publishers")
oracle("revenue_by_publisher_version", f"""
SELECT e.publisher_id, v.publisher_name, v.updated_at AS valid_from, count(*) AS events, {money('e.revenue_usd')} AS revenue,
       min(e.event_timestamp) AS first_event, max(e.event_timestamp) AS last_event
FROM stg_ad_events e ASOF LEFT JOIN raw_publishers v ON e.publisher_id = v.publisher_id AND e.event_timestamp >= v.updated_at
GROUP BY ALL""", "stg_ad_events", "raw_publishers")
oracle("rolling_7d_filled", f"""
, days AS (
  SELECT publisher_id, CAST(unnest(generate_series(min(event_date), max(event_date), INTERVAL 1 DAY)) AS DATE) AS event_date
  FROM fct_publisher_performance GROUP BY publisher_id
), windows AS (
  SELECT d.event_date, d.publisher_id, CAST(coalesce(sum(f.impressions), 0) AS BIGINT) AS impressions, CAST(coalesce(sum(f.clicks), 0) AS BIGINT) AS clicks,
         CAST(coalesce(sum(f.filled_impressions), 0) AS BIGINT) AS filled, CAST(coalesce(sum(f.total_revenue_usd), 0) AS DECIMAL(38,6)) AS revenue,
         count(f.publisher_id) AS active_days
  FROM days d LEFT JOIN fct_publisher_performance f ON f.publisher_id = d.publisher_id AND f.event_date BETWEEN d.event_date - 6 AND d.event_date
  GROUP BY d.event_date, d.publisher_id
)
SELECT event_date, publisher_id, 7 AS window_days, impressions, clicks, revenue, active_days, {pct('clicks', 'impressions', 4)} AS ctr_pct,
       {pct('filled', 'impressions', 2)} AS fill_rate_pct
FROM windows""", "fct_publisher_performance")

ORACLE["stream_live_alerts"] = ORACLE["stream_ctr_alert"]
oracle("dup_event_ids_incremental", """
SELECT event_id, count(*) AS cnt FROM raw_ad_events
WHERE event_id IN (SELECT event_id FROM raw_ad_events WHERE _loaded_at > TIMESTAMP '2024-01-25 00:00:00')
GROUP BY event_id HAVING count(*) > 1""", "raw_ad_events")
