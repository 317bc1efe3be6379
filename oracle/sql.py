"""CTE library for the DuckDB oracle.

``build(final, *deps)`` returns ``WITH <all transitive deps in order> <final>``. Everything here is stated for
itself, in DuckDB's own idiom: nothing is imported from the library under test.
"""

from __future__ import annotations


def rnd(expr: str, k: int) -> str:
    """Portable HALF_UP rounding of a double expression."""
    return f"CAST(round(CAST(({expr}) AS DECIMAL(38,10)), {k}) AS DOUBLE)"


def pct(num: str, den: str, k: int) -> str:
    return f"CASE WHEN {den} > 0 THEN {rnd(f'CAST({num} AS DOUBLE) * 100.0 / {den}', k)} ELSE 0.0 END"


def pct_nullif(num: str, den: str, k: int) -> str:
    return rnd(f"CAST({num} AS DOUBLE) * 100.0 / NULLIF({den}, 0)", k)


def cnt(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def money(expr: str) -> str:
    return f"CAST(sum({expr}) AS DECIMAL(38,6))"


def ratios(relation: str) -> str:
    """The three traffic ratios, computed in one place over any relation with the counts."""
    return f"""
SELECT *, {pct('filled_impressions', 'impressions', 2)} AS fill_rate_pct, {pct('clicks', 'impressions', 4)} AS ctr_pct,
       {pct('viewable_impressions', 'impressions', 2)} AS viewability_rate_pct
FROM ({relation})"""


SUSPICIOUS = "20, 15, 11, 9, 19, 17, 5, 13"
# event counts by kind, as filters over staged events
KINDS = {
    "impressions": "event_type = 'impression'", "filled_impressions": "event_type = 'impression' AND is_filled = 1",
    "unfilled_impressions": "event_type = 'impression' AND is_filled = 0", "clicks": "event_type = 'click'",
    "viewable_impressions": "event_type = 'viewable_impression'", "suspicious_events": "is_suspicious_traffic = 1",
    "negative_revenue_events": "has_negative_revenue = 1",
}
COUNTS = ", ".join(f"{cnt(cond)} AS {name}" for name, cond in KINDS.items())
RECOUNTS = ", ".join(f"CAST(sum({name}) AS BIGINT) AS {name}" for name in ("total_events", *KINDS))

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (body.strip(), deps)


# ---- raw tables (the fixture rules of FIXTURES.md, stated in DuckDB) ------------------------
cte("raw_ad_events", """
SELECT CAST(eid AS VARCHAR) AS event_id, kind AS event_type,
       CASE WHEN burst THEN TIMESTAMP '2024-01-15 02:00:00' + to_seconds(eid % 14400)
            WHEN ahead THEN ts + INTERVAL 31 DAY ELSE ts END AS event_timestamp,
       pub AS publisher_id,
       'site' || CAST(if(eid % 97 = 0, neighbour, pub) AS VARCHAR) || '.example' AS site_domain,
       'au_' || CAST(if(eid % 89 = 0, neighbour, pub) AS VARCHAR) || '_' || CAST(1 + k % 3 AS VARCHAR) AS ad_unit_id,
       camp AS campaign_id,
       CAST(CASE WHEN camp < 0 THEN 10 - camp WHEN eid % 151 = 0 THEN 1 + camp % 10 ELSE 1 + (camp - 1) % 10 END AS INT) AS advertiser_id,
       if(burst, 'mobile', ['desktop', 'desktop', 'desktop', 'mobile', 'mobile', 'mobile', 'mobile', 'tablet', 'ctv'][1 + k % 9]) AS device_type,
       CASE WHEN burst THEN 'BR' WHEN eid % 41 = 0 THEN 'us' ELSE ['US', 'US', 'US', 'GB', 'DE', 'FR', 'JP'][1 + eid % 7] END AS country_code,
       if(burst, 'Samsung Internet', ['Chrome', 'Chrome', 'Chrome', 'Safari', 'Safari', 'Firefox', 'Edge', 'Edge'][1 + k % 8]) AS browser,
       CAST(CASE WHEN k < 15 THEN 0 WHEN kind = 'impression' AND eid % 80 = 1 THEN -1 ELSE 1 END
            * (value / if(kind = 'click', 100, 10000)) AS DECIMAL(18,6)) AS revenue_usd,
       CAST(CAST(10 + k % 50 AS DECIMAL(18,6)) / 10000 AS DECIMAL(18,6)) AS bid_floor_usd,
       CAST(k >= 15 AS INT) AS is_filled,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_days(CAST(CASE WHEN ahead THEN 39 WHEN eid % 61 = 0 THEN 4 ELSE 1 END AS INT))
         + to_hours(6 + 6 * retry) AS _loaded_at
FROM (
  SELECT *, pub = 13 AND k >= 50 AS burst, eid % 333 = 0 AS ahead, pub % 20 + 1 AS neighbour,
         unnest(if(eid % 65 = 0, [0, 1], [0])) AS retry,
         CASE WHEN pub = 20 AND source_kind = 'view' THEN 'impression'
              WHEN pub = 20 THEN 'click'
              WHEN source_kind = 'error' THEN 'viewable_impression'
              WHEN source_kind = 'click' AND k < CASE WHEN pub IN (5, 9, 11, 13, 15, 17, 19) THEN 1000000
                                                      WHEN pub IN (3, 4, 6) THEN 30 ELSE 3 END THEN 'click'
              ELSE 'impression' END AS kind,
         CAST(CASE WHEN k < 15 THEN NULL WHEN eid % 211 = 0 THEN -1 - eid % 3
                   WHEN eid % 10 < 3 OR (eid // 5) % 50 = 49 THEN 1 ELSE 1 + eid // 5 END AS INT) AS camp
  FROM (SELECT event_id AS eid, ts, value, event_type AS source_kind, CAST(1 + event_id % 20 AS INT) AS pub,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events))
""")
cte("raw_publishers", """
SELECT CAST(id AS INT) AS publisher_id, name AS publisher_name, category AS publisher_category,
       'site' || CAST(id AS VARCHAR) || '.example' AS primary_domain, 'AM ' || CAST((id - 1) % 7 AS VARCHAR) AS account_manager,
       if((id - 1) % 3 = 0, 'GB', 'US') AS country,
       TIMESTAMP '2023-01-15 00:00:00' + to_days(CAST(id - 1 AS INT)) AS created_at, updated AS updated_at
FROM (SELECT n_nationkey + 1 AS id, 'Publisher ' || CAST(n_nationkey + 1 AS VARCHAR) AS name,
             CASE n_regionkey WHEN 4 THEN 'mobile_gaming' WHEN 3 THEN 'entertainment' ELSE 'gaming' END AS category,
             TIMESTAMP '2023-06-01 00:00:00' + to_days(CAST(n_nationkey AS INT)) AS updated
      FROM nation
      UNION ALL VALUES (7, 'Publisher 7 Renamed', 'gaming', TIMESTAMP '2024-01-10 00:00:00'))
""")
cte("raw_campaigns", """
SELECT CAST(k + 1 AS INT) AS campaign_id, p_name AS campaign_name, CAST(adv AS INT) AS advertiser_id,
       'Advertiser ' || CAST(adv AS VARCHAR) AS advertiser_name,
       DATE '2023-12-15' + CAST(k % 40 AS INT) AS campaign_start_date, DATE '2024-01-05' + CAST(k % 40 AS INT) AS campaign_end_date,
       CAST(if(k % 31 = 30, 0, p_retailprice) AS DECIMAL(18,2)) AS campaign_budget_usd,
       if(k % 9 = 7, 'completed', 'active') AS campaign_status,
       ['desktop', 'desktop,mobile', 'desktop,mobile,ctv'][1 + k % 3] AS targeting_device_types,
       if(k % 2 = 0, 'US,GB', 'US,GB,DE,FR') AS targeting_countries, TIMESTAMP '2023-12-01 00:00:00' AS created_at
FROM (SELECT p_partkey AS k, 1 + p_partkey % 10 AS adv, p_name, p_retailprice FROM part)
""")
cte("raw_ad_units", """
SELECT 'au_' || CAST(n AS VARCHAR) || '_' || CAST(i AS VARCHAR) AS ad_unit_id, CAST(n AS INT) AS publisher_id,
       'Unit ' || CAST(n AS VARCHAR) || '/' || CAST(i AS VARCHAR) AS ad_unit_name,
       CASE WHEN i = 3 THEN 'video' WHEN i = 2 AND (n - 1) % 4 = 2 THEN 'native' ELSE 'display' END AS ad_format,
       ['728x90', '300x250', '640x480'][i] AS ad_size, if(i = 1, 'above_fold', 'in_content') AS placement_type,
       CAST(NOT (n = 5 AND i = 3) AS INT) AS is_active, TIMESTAMP '2023-02-01 00:00:00' AS created_at
FROM (SELECT n_nationkey + 1 AS n, unnest([1, 2, 3]) AS i FROM nation)
""")

# ---- staging: the newest version of each key --------------------------------------------------
cte("stg_ad_events", f"""
SELECT * EXCLUDE (newest), CAST(event_timestamp AS DATE) AS event_date,
       CAST(publisher_id IN ({SUSPICIOUS}) AS INT) AS is_suspicious_traffic, CAST(revenue_usd < 0 AS INT) AS has_negative_revenue
FROM (SELECT *, _loaded_at = max(_loaded_at) OVER (PARTITION BY event_id) AS newest FROM raw_ad_events) WHERE newest
""", "raw_ad_events")
cte("stg_publishers", """
SELECT unnest(arg_max(p, p.updated_at)) FROM raw_publishers p GROUP BY p.publisher_id
""", "raw_publishers")
cte("stg_campaigns", "FROM raw_campaigns", "raw_campaigns")
cte("stg_ad_units", "FROM raw_ad_units", "raw_ad_units")

# ---- marts ------------------------------------------------------------------------------------
cte("fct_ad_events_daily", ratios(f"""
  SELECT event_date, publisher_id, site_domain, ifnull(campaign_id, 0) AS campaign_id, ifnull(advertiser_id, 0) AS advertiser_id,
         device_type, country_code, count(*) AS total_events, {COUNTS},
         {money('revenue_usd')} AS total_revenue_usd, {money('bid_floor_usd')} AS total_bid_floor_usd,
         {rnd('CAST(sum(revenue_usd) AS DOUBLE) / count(revenue_usd)', 4)} AS avg_revenue_usd
  FROM stg_ad_events GROUP BY ALL"""), "stg_ad_events")
cte("fct_publisher_performance", ratios(f"""
  SELECT event_date, publisher_id, {RECOUNTS}, {money('total_revenue_usd')} AS total_revenue_usd,
         {rnd('CAST(sum(CAST(avg_revenue_usd AS DECIMAL(18,4))) AS DOUBLE) / count(avg_revenue_usd)', 4)} AS avg_revenue_usd
  FROM fct_ad_events_daily GROUP BY ALL"""), "fct_ad_events_daily")
cte("dim_publishers", f"""
SELECT * REPLACE (ifnull(lifetime_revenue, 0) AS lifetime_revenue),
       {pct('filled_events', 'total_events', 2)} AS lifetime_fill_rate_pct, {pct('clicks', 'impressions', 4)} AS lifetime_ctr_pct,
       {pct('suspicious_events', 'total_events', 2)} AS suspicious_traffic_pct,
       CAST(impressions > 0 AND clicks * 10 > impressions AS INT) AS is_high_risk_publisher
FROM (
  SELECT p.*, count(event_id) AS total_events, {cnt('is_filled = 1')} AS filled_events, {money('revenue_usd')} AS lifetime_revenue,
         {', '.join(f"{cnt(KINDS[k])} AS {k}" for k in ('impressions', 'clicks', 'suspicious_events', 'negative_revenue_events'))}
  FROM stg_publishers p LEFT JOIN stg_ad_events e ON e.publisher_id = p.publisher_id
  GROUP BY ALL)
""", "stg_publishers", "stg_ad_events")
cte("dim_campaigns", f"""
SELECT *, {pct('total_clicks', 'total_impressions', 4)} AS campaign_ctr_pct,
       if(campaign_budget_usd > 0, {rnd('CAST(total_revenue AS DOUBLE) / CAST(campaign_budget_usd AS DOUBLE) * 100.0', 2)}, 0.0) AS budget_utilization_pct
FROM (
  SELECT c.*, count(f.campaign_id) AS total_events, CAST(ifnull(sum(f.impressions), 0) AS BIGINT) AS total_impressions,
         CAST(ifnull(sum(f.clicks), 0) AS BIGINT) AS total_clicks,
         CAST(ifnull(sum(f.total_revenue_usd), 0) AS DECIMAL(38,6)) AS total_revenue
  FROM stg_campaigns c LEFT JOIN fct_ad_events_daily f ON f.campaign_id = c.campaign_id
  GROUP BY ALL)
""", "stg_campaigns", "fct_ad_events_daily")
cte("dim_ad_units", "FROM stg_ad_units", "stg_ad_units")


def _order(deps: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTES[n][1]:
            visit(d)
        seen.append(n)

    for d in deps:
        visit(d)
    return seen


def build(final: str, *deps: str) -> str:
    names = _order(deps)
    if not names:
        return final.strip()
    body = ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in names)
    return f"WITH {body}\n{final.strip()}"
