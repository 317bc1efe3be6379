"""Catalog of every registered query: name -> function of the model DAG.

Each entry takes a ``Models`` and returns a lazy DataFrame. Models, profiling of raw rows and maintenance work on the
stored raw tables; charts, data tests, KPIs and detectors (``STORED``) read the stored staging and
mart tables. Each table is written on its first use at a source version. The ``__spark_entry__`` contract wraps them as ``(spark, sf_dir) -> DataFrame``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.plans import charts, incremental
from adtally.plans.live_fact import LiveFact
from adtally.plans.models import Models
from adtally.plans.pipeline import StoredModels
from adtally.session import delete_path, file_listing, temporary_path
from adtally.sources.event_store import EventStore, as_ntz
from adtally.sources.load import StoredRaw
from adtally.sources.registry import from_testdata

QueryFn = Callable[[Models], DataFrame]

CATALOG: dict[str, QueryFn] = {}
# consumers that read the stored staging and mart tables instead of rebuilding them from raw
STORED: set[str] = set()


def register(name: str, stored: bool = False) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in CATALOG:
            raise ValueError(f"duplicate query name {name}")
        CATALOG[name] = fn
        if stored:
            STORED.add(name)
        return fn
    return deco


SOURCES = ("events", "nation", "part")
_MODELS: dict[tuple[str, str, str], Models] = {}
_ROOTS: dict[tuple[str, str, str], tuple[tuple, str]] = {}


def _bound(spark: SparkSession, sf_dir: str, kind: str, build: Callable[[str], Models]) -> Models:
    """Models of one kind over ``sf_dir``, built once for each version of the source files.

    The version is the listing (names, sizes, times) of the source files: after an append or a rewrite
    the tables are built again and the old ones deleted. Only stored tables are shared, no query results.
    """
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    version = tuple(f for t in SOURCES for f in file_listing(spark, f"{sf_dir}/{t}.parquet"))
    if key not in _ROOTS or _ROOTS[key][0] != version:
        if key in _ROOTS:
            delete_path(spark, _ROOTS[key][1])
        root = temporary_path(spark, kind)
        _MODELS[key] = build(root)
        _MODELS[key].sf_dir = sf_dir  # streaming queries re-read the source files as a stream
        _ROOTS[key] = (version, root)
    return _MODELS[key]


def models_for(spark: SparkSession, sf_dir: str) -> Models:
    """Lazy model DAG over the stored raw tables (each is loaded when a query of a source version first reads it)."""
    return _bound(spark, sf_dir, "raw", lambda root: Models(StoredRaw(from_testdata(spark, sf_dir), root)))


def marts_for(spark: SparkSession, sf_dir: str) -> Models:
    """Models bound to stored staging and mart tables (each is built when a query of a source version first reads it)."""
    raw = models_for(spark, sf_dir).raw
    return _bound(spark, sf_dir, "marts", lambda root: StoredModels(raw, root))


def live_for(spark: SparkSession, sf_dir: str) -> LiveFact:
    """Event store and kept fact as of the incremental query's load time; later loads are stored but not applied."""
    raw, since = models_for(spark, sf_dir).raw, as_ntz(incremental.INCREMENTAL_SINCE)

    def build(root: str) -> Models:
        store, loaded = EventStore(spark, f"{root}/store"), F.col("_loaded_at")
        store.load(raw.ad_events.where(loaded <= since), "until")
        fact = LiveFact(store, f"{root}/fact")
        fact.run()
        store.load(raw.ad_events.where(loaded > since), "after")
        return Models(None, overrides={"live": fact})

    return _bound(spark, sf_dir, "live", build).live


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    if name in STREAMS:  # streams read the event files themselves, no raw load needed
        return STREAMS[name](spark, sf_dir)
    return CATALOG[name](marts_for(spark, sf_dir) if name in STORED else models_for(spark, sf_dir))


# ---- sources / staging / marts ------------------------------------------------------------
register("raw_events_union")(lambda m: m.raw.ad_events)
for _name in ("stg_ad_events", "stg_publishers", "stg_campaigns", "stg_ad_units",
              "fct_ad_events_daily", "fct_publisher_performance", "dim_publishers",
              "dim_campaigns", "dim_ad_units"):
    register(_name)(lambda m, _n=_name: m.model(_n))

# ---- dashboard ----------------------------------------------------------------------------
register("chart_revenue_top5", stored=True)(charts.chart_revenue_top5)
register("chart_fill_rate", stored=True)(charts.chart_fill_rate)
register("chart_click_fraud_risk", stored=True)(charts.chart_click_fraud_risk)
register("inventory_snapshot")(charts.inventory_snapshot)

# ---- data tests -----------------------------------------------------------------------------
from adtally.plans import anomalies, profiling, quality, timeseries  # noqa: E402

for _name in ("test_unique", "test_not_null", "test_accepted_values", "test_relationships",
              "test_suspicious_ctr", "data_test_results", "test_expectations", "test_freshness",
              "test_negative_revenue", "quality_scorecard"):
    register(_name, stored=True)(getattr(quality, _name))

# ---- profiling ------------------------------------------------------------------------------
for _name in ("dup_event_ids", "duplicate_rate", "duplicate_nature", "ctr_by_publisher_domain",
              "negative_revenue_scale", "null_pattern", "revenue_by_fill_and_type",
              "negative_revenue_events", "revenue_by_event_type", "time_coverage", "top_domains",
              "daily_volume", "table_row_counts", "network_fill_rate", "revenue_concentration",
              "revenue_unit_economics", "replay_sample", "preview"):
    register(_name, stored=_name in ("network_fill_rate", "revenue_concentration", "table_row_counts", "preview"))(
        getattr(profiling, _name))

# ---- seeded-condition detectors ---------------------------------------------------------------
for _name in ("country_case_anomalies", "domain_mismatch", "future_events", "orphan_campaign_events",
              "out_of_flight_delivery", "traffic_bursts", "ad_unit_mismatch", "advertiser_mismatch",
              "targeting_violations", "inactive_unit_events", "below_floor_events", "suspicious_flag_static"):
    register(_name, stored=True)(getattr(anomalies, _name))

# ---- time series / extensions -----------------------------------------------------------------
for _name in ("publishers_scd2", "rolling_7d_metrics", "rolling_30d_metrics", "rolling_7d_filled", "device_performance",
              "geo_revenue", "valid_vs_total_traffic", "dim_dates", "publisher_cohorts"):
    register(_name, stored=True)(getattr(timeseries, _name))

from adtally.plans import distinct, history  # noqa: E402

register("distinct_by_span")(distinct.distinct_by_span)
register("publishers_scd2_incremental", stored=True)(history.publishers_scd2_incremental)
register("revenue_by_publisher_version", stored=True)(history.revenue_by_publisher_version)

# ---- materialisation / incremental / retention ------------------------------------------------
for _name in ("mart_roundtrip", "retention_split"):
    register(_name)(getattr(incremental, _name))
register("dup_event_ids_incremental")(lambda m: incremental.repeated_since(live_for(m.raw.spark, m.sf_dir).store))
register("fct_daily_incremental")(lambda m: live_for(m.raw.spark, m.sf_dir).touched_by(incremental.INCREMENTAL_SINCE))

# ---- streaming ------------------------------------------------------------------------------------
from adtally.streaming import alerts as streaming_alerts  # noqa: E402
from adtally.streaming import jobs as streaming_jobs  # noqa: E402


STREAMS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_ctr_alert": streaming_jobs.ctr_alert_stream,
    "stream_dedup": streaming_jobs.dedup_stream,
    "stream_late_arrival_lag": streaming_jobs.lag_stream,
    "stream_live_alerts": streaming_alerts.live_alert_stream,
}

register("late_arrival_lag")(lambda m: streaming_jobs.lag_counts(m.raw.ad_events))
for _name, _fn in STREAMS.items():
    register(_name)(lambda m, _f=_fn: _f(m.raw.spark, m.sf_dir))
