"""Data-quality suite: the 34 column tests + 1 singular test, and proposed monitors.

Result contract: one row per test ``(model, column_name, test, failures, passed)``;
failing rows of any single test via ``checks.failing_rows``.

The singular CTR test is expected to fail on the seeded data (a publisher with more
clicks than impressions). Its filter uses the *unrounded* CTR (ANSI alias scoping).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.functions.expr import ratio_pct, round_half_up
from adtally.operators import checks
from adtally.operators.checks import TestSpec
from adtally.plans.models import Models

# ---- fixed values: declared column tests (model, column, test, args) -------------------
EVENT_TYPES = ("impression", "click", "viewable_impression")
FLAG_VALUES = (0, 1)

COLUMN_TESTS: tuple[TestSpec, ...] = (
    TestSpec("stg_ad_events", "event_id", "unique"),
    TestSpec("stg_ad_events", "event_id", "not_null"),
    TestSpec("stg_ad_events", "event_type", "not_null"),
    TestSpec("stg_ad_events", "event_type", "accepted_values", values=EVENT_TYPES),
    TestSpec("stg_ad_events", "event_timestamp", "not_null"),
    TestSpec("stg_ad_events", "event_date", "not_null"),
    TestSpec("stg_ad_events", "publisher_id", "not_null"),
    TestSpec("stg_ad_events", "publisher_id", "relationships", to_model="stg_publishers", to_field="publisher_id"),
    TestSpec("stg_ad_events", "is_filled", "not_null"),
    TestSpec("stg_ad_events", "is_filled", "accepted_values", values=FLAG_VALUES),
    TestSpec("stg_ad_events", "is_suspicious_traffic", "accepted_values", values=FLAG_VALUES),
    TestSpec("stg_ad_events", "has_negative_revenue", "accepted_values", values=FLAG_VALUES),
    TestSpec("stg_publishers", "publisher_id", "unique"),
    TestSpec("stg_publishers", "publisher_id", "not_null"),
    TestSpec("stg_publishers", "publisher_name", "not_null"),
    TestSpec("stg_campaigns", "campaign_id", "unique"),
    TestSpec("stg_campaigns", "campaign_id", "not_null"),
    TestSpec("stg_campaigns", "campaign_name", "not_null"),
    TestSpec("stg_ad_units", "ad_unit_id", "unique"),
    TestSpec("stg_ad_units", "ad_unit_id", "not_null"),
    TestSpec("stg_ad_units", "publisher_id", "not_null"),
    TestSpec("stg_ad_units", "publisher_id", "relationships", to_model="stg_publishers", to_field="publisher_id"),
    TestSpec("dim_publishers", "publisher_id", "unique"),
    TestSpec("dim_publishers", "publisher_id", "not_null"),
    TestSpec("dim_publishers", "publisher_name", "not_null"),
    TestSpec("dim_campaigns", "campaign_id", "unique"),
    TestSpec("dim_campaigns", "campaign_id", "not_null"),
    TestSpec("dim_campaigns", "campaign_name", "not_null"),
    TestSpec("dim_ad_units", "ad_unit_id", "unique"),
    TestSpec("dim_ad_units", "ad_unit_id", "not_null"),
    TestSpec("fct_ad_events_daily", "event_date", "not_null"),
    TestSpec("fct_ad_events_daily", "publisher_id", "not_null"),
    TestSpec("fct_publisher_performance", "event_date", "not_null"),
    TestSpec("fct_publisher_performance", "publisher_id", "not_null"),
)
SINGULAR_TEST = "suspicious_ctr_check"
SINGULAR_CTR_THRESHOLD = 100  # percent; clicks cannot exceed impressions
# ---- end fixed values --------------------------------------------------------------------


def specs_of(kind: str) -> list[TestSpec]:
    return [s for s in COLUMN_TESTS if s.test == kind]


def test_unique(m: Models) -> DataFrame:
    return checks.summarize(specs_of("unique"), m)


def test_not_null(m: Models) -> DataFrame:
    return checks.summarize(specs_of("not_null"), m)


def test_accepted_values(m: Models) -> DataFrame:
    return checks.summarize(specs_of("accepted_values"), m)


def test_relationships(m: Models) -> DataFrame:
    return checks.summarize(specs_of("relationships"), m)


def publisher_ctr(stg_events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    agg = stg_events.groupBy("publisher_id").agg(
        F.count_if(et == "impression").alias("impressions"),
        F.count_if(et == "click").alias("clicks"))
    return agg.withColumn("ctr_raw", F.when(F.col("impressions") > 0, ratio_pct("clicks", "impressions"))
                          .otherwise(F.lit(0.0)))


def test_suspicious_ctr(m: Models, threshold: float = SINGULAR_CTR_THRESHOLD) -> DataFrame:
    """Failing rows of the singular test: publishers whose CTR exceeds ``threshold`` %."""
    return (publisher_ctr(m.stg_ad_events)
            .filter(F.col("ctr_raw") > threshold)
            .orderBy(F.col("ctr_raw").desc(), F.col("publisher_id"))
            .select("publisher_id", "impressions", "clicks", round_half_up("ctr_raw", 2).alias("ctr_pct")))


def singular_result(m: Models) -> DataFrame:
    return test_suspicious_ctr(m).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("stg_ad_events").alias("model"), F.lit("").alias("column_name"),
        F.lit(SINGULAR_TEST).alias("test"), "failures", (F.col("failures") == 0).alias("passed"))


def data_test_results(m: Models) -> DataFrame:
    """All 35 tests (34 declared + singular) as one result table."""
    return checks.summarize(COLUMN_TESTS, m).unionByName(singular_result(m))


# ---- proposed monitors (extensions) -------------------------------------------------------
def test_expectations(m: Models, lo: float = 0.0, hi: float = 100.0,
                      mean_lo: float = 0.0, mean_hi: float = 5.0) -> DataFrame:
    """Range test on fill_rate_pct and mean-in-range test on ctr_pct, per fact table.

    ``failures`` = rows outside [lo, hi] for the range test, 1/0 for the mean test;
    ``observed`` = the mean for the mean test, NULL for the range test.
    """
    out = None
    for name in ("fct_ad_events_daily", "fct_publisher_performance"):
        f = m.model(name)
        row = f.agg(F.count_if((F.col("fill_rate_pct") < lo) | (F.col("fill_rate_pct") > hi)).alias("range_fail"),
                    F.avg("ctr_pct").alias("ctr_mean"))
        part = row.select(F.explode(F.array(
            F.struct(F.lit("fill_rate_pct").alias("column_name"), F.lit("values_between").alias("test"),
                     F.col("range_fail").alias("failures"), F.lit(None).cast("double").alias("observed")),
            F.struct(F.lit("ctr_pct").alias("column_name"), F.lit("mean_between").alias("test"),
                     F.when(F.col("ctr_mean").between(mean_lo, mean_hi), F.lit(0)).otherwise(F.lit(1))
                      .cast("bigint").alias("failures"),
                     round_half_up("ctr_mean", 4).alias("observed")),
        )).alias("r")).select(F.lit(name).alias("model"), "r.*")
        out = part if out is None else out.unionByName(part)
    return out.withColumn("passed", F.col("failures") == 0)


def test_freshness(m: Models, as_of: dt.datetime = dt.datetime(2024, 1, 31),
                   warn_hours: int = 24, error_hours: int = 48) -> DataFrame:
    """Source freshness: age of the newest load up to ``as_of`` versus warn / error SLAs (hours).

    Loads after ``as_of`` do not count for the age; they have a status of their own.
    """
    as_of_lit = F.lit(as_of).cast("timestamp_ntz")
    future = F.col("_loaded_at") > as_of_lit
    latest = m.raw.ad_events.agg(F.max(F.when(~future, F.col("_loaded_at"))).alias("max_loaded_at"),
                                 F.count_if(future).alias("future_loads"))
    age = (F.unix_timestamp(as_of_lit.cast("timestamp")) -
           F.unix_timestamp(F.col("max_loaded_at").cast("timestamp"))) / F.lit(3600.0)
    return latest.select(
        F.lit("ad_events").alias("source"), "max_loaded_at",
        round_half_up(age, 2).alias("age_hours"),
        F.when(age.isNull() | (age > error_hours), F.lit("error")).when(age > warn_hours, F.lit("warn"))
         .otherwise(F.lit("pass")).alias("status"),
        "future_loads", F.when(F.col("future_loads") > 0, F.lit("future_loads")).otherwise(F.lit("none")).alias("future_status"))


def test_negative_revenue(m: Models) -> DataFrame:
    """Monitor for ``revenue_usd >= 0`` on staged events."""
    e = m.stg_ad_events
    return e.agg(F.count_if(F.col("revenue_usd") < 0).alias("failures"),
                 F.sum(F.when(F.col("revenue_usd") < 0, F.col("revenue_usd"))).cast("decimal(38,6)")
                  .alias("negative_revenue_total")) \
            .select(F.lit("stg_ad_events").alias("model"), F.lit("revenue_usd").alias("column_name"),
                    F.lit("non_negative").alias("test"), "failures", "negative_revenue_total",
                    (F.col("failures") == 0).alias("passed"))


def quality_scorecard(m: Models) -> DataFrame:
    """Share of passing tests, overall and per model, over the 35-test suite."""
    r = data_test_results(m)
    return (r.groupBy("model").agg(F.count(F.lit(1)).alias("tests"),
                                   F.count_if(F.col("passed")).alias("passed_tests"))
             .withColumn("pass_rate_pct", F.when(F.col("tests") > 0,
                                                 round_half_up(ratio_pct("passed_tests", "tests"), 2))))
