"""Dashboard chart queries over the marts (H1-H3) and the inventory snapshot.

Scale notes
* top-k is ``orderBy(...).limit(k)``, planned as ``TakeOrderedAndProject``: every task keeps
  its local k best rows, only k rows per task reach the final merge.
* the top-k publisher list is a semi-join; Spark broadcasts it while its size is under the threshold.
* every ordering carries a unique tie-break (publisher_id) so the cut is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.functions.expr import pct_nullif, ratio_pct
from adtally.plans.models import Models

# ---- fixed values: short display labels for publisher names (chart 1) -----------------
PUBLISHER_LABELS = {
    "GameSpot Digital": "GameSpot",
    "IGN Entertainment": "IGN",
    "Polygon Media": "Polygon",
    "Eurogamer Network": "Eurogamer",
    "Kotaku Digital": "Kotaku",
    "The Gamer Network": "The Gamer",
}
# ---- fixed values: click-fraud risk tiers (CTR percentage, strict lower bounds) --------
RISK_TIERS = ((100, "CRITICAL - Fraud"), (10, "High Risk"), (5, "Monitor"))
RISK_DEFAULT = "Normal"
# ---- end fixed values --------------------------------------------------------------------


def publisher_label(name_col: F.Column) -> F.Column:
    expr = None
    for full, short in PUBLISHER_LABELS.items():
        expr = (F.when(name_col == full, F.lit(short)) if expr is None
                else expr.when(name_col == full, F.lit(short)))
    return expr.otherwise(name_col)


def risk_level(ctr: F.Column) -> F.Column:
    expr = None
    for bound, label in RISK_TIERS:
        expr = F.when(ctr > bound, F.lit(label)) if expr is None else expr.when(ctr > bound, F.lit(label))
    return expr.otherwise(F.lit(RISK_DEFAULT))


def top_publishers_by_revenue(perf: DataFrame, k: int = 5) -> DataFrame:
    """Top-k publisher ids by lifetime revenue in the publisher-day fact."""
    return (perf.groupBy("publisher_id").agg(F.sum("total_revenue_usd").alias("lifetime_revenue"))
            .orderBy(F.col("lifetime_revenue").desc(), F.col("publisher_id").asc())
            .limit(k).select("publisher_id"))


def chart_revenue_top5(m: Models, k: int = 5) -> DataFrame:
    perf = m.fct_publisher_performance
    top = top_publishers_by_revenue(perf, k)
    facts = perf.join(top, "publisher_id", "left_semi")
    labelled = facts.join(m.dim_publishers.select("publisher_id", "publisher_name"), "publisher_id")
    return (labelled.groupBy("event_date", publisher_label(F.col("publisher_name")).alias("publisher"))
            .agg(F.sum("total_revenue_usd").cast("decimal(38,6)").alias("revenue"))
            .orderBy("event_date", "publisher"))


def chart_fill_rate(m: Models) -> DataFrame:
    perf = m.fct_publisher_performance.select("publisher_id", "filled_impressions", "impressions")
    joined = perf.join(m.dim_publishers.select("publisher_id", "publisher_name"), "publisher_id")
    return (joined.groupBy(F.col("publisher_name").alias("publisher"))
            .agg(pct_nullif(F.sum("filled_impressions"), F.sum("impressions"), 2).alias("fill_rate_pct"))
            .orderBy(F.col("fill_rate_pct").desc_nulls_last(), F.col("publisher").asc()))


def chart_click_fraud_risk(m: Models, min_impressions: int = 10, k: int = 15) -> DataFrame:
    p = m.dim_publishers.filter(F.col("impressions") > min_impressions)
    ctr_raw = ratio_pct("clicks", F.nullif(F.col("impressions"), F.lit(0)))
    return (p.select(
                "publisher_id",
                F.col("publisher_name").alias("publisher"),
                pct_nullif("clicks", "impressions", 2).alias("ctr_pct"),
                "clicks", "impressions",
                risk_level(ctr_raw).alias("risk_level"))
            .orderBy(F.col("ctr_pct").desc_nulls_last(), F.col("publisher_id").asc())
            .limit(k)
            .drop("publisher_id"))


def inventory_snapshot(m: Models) -> DataFrame:
    """Row counts of the raw dimension tables as doubles, one row per entity."""
    def count_of(df: DataFrame, entity: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).cast("double").alias("count_value")) \
                 .select(F.lit(entity).alias("entity"), "count_value")
    return (count_of(m.raw.publishers, "publishers")
            .unionByName(count_of(m.raw.campaigns, "campaigns"))
            .unionByName(count_of(m.raw.ad_units, "ad_units")))
