"""Mart materialisation: partitioned, sorted Parquet tables in the shared checkpoint folder.

Layout (the sort-key idea of the original tables, expressed with Spark writers):

* facts are ``partitionBy("event_date")`` (or a month column) so date filters prune
  directories, and sorted inside each file by their sort key so Parquet min/max statistics
  prune row groups for publisher / campaign filters;
* before writing, a ``REBALANCE`` hint lets AQE shape the output partitions: it splits a hot
  date across several tasks and merges tiny ones, so neither skew nor small files result;
* dimensions are written unpartitioned.

A refresh replaces the whole table (static overwrite). ``replace_partitions`` replaces exactly the partitions it
has rows for; both are writer options, so the caller's session keeps its own overwrite mode.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.session import delete_path, temporary_path

# ---- fixed values: sort keys and partition columns per mart ------------------------------
MART_LAYOUT: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    # name: (partition columns, sort key)
    "stg_ad_events": (("event_date",), ("event_timestamp", "publisher_id")),
    "fct_ad_events_daily": (("event_date",), ("publisher_id", "campaign_id")),
    "fct_publisher_performance": (("event_date",), ("publisher_id",)),
    "dim_publishers": ((), ("publisher_id",)),
    "dim_campaigns": ((), ("campaign_id",)),
    "dim_ad_units": ((), ("ad_unit_id",)),
}
# ---- end fixed values ----------------------------------------------------------------------


def with_month(df: DataFrame, date_col: str = "event_date", out: str = "event_month") -> DataFrame:
    """Month partition column ``yyyyMM`` (coarser partitions for long histories)."""
    return df.withColumn(out, F.date_format(date_col, "yyyyMM"))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                sort_by: Sequence[str] = (), replace: str = "static") -> None:
    """Write ``df`` over ``path``: ``static`` replaces the table, ``dynamic`` only the partitions with rows."""
    out = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    if partition_by or sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", replace)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Read a written table back with the producing plan's schema and column order."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def write_mart(name: str, df: DataFrame, path: str, by_month: bool = False) -> None:
    """Full refresh of a mart; ``by_month`` partitions by month instead of by date."""
    part, sort = MART_LAYOUT.get(name, ((), ()))
    if by_month and part:
        df, part = with_month(df, part[0]), ("event_month",)
    write_table(df, path, part, sort)


def replace_partitions(name: str, df: DataFrame, path: str) -> None:
    """Write only the partitions that ``df`` has rows for; the others stay."""
    part, sort = MART_LAYOUT[name]
    write_table(df, path, part, sort, replace="dynamic")


def drop_dates(spark: SparkSession, path: str, dates: Iterable[dt.date]) -> None:
    """Remove the ``event_date`` partitions of the given days."""
    for day in dates:
        delete_path(spark, f"{path}/event_date={day.isoformat()}")


def materialize(name: str, df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as mart ``name`` (default: a fresh folder under spark.checkpoint.dir) and
    return a DataFrame over the written files; lineage is cut at the write."""
    spark = df.sparkSession
    path = path or temporary_path(spark, name)
    write_mart(name, df, path)
    return read_table(spark, path, df)
