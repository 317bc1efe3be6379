"""Source registry: logical raw-table name -> typed DataFrame.

Two ways to bind the four raw tables:

* ``from_testdata``: derive them from the driver's parquet tables (fixtures.py);
* ``from_tables``:   read production parquet tables with the declared schema (no inference,
  so a scan reads only the columns a plan needs and pushes filters to the files).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from adtally.sources import fixtures
from adtally.sources.schemas import RAW_SCHEMAS

RAW_TABLES = ("ad_events", "publishers", "campaigns", "ad_units")


@dataclass(frozen=True)
class RawSources:
    ad_events: DataFrame
    publishers: DataFrame
    campaigns: DataFrame
    ad_units: DataFrame

    @property
    def spark(self) -> SparkSession:
        return self.ad_events.sparkSession

    def replace(self, **tables: DataFrame) -> "RawSources":
        return RawSources(**{n: tables.get(n, getattr(self, n)) for n in RAW_TABLES})


def from_testdata(spark: SparkSession, sf_dir: str) -> RawSources:
    return RawSources(**{n: fixtures.raw_table(spark, sf_dir, n) for n in RAW_TABLES})


def from_tables(spark: SparkSession, paths: dict[str, str]) -> RawSources:
    """Bind raw tables stored as parquet (one path or directory per table)."""
    missing = set(RAW_TABLES) - set(paths)
    if missing:
        raise ValueError(f"missing raw table paths: {sorted(missing)}")
    return RawSources(**{n: spark.read.schema(RAW_SCHEMAS[n]).parquet(paths[n]) for n in RAW_TABLES})
