"""The model DAG as one object: each model is a lazily built DataFrame.

``Models(raw)`` wires staging -> marts the way the reference's ``ref()`` graph does:

    stg_publishers, stg_campaigns, stg_ad_units, stg_ad_events
      -> fct_ad_events_daily, dim_publishers, dim_ad_units
      -> fct_publisher_performance, dim_campaigns

Nothing runs until an action. Consumers (charts, data tests, profiling) take models from
here, so a chart over ``fct_publisher_performance`` uses the daily fact as its
pre-aggregation, exactly like the reference. ``overrides`` bind names to
already written tables, as ``plans/pipeline.build_marts`` does.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import cached_property

from pyspark.sql import DataFrame

from adtally.plans import marts, staging
from adtally.sources.registry import RawSources

class Models:
    def __init__(self, raw: RawSources | None,
                 suspicious_ids: Iterable[int] | None = staging.SUSPICIOUS_PUBLISHER_IDS,
                 overrides: dict[str, DataFrame] | None = None):
        self.raw = raw
        self.suspicious_ids = None if suspicious_ids is None else tuple(suspicious_ids)
        for name, df in (overrides or {}).items():
            self.__dict__[name] = df  # pre-seed cached_property slots

    # ---- staging -------------------------------------------------------------------------
    @cached_property
    def stg_ad_events(self) -> DataFrame:
        return staging.stg_ad_events(self.raw, self.suspicious_ids)

    @cached_property
    def stg_publishers(self) -> DataFrame:
        return staging.stg_publishers(self.raw)

    @cached_property
    def stg_campaigns(self) -> DataFrame:
        return staging.stg_campaigns(self.raw)

    @cached_property
    def stg_ad_units(self) -> DataFrame:
        return staging.stg_ad_units(self.raw)

    # ---- marts ---------------------------------------------------------------------------
    @cached_property
    def fct_ad_events_daily(self) -> DataFrame:
        return marts.fct_ad_events_daily(self.stg_ad_events)

    @cached_property
    def fct_publisher_performance(self) -> DataFrame:
        return marts.fct_publisher_performance(self.fct_ad_events_daily)

    @cached_property
    def dim_publishers(self) -> DataFrame:
        return marts.dim_publishers(self.stg_publishers, self.stg_ad_events)

    @cached_property
    def dim_campaigns(self) -> DataFrame:
        return marts.dim_campaigns(self.stg_campaigns, self.fct_ad_events_daily)

    @cached_property
    def dim_ad_units(self) -> DataFrame:
        return marts.dim_ad_units(self.stg_ad_units)

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)
