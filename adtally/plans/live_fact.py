"""The daily fact kept up to date by signed changes, with columns that may come and go.

A run takes the batches that the store holds and the fact does not. For the ids among it (new events and retries) the event store's index
names the earlier files that hold them; only these are read. Of each id the newest version before and the newest
version now are compared: the former's share is taken from the fact, the latter's is added. All measures are sums
and counts, so the changed groups are the old groups plus the signed shares, and only the dates with a change are
written. A retry that moves an event to another day changes both days; a day or group without events goes.

The table is a set of date folders ``gen=<n>/event_date=...``, and a ledger document that names the folder of every date, the
columns, and the batches that are applied. One change of the document applies a run, so a run that dies
is simply run again: no share is added twice.

Columns follow the model (``on_schema_change='sync_all_columns'``): a measure that is new in a run is added to all dates by one
scan for its own columns, one that is gone is read no more and leaves the files when its date is written again. With
``backfill=False`` the new column is null on the dates that the run does not touch.

Scale: shares are pre-aggregated before the shuffle by group; newest versions by a partial limit, so a hot retried id is a row
for each task; calendar days are the only thing collected.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.functions.expr import pct, round_half_up
from adtally.plans.marts import FACT_KEYS, MONEY
from adtally.plans.staging import SUSPICIOUS_PUBLISHER_IDS, dedup_events
from adtally.session import child_names, delete_path
from adtally.sources import io
from adtally.sources.event_store import EventStore, as_ntz
from adtally.sources.ledger import Ledger

Measures = Mapping[str, Column]


def _day(date: dt.date | None) -> str:
    """A date as its folder is named; events without time have a folder of their own."""
    return "__HIVE_DEFAULT_PARTITION__" if date is None else date.isoformat()


def base_measures() -> dict[str, Column]:
    """What one event adds to each stored measure of the daily fact; all are whole numbers or exact decimals."""
    kind, filled = F.col("event_type"), F.col("is_filled")
    impression = kind == "impression"

    def one(condition: Column) -> Column:
        return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("long")

    def money(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0)).cast(MONEY)

    return {
        "total_events": F.lit(1).cast("long"), "impressions": one(impression), "filled_impressions": one(impression & (filled == 1)),
        "unfilled_impressions": one(impression & (filled == 0)), "clicks": one(kind == "click"),
        "viewable_impressions": one(kind == "viewable_impression"), "total_revenue_usd": money("revenue_usd"),
        "total_bid_floor_usd": money("bid_floor_usd"), "suspicious_events": one(F.col("publisher_id").isin(list(SUSPICIOUS_PUBLISHER_IDS))),
        "negative_revenue_events": one(F.col("revenue_usd") < 0),
        # numbers of values behind the sums: a sum of no values is null, a mean divides by them
        "revenue_values": one(F.col("revenue_usd").isNotNull()), "bid_floor_values": one(F.col("bid_floor_usd").isNotNull()),
    }


def as_fact(stored: DataFrame) -> DataFrame:
    """The daily fact's columns, and the added measures, from the stored sums."""
    own = set(base_measures())
    revenue = F.when(F.col("revenue_values") > 0, F.col("total_revenue_usd"))
    mean = F.when(F.col("revenue_values") > 0, F.col("total_revenue_usd").cast("double") / F.col("revenue_values").cast("double"))
    return stored.select(
        *FACT_KEYS, "total_events", "impressions", "filled_impressions", "unfilled_impressions", "clicks", "viewable_impressions",
        revenue.alias("total_revenue_usd"), round_half_up(mean, 4).alias("avg_revenue_usd"),
        F.when(F.col("bid_floor_values") > 0, F.col("total_bid_floor_usd")).alias("total_bid_floor_usd"),
        "suspicious_events", "negative_revenue_events", pct("filled_impressions", "impressions", 2).alias("fill_rate_pct"),
        pct("clicks", "impressions", 4).alias("ctr_pct"), pct("viewable_impressions", "impressions", 2).alias("viewability_rate_pct"),
        *[c for c in stored.columns if c not in own and c not in FACT_KEYS])


def shares(events: DataFrame, measures: Measures, sign: int = 1) -> DataFrame:
    """Keys and signed measures of every (deduplicated) event."""
    return events.select(
        F.to_date("event_timestamp").alias("event_date"), "publisher_id", "site_domain", F.coalesce("campaign_id", F.lit(0)).alias("campaign_id"),
        F.coalesce("advertiser_id", F.lit(0)).alias("advertiser_id"), "device_type", "country_code",
        *[(value * F.lit(sign)).alias(name) for name, value in measures.items()])


def summed(parts: DataFrame, names: list[str]) -> DataFrame:
    kinds = dict(parts.dtypes)
    return parts.groupBy(*FACT_KEYS).agg(*[F.sum(n).cast(kinds[n]).alias(n) for n in names])


class LiveFact:
    def __init__(self, store: EventStore, root: str, extra: Measures | None = None):
        self.store, self.root, self.spark = store, root, store.spark
        self.measures = {**base_measures(), **(extra or {})}
        self.ledger = Ledger(store.spark, root)

    # ---- reading ------------------------------------------------------------------------------
    def _schema(self) -> str:
        empty = shares(self.store.events().limit(0), self.measures)
        return ", ".join(f"`{n}` {t}" for n, t in empty.dtypes)

    def stored(self, dates: list[str] | None = None) -> DataFrame:
        """Stored sums of all dates or of some, in the columns of now; a column that a file lacks is null."""
        held = self.ledger.read()[1].get("dates", {})
        paths = [f"{self.root}/gen={held[d]}/event_date={d}" for d in (held if dates is None else dates) if d in held]
        if not paths:
            return self.spark.createDataFrame([], self._schema())
        return self.spark.read.schema(self._schema()).option("basePath", self.root).parquet(*paths).select(*FACT_KEYS, *self.measures)

    def fact(self) -> DataFrame:
        return as_fact(self.stored())

    # ---- changes ------------------------------------------------------------------------------
    def _versions(self, fresh: DataFrame, ids: DataFrame, earlier: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Newest versions of the touched ids without the fresh rows, and with them."""
        before = dedup_events(earlier.join(ids.select(F.col("event_id").alias("touched_id")), F.col("event_id").eqNullSafe(F.col("touched_id")), "left_semi"))
        return before, dedup_events(before.unionByName(fresh))

    def _changes(self, before: DataFrame, now: DataFrame) -> DataFrame:
        return summed(shares(before, self.measures, -1).unionByName(shares(now, self.measures)), list(self.measures))

    def touched_by(self, since: dt.datetime) -> DataFrame:
        """Fact rows of the dates of every event loaded after ``since`` (of all its versions), from the fact as it
        stood then and the files that hold such events. Nothing is written to the table.
        """
        fresh = self.store.after(since)
        ids = io.materialize("touched_ids", fresh.select("event_id").distinct())
        earlier = self.store.read_files(self.store.files_holding(ids, until=since.date())).where(F.col("_loaded_at") <= as_ntz(since))
        before, now = self._versions(fresh, ids, earlier)
        versions = fresh.select("event_timestamp").unionByName(earlier.join(ids, "event_id", "left_semi").select("event_timestamp"))
        touched = [_day(r[0]) for r in versions.select(F.to_date("event_timestamp")).distinct().collect()]  # calendar days
        merged = summed(self.stored(touched).unionByName(self._changes(before, now)), list(self.measures))
        return as_fact(merged.where("total_events > 0"))

    # ---- a run --------------------------------------------------------------------------------
    def run(self, backfill: bool = True) -> dict:
        """Apply the batches that are new, and changes of the columns; returns the ledger document."""
        version, document = self.ledger.read()
        names, applied, held = list(self.measures), document.get("batches", []), document.get("dates", {})
        new = [b for b in self.store.ledger.batches() if b not in applied]
        added = [n for n in names if n not in document.get("columns", names)]
        if not new and names == document.get("columns"):
            return document
        fresh = self.store.events(new)
        ids = io.materialize("touched_ids", fresh.select("event_id").distinct())
        earlier = self.store.read_files(self.store.files_holding(ids, applied))
        changed = io.materialize("fact_changes", self._changes(*self._versions(fresh, ids, earlier)))
        changed = changed.where(" OR ".join(f"`{n}` <> 0" for n in names))
        dates = {_day(r.event_date) for r in changed.select("event_date").distinct().collect()}  # calendar days
        if added and backfill:
            dates |= set(held)
        before = self.stored(sorted(dates))
        if added and backfill and held:
            own = summed(shares(dedup_events(self.store.events(applied)), {n: self.measures[n] for n in added}), added)
            before = before.drop(*added).unionByName(own, allowMissingColumns=True)
        result = summed(before.unionByName(changed), names).where("total_events > 0")
        generation = version + 1
        folder = f"{self.root}/gen={generation}"
        delete_path(self.spark, folder)  # left by a run that died
        io.write_table(result, folder, *io.MART_LAYOUT["fct_ad_events_daily"])
        present = [name.split("=")[1] for name in child_names(self.spark, folder) if name.startswith("event_date=")]

        def apply(current: dict) -> dict:
            if current != document:
                raise RuntimeError("another run was applied meanwhile")
            rest = {d: g for d, g in held.items() if d not in dates}
            return {"dates": {**rest, **dict.fromkeys(present, generation)}, "columns": names, "batches": [*applied, *new]}

        done = self.ledger.change(apply)
        for gone in set(held.values()) - set(done["dates"].values()):
            delete_path(self.spark, f"{self.root}/gen={gone}")
        return done
