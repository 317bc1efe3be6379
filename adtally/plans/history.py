"""Versioned dimensions kept up to date, and facts joined to the version that was valid at their time.

``merge_versions`` takes the stored history and new versions, and rebuilds the intervals of the touched keys only: a
version whose tracked columns equal those of the one before it (by their hash) opens no interval, an open interval
ends where the next begins, and a version that comes late falls into its place.

``as_of`` joins by merging both sides in time order: versions and facts of a key stand in one sorted sequence, and every fact
takes the last version before it. To split a key with many facts, time is cut in blocks: each block begins with
the version that is valid then, so a block needs nothing of the others; ``salts`` splits the facts of a block further. No
condition is a range over pairs of rows, and no fact meets more than one version.

Defined results: a version is valid from its time on, until the next; of versions of one key and time the one that is greatest
by its tracked columns stands; facts before the first version, or without a time or key, have null versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.functions.expr import money_sum
from adtally.plans.models import Models
from adtally.sources import io

TRACKED = ("publisher_name", "publisher_category", "primary_domain", "account_manager", "country")
INTERVALS = ("valid_from", "valid_to", "is_current")


def _hash(tracked: Sequence[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*tracked), {"ignoreNullFields": "false"}), 256)


def intervals(versions: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Versions (keys, tracked, valid_from) as intervals; unchanged versions fold into the one before."""
    order = Window.partitionBy(*keys).orderBy("valid_from")
    one = (versions.groupBy(*keys, "valid_from").agg(F.max(F.struct(*tracked)).alias("_greatest"))
           .select(*keys, "valid_from", *[F.col(f"_greatest.`{c}`").alias(c) for c in tracked]).withColumn("_hash", _hash(tracked)))
    changed = one.withColumn("_before", F.lag("_hash").over(order)).where("_before IS NULL OR _before <> _hash")
    ends = F.lead("valid_from").over(order)
    return changed.select(*keys, *tracked, "valid_from", ends.alias("valid_to"), F.when(ends.isNull(), F.lit(1)).otherwise(F.lit(0)).alias("is_current"))


def merge_versions(history: DataFrame, versions: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """The history with new versions (keys, tracked, valid_from); keys without new versions keep their rows as they are."""
    touched = versions.select(*keys).distinct()
    same = [history[k].eqNullSafe(touched[k]) for k in keys]
    old = history.join(touched, same, "left_semi").select(*keys, *tracked, "valid_from")
    untouched = history.join(touched, same, "left_anti")
    return untouched.unionByName(intervals(old.unionByName(versions.select(*keys, *tracked, "valid_from")), keys, tracked))


def as_of(facts: DataFrame, history: DataFrame, key: str, time: str, columns: Sequence[str], salts: int = 1, block: str = "day") -> DataFrame:
    """Facts with struct ``version`` of the history's ``columns`` valid at ``time``; ``block``: unit of time that splits a key."""
    of_time = F.date_trunc(block, F.col(time).cast("timestamp")).cast("timestamp_ntz")
    span = facts.agg(F.min(of_time).alias("first"), F.max(of_time).alias("last")).first()
    version = F.struct(*columns)
    left = facts.select(F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("fact"), F.col(key).alias("key"), F.col(time).alias("at"), of_time.alias("block"),
                        F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int").alias("salt"))
    if span["first"] is None:
        return facts.select("*", F.lit(None).cast(history.select(version.alias("v")).schema["v"].dataType).alias("version"))
    first, last = (F.lit(span[c].isoformat(" ")).cast("timestamp_ntz") for c in ("first", "last"))
    begins = F.greatest(F.date_trunc(block, F.col("valid_from").cast("timestamp")).cast("timestamp_ntz"), first)
    ends = F.least(F.date_trunc(block, F.coalesce("valid_to", last).cast("timestamp")).cast("timestamp_ntz"), last)
    blocks = (history.where((F.col("valid_from") < last + F.expr(f"INTERVAL '1' {block.upper()}")) & (begins <= ends))
              .select(F.col(key).alias("key"), "valid_from", version.alias("version"),
                      F.explode(F.sequence(begins, ends, F.expr(f"INTERVAL '1' {block.upper()}"))).alias("block")))
    right = blocks.select(F.lit(None).cast(left.schema["fact"].dataType).alias("fact"), "key", F.greatest("valid_from", "block").alias("at"), "block",
                          F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "version", "valid_from")
    both = left.select("*", F.lit(None).cast(right.schema["version"].dataType).alias("version"), F.lit(None).cast("timestamp_ntz").alias("valid_from")).unionByName(right)
    # at one time versions come before facts, and of versions the later one last
    order = Window.partitionBy("key", "block", "salt").orderBy("at", F.col("fact").isNotNull(), F.col("valid_from"))
    found = both.withColumn("version", F.last("version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return found.where("fact IS NOT NULL").select("fact.*", F.when(F.col("key").isNotNull() & F.col("at").isNotNull(), F.col("version")).alias("version"))


def publishers_scd2_incremental(m: Models) -> DataFrame:
    """C3 in two runs: the history of all first versions, then merged with the later ones."""
    versions = m.raw.publishers.select("publisher_id", *TRACKED, F.col("updated_at").alias("valid_from"))
    first_ends = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    history = io.materialize("publisher_history", intervals(versions.where(F.col("valid_from") < first_ends), ["publisher_id"], TRACKED))
    return merge_versions(history, versions.where(F.col("valid_from") >= first_ends), ["publisher_id"], TRACKED)


def revenue_by_publisher_version(m: Models) -> DataFrame:
    """Events and revenue of each publisher version that was valid when the event happened."""
    versions = m.raw.publishers.select("publisher_id", *TRACKED, F.col("updated_at").alias("valid_from"))
    facts = m.stg_ad_events.select("event_id", "publisher_id", "event_timestamp", "revenue_usd")
    joined = as_of(facts, intervals(versions, ["publisher_id"], TRACKED), "publisher_id", "event_timestamp", ["publisher_name", "valid_from"])
    return joined.groupBy("publisher_id", F.col("version.publisher_name").alias("publisher_name"), F.col("version.valid_from").alias("valid_from")).agg(
        F.count(F.lit(1)).alias("events"), money_sum("revenue_usd").alias("revenue"),
        F.min("event_timestamp").alias("first_event"), F.max("event_timestamp").alias("last_event"))
