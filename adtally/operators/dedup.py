"""Keep-latest deduplication.

``row_number() over (partition by key order by ...) = 1``. Catalyst rewrites the rank
filter into a *partial* ``WindowGroupLimit`` before the shuffle and a final one after it,
so each map task already keeps one row per key: a hot key (a third of all rows) leaves at
most one row per map partition, and the shuffle on the key carries ~distinct-key rows.

Keep the ordering list short: every column named in it must travel through the shuffle,
while columns the consumer does not use are pruned below the window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per ``keys``: the first row under ``order`` (put the version column first,
    descending, then deterministic tie-breaks)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


def version_history(df: DataFrame, keys: Sequence[str], version_col: str,
                    valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Type-2 history: each version is valid from its ``version_col`` until the next one.

    ``lead`` over the key window; the open (current) version has ``valid_to`` NULL and
    ``is_current`` = 1.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(version_col).asc())
    nxt = F.lead(F.col(version_col)).over(w)
    return (df.withColumn(valid_from, F.col(version_col))
              .withColumn(valid_to, nxt)
              .withColumn("is_current", F.when(F.col(valid_to).isNull(), F.lit(1)).otherwise(F.lit(0))))
