"""Clustered layout: files that can be skipped by any of several columns.

Sorting by (time, publisher) alone leaves every publisher in every file. Here each column is cut into ranges of equal size by
sampled quantiles, the bits of the range numbers are interleaved, and rows are range-partitioned and sorted by that number
(columns that are equal in it follow, so many equal rows do not share one file). A file then covers a small range of every
column, and the Parquet statistics spare it for filters on any of them.

Defined results: null values are range 0; a column of one value leaves the order to the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6  # ranges of a column: two to this power
QUANTILE_ERROR = 0.001


def _comparable(column: str, kind: str) -> Column:
    """A number in the order of a column's values."""
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind == "string":  # its first bytes
        return F.conv(F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return F.col(column).cast("double")


def _place(value: Column, cuts: Column) -> Column:
    """How many of the cuts lie at or under a value (a frequent value is several cuts)."""
    return F.when(value.isNull(), F.lit(0)).otherwise(F.size(F.filter(cuts, lambda x: x <= value))).cast("long")


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """The interleaved bits of the columns' range numbers; limits come from quantiles, a bounded list for each column."""
    kinds = dict(df.dtypes)
    values = {c: _comparable(c, kinds[c]) for c in columns}
    shares = F.array(*[F.lit(i / 2 ** bits) for i in range(1, 2 ** bits)])
    limits = df.agg(*[F.percentile_approx(values[c], shares, int(1 / QUANTILE_ERROR)).alias(c) for c in columns]).first()
    key = F.lit(0).cast("long")
    for d, c in enumerate(columns):
        cuts = F.array(*[F.lit(x) for x in limits[c] or []]).cast("array<double>")
        place = _place(values[c], cuts)
        for bit in range(bits):
            key = key + F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(columns) + d)
    return key


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = BITS) -> None:
    """Write ``df`` as about ``files`` files, each of small ranges of all ``columns``."""
    ordered = df.select("*", interleaved(df, columns, bits).alias("__place"))
    spread = F.xxhash64(*df.columns)
    (ordered.repartitionByRange(files, "__place", *columns, spread).sortWithinPartitions("__place", *columns)
     .drop("__place").write.mode("overwrite").parquet(path))


def file_ranges(stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(file, rows, first_<column>, last_<column>, ...) of a stored table's files."""
    return stored.select("*", F.col("_metadata.file_path").alias("__file")).groupBy(F.col("__file").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("first", F.min), ("last", F.max))])
