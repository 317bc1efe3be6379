"""Document fingerprints: threshold-scaled sketches (DataFrame functions only).

A sketch holds every hash of a five-word shingle that lies under a fixed fraction of the hash
range. The threshold is the same for every text, so sketches of parts can be united, and the
containment of a small text in a large one can be read from the two sketches. A text of
fewer than five words is one shingle; a text without words is one shingle of nothing.

Few hashes of a short text lie under the threshold. So a text with at most ``WHOLE`` shingles, or with fewer than
``FEWEST`` different ones under the threshold, keeps all its hashes, and its sketch is marked as whole. Two whole
sketches are compared by all hashes, which is exact; otherwise both sides are compared under the threshold. The
likeness of two texts follows from their two fingerprints alone, also from their written form (``read_fingerprint``).

Error: n shingles of the smaller text give n * ``FRACTION`` hashes to compare, and the estimate of a containment c
deviates by about sqrt(c (1 - c) / (n * FRACTION)); for two whole sketches by nothing. Measured figures are in the README.

Defined results: null text: empty; equal texts have equal fingerprints, and equal fingerprints are alike by 1; if only one of two
sketches is whole and one of them has nothing under the threshold, the likeness is 0; rows with equal id are
ordered by text; the successor of the last document is the first one (a single document is its
own successor); a null id sorts first.

Scale: successors are found without a global sort: sampled quantiles of the id cut the ids
into ranges, each range is one window partition, and the first document of a range is also
given to the range before it. Texts are shuffled once. The number of ranges and the rows in each grow with the square
root of the table once it has more than ``ROWS_PER_RANGE`` squared rows, so neither the driver's list nor a range
gets out of hand; windows sort and spill.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, long_array

SHINGLE = 5
FRACTION = 1 / 8  # share of the hash range that is retained
WHOLE = 64  # shingles of a text that keeps all its hashes
FEWEST = 4  # different hashes under the threshold that are enough to leave the others out
ROWS_PER_RANGE = 2_000
WORD_BREAK = r"[\x20\x09-\x0D]+"


def _limit(fraction: float) -> Column:
    return F.lit(-(2 ** 63) + int(2 ** 64 * fraction)).cast("long")


def _of_hashes(text: Column, size: int, chosen: Callable[[Column], Column]) -> Column:
    """``chosen`` of the hashes of all shingles of a text."""
    hashes = F.transform(F.filter(F.split(text, WORD_BREAK, -1), lambda w: w != ""), lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.size(h) - size),
                           lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(size)]))
        return F.when(F.size(h) >= size, many).otherwise(F.array(F.xxhash64(h)))

    # each inner array is bound once: a lambda over a one-element array keeps it from being computed twice
    return F.get(F.transform(F.transform(F.array(hashes), shingles), chosen), F.lit(0))


def sketch(text: Column, fraction: float = FRACTION, size: int = SHINGLE, whole: int = WHOLE, fewest: int = FEWEST) -> Column:
    """Sketch of a text: struct<whole boolean, hashes array<long>>, sorted distinct hashes."""
    def retained(all_hashes: Column) -> Column:
        low = F.array_distinct(F.filter(all_hashes, lambda x: x < _limit(fraction)))

        def chosen(kept: Column) -> Column:
            every = (F.size(all_hashes) <= whole) | (F.size(kept) < fewest)
            return F.struct(every.alias("whole"), F.array_sort(F.when(every, F.array_distinct(all_hashes)).otherwise(kept)).alias("hashes"))

        return F.get(F.transform(F.array(low), chosen), F.lit(0))

    return _of_hashes(text, size, retained)


def fingerprint(sketch_col: Column) -> Column:
    """The sketch as text: ``w`` (whole) or ``t`` (under the threshold) and sixteen hexadecimal digits for each hash."""
    digits = F.array_join(F.transform(sketch_col["hashes"], lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")
    return F.concat(F.when(sketch_col["whole"], F.lit("w")).otherwise(F.lit("t")), digits)


def read_fingerprint(text: Column) -> Column:
    """The sketch of a written fingerprint."""
    def number(start: Column) -> Column:
        upper, lower = (F.conv(F.substring(text, start + F.lit(at), F.lit(8)), 16, 10).cast("long") for at in (0, 8))
        return F.shiftleft(upper, 32).bitwiseOR(lower)

    starts = F.when(F.length(text) > 1, F.sequence(F.lit(2), F.length(text) - 15, F.lit(16))).otherwise(F.array().cast("array<int>"))
    return F.struct((F.substring(text, 1, 1) == "w").alias("whole"), F.transform(starts, number).alias("hashes"))


def _under(sketch_col: Column, fraction: float) -> Column:
    return F.filter(sketch_col["hashes"], lambda x: x < _limit(fraction))


def united(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """Sketch of two texts' shingles together: whole if both are."""
    whole = a["whole"] & b["whole"]
    hashes = F.when(whole, F.array_union(a["hashes"], b["hashes"])).otherwise(F.array_union(_under(a, fraction), _under(b, fraction)))
    return F.struct(whole.alias("whole"), F.array_sort(hashes).alias("hashes"))


def likeness(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """Estimated containment of the smaller text in the larger from their sketches, 0 to 1."""
    def share(both: Column) -> Column:
        least = F.least(F.size(both["x"]), F.size(both["y"]))
        return F.when(least > 0, F.size(F.array_intersect(both["x"], both["y"])) / least).otherwise(F.lit(0.0))

    whole = a["whole"] & b["whole"]
    x, y = (F.when(whole | ~side["whole"], side["hashes"]).otherwise(_under(side, fraction)) for side in (a, b))
    # bound once, as above
    shared = F.get(F.transform(F.array(F.struct(x.alias("x"), y.alias("y"))), share), F.lit(0))
    return F.when(a == b, F.lit(1.0)).otherwise(shared)


def _id_ranges(docs: DataFrame, rows_per_range: int) -> list[int]:
    """First ids of the ranges, ascending; their number grows with the square root of a large table."""
    n = docs.count()
    ranges = max(1, math.ceil(n / max(rows_per_range, math.isqrt(n))))
    shares = F.array(*[F.lit(i / ranges) for i in range(ranges)])
    found = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 10 * ranges)).alias("q")).first()["q"]
    lowest = docs.agg(F.min("doc_id")).first()[0]
    return sorted({*(found or []), lowest} - {None})


def with_successor(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Rows of (doc_id, text, ...) with struct ``next`` of the next document's columns, ascending doc_id."""
    starts = _id_ranges(docs.select("doc_id"), rows_per_range)
    if not starts:
        starts = [0]
    width = max(1, math.isqrt(len(starts)))
    arr, top = long_array(starts), long_array(starts[::width])
    i = F.greatest(F.size(F.filter(top, lambda x: x <= F.col("doc_id"))), F.lit(1)) - 1
    j = F.greatest(F.size(F.filter(F.slice(arr, i * width + 1, F.lit(width)), lambda x: x <= F.col("doc_id"))), F.lit(1)) - 1
    bucket = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(i * width + j)
    body = docs.columns
    placed = docs.withColumn("_bucket", bucket)
    nulls = docs.where("doc_id IS NULL").limit(1).count() > 0
    is_first = (F.col("doc_id").isNull() if nulls else F.col("doc_id") == F.lit(starts[0]))
    before = (F.when(is_first, F.lit(len(starts) - 1))
              .when(F.array_contains(arr, F.col("doc_id")) & (F.col("_bucket") > 0), F.col("_bucket") - 1))
    rows = placed.select("*", F.explode(F.array_compact(F.array(
        F.struct(F.col("_bucket").alias("b"), F.lit(0).alias("copy")),
        F.when(before.isNotNull(), F.struct(before.alias("b"), F.when(is_first, F.lit(2)).otherwise(F.lit(1)).alias("copy")))
    ))).alias("_at")).drop("_bucket")
    order = Window.partitionBy("_at.b").orderBy(F.col("_at.copy"), F.col("doc_id").asc_nulls_first(), F.col("text"))
    return (rows.withColumn("next", F.lead(F.struct(*body)).over(order))
            .where(F.col("_at.copy") == 0).drop("_at"))


def successive_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            fraction: float = FRACTION, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Per document: its text and edited text, both sketches, and the next document's text and sketch.

    The edited text has the last quarter of the code points (floor) replaced by as many from the start
    of the next document's text, or all of it.
    """
    base = id_text(docs, id_col, text_col).withColumn("sketch", sketch(F.col("text"), fraction))
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - quarter),
                      F.substring(F.col("next.text"), F.lit(1), quarter))
    return (with_successor(base, rows_per_range)
            .select("doc_id", "text", "sketch", F.col("next.sketch").alias("next_sketch"), edited.alias("edited_text"))
            .withColumn("edited_sketch", sketch(F.col("edited_text"), fraction)))
