"""Line dedup by overlapping three-line windows (DataFrame functions only).

The lines of a text are its parts between newlines. Every three consecutive lines form a
window; a window that occurs more than once over all documents keeps only its first
occurrence, in order of document id and then line number. Each line that any later
occurrence covers is removed (overlaps are merged), and the rest is joined again.

Defined results: a null text has no lines and stays null; an empty text has one empty line;
texts of fewer than three lines have no window and stay whole. Rows with equal id and text
are one document and keep the same lines; rows with the same id and other text are ordered
by their text hash. A null id sorts first. Windows are compared by 128 hashed bits.

Scale: only (hash, position) rows are shuffled for the search, with map-side combine, so a
window that a third of the documents share arrives as one row per map task. The join back
is a sort-merge join that adaptive execution splits on a hot window. One document's removed
positions are gathered at a time, never those of a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("text_hash"), *more)


def _windows(keyed: DataFrame, size: int) -> DataFrame:
    """One row (doc_id, text_hash, line, h1, h2) for every window of consecutive lines."""
    def combined(hashes: Column, start: Column) -> Column:
        return F.xxhash64(*[F.get(hashes, start + j) for j in range(size)])

    hashed = keyed.select(
        "doc_id", "text_hash",
        F.transform(F.split("text", "\n", -1), lambda line: F.xxhash64(line)).alias("a"),
        F.transform(F.split("text", "\n", -1), lambda line: F.xxhash64(F.lit("second"), line)).alias("b"),
    ).where(F.size("a") >= size)
    return hashed.select("doc_id", "text_hash", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("a") - size),
        lambda i: F.struct(i.alias("line"), combined(F.col("a"), i).alias("h1"), combined(F.col("b"), i).alias("h2")),
    )).alias("w")).select("doc_id", "text_hash", "w.*")


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """Per document with any repeat: (doc_id, text_hash, starts), the first lines of its later occurrences."""
    windows = _windows(_keyed(docs, id_col, text_col), size)
    firsts = (windows.groupBy("h1", "h2")
              .agg(F.min(F.struct("doc_id", "text_hash", "line")).alias("first"), F.count("*").alias("n"))
              .where("n > 1").select("h1", "h2", "first"))
    later = windows.join(firsts, ["h1", "h2"]).where(
        ~F.struct("doc_id", "text_hash", "line").eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("starts"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """(doc_id, text, n_lines, n_removed, kept_text, row): every input row, whole in ``row``, with the lines that stay."""
    keyed = _keyed(docs, id_col, text_col, F.struct("*").alias("row"))
    found = repeated_lines(docs, id_col, text_col, size).select(
        F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"), "starts")
    lines = F.split("text", "\n", -1)
    covered = F.array_distinct(F.flatten(F.transform(
        "starts", lambda s: F.sequence(s, s + F.lit(size - 1)))))
    joined = (keyed.join(found, F.col("doc_id").eqNullSafe(F.col("found_id"))
                         & F.col("text_hash").eqNullSafe(F.col("found_hash")), "left")
              .select("doc_id", "text", "row", "starts", F.when(F.col("starts").isNotNull(), lines).alias("cut"),
                      F.when(F.col("text").isNull(), F.lit(0)).otherwise(
                          F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).alias("n_lines"))
              .withColumn("covered", covered))
    kept = F.array_except(F.sequence(F.lit(0), F.size("cut") - 1), F.col("covered"))
    return joined.select(
        "doc_id", "text", F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("starts").isNull(), F.col("text")).otherwise(
            F.array_join(F.transform(kept, lambda i: F.get(F.col("cut"), i)), "\n")).alias("kept_text"), "row")
