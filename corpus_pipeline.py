"""Corpus pipeline over ``documents``: the stages run one after another, each on what its predecessor kept.

1. quality classifier: documents that score under one half go;
2. line dedup: later occurrences of repeated three-line windows go; a document of which no line is left goes;
3. n-gram Jaccard join (five words, 0.8): of each group the document with the smallest id stays (a null id comes last,
   and one of several texts with that id); rows are told apart by id and text;
4. benchmark decontamination: contaminated documents go;
5. BPE encoding and decoding: ids and decoded text of every document that is left.

All stages but the last return the columns of their input. Null texts are empty and leave with stage 1;
a row with a null id is a document like any other; repeated rows stay once after stage 3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm import bpe, decontamination, line_dedup, ngram_join, quality
from adtally.llm.common import Stored, table

ORACLE_SQL = None  # a trained model and an encoder: compared with plain versions in the tests


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(docs).where("n_removed < n_lines OR n_lines = 0")
    changed = {"text": F.col("kept_text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars"))}
    return done.select(*[changed[c].alias(c) if c in changed else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _without(docs: DataFrame, text_hash: Column, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id and hash are not in ``gone`` (doc_id, text_hash); the rows travel as one struct, so
    no column of theirs can clash with those of the join."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept"), F.col("doc_id").alias("kept_id"), text_hash.alias("kept_hash"))
    same = F.col("kept_id").eqNullSafe(F.col("gone_id")) & F.col("kept_hash").eqNullSafe(F.col("gone_hash"))
    left = rows.join(gone.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")), same, "left_anti")
    return left.select(*[F.col(f"kept.`{c}`").alias(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spare = Stored(ngram_join.spare_rows(docs, size=5, percent=80).select("doc_id", "text_hash"), "spare")
    kept = _without(docs, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))), spare.df)
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    return kept.dropDuplicates(["doc_id", "text"]) if repeated else kept


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    spoilt = Stored(found.where(decontamination.contaminated()).select("doc_id", "text_hash").distinct(), "spoilt")
    return _without(docs, F.xxhash64("text"), spoilt.df)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    done = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("BPE encoding and decoding", bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last is written and read again."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        after = Stored(stage(spark, docs, sf_dir), "stage")
        if before is not None:
            before.drop()
        docs, before = after.df, after
    return STAGES[-1][1](spark, docs, sf_dir)
