"""Benchmark decontamination with a distributed positional inverted index.

Words are runs of ASCII letters and digits and of any non-ASCII characters, A-Z lower-cased. Each
window of 13 consecutive item words (an item of fewer words is one window) is looked up:

1. The frequency of every test term in the whole corpus picks the two rarest places of each window.
2. The index of these rare terms is built and stored: rows (term, doc, positions).
3. The offset-adjusted position lists of the two places are intersected, from the rarest; what is
   left are alignments (doc, item, shift) of an item along a document.
4. Each alignment is compared word by word with the whole text, which gives exact phrase hits.

With ``slop``, ``contamination`` also names, from the same index, the items near a document: it holds the two
rarest different words of a window (of those that the corpus has) within ``slop`` words, in any order. A window
of one word is near where that word is; one of which the corpus has a single word of several is near nothing.

Defined results: null text has no words; items without words are never found; repeated documents
get equal results, one for each row; repeated items with one id and text count once; a null
doc_id is kept as it is. Items are used in blocks of bounded size: the terms of a block are
broadcast, their number being bounded by ``BLOCK_BYTES`` of item text, and each block is one more
pass over the documents. Alignments are broadcast only under ``BROADCAST_BYTES``; beyond that
they are joined by document. Lists are gathered by document and term or by document, never by
term: a term or passage that a third of the documents share is many small rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stored, size_in_bytes

WINDOW = 13
BLOCK_BYTES = 16 << 20
BROADCAST_BYTES = 32 << 20
INDEX_SCHEMA = "term int, doc_id long, text_hash long, positions array<int>"
HIT_SCHEMA = "doc_id long, text_hash long, n_words long, n_hit long, spans array<struct<begin:int,end:int>>, item_ids array<string>"

# every byte that is not part of a word becomes a space; A-Z become a-z
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _windows(item: list[bytes], size: int) -> range:
    return range(max(1, len(item) - size + 1)) if item else range(0)


def corpus_counts(docs: DataFrame, terms: dict[bytes, int]) -> np.ndarray:
    """Occurrences of each test term in all documents; the result is as long as the term list."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, total = shared.value.get, np.zeros(len(shared.value) + 1, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                ids = list(map(get, words(text.as_py()), repeat(-1)))
                if ids:
                    total += np.bincount(np.array(ids, np.int32) + 1, minlength=len(total))
        found = np.flatnonzero(total[1:])
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[1:][found])], ["term", "n"])

    rows = docs.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(len(terms), np.int64)
    for row in rows:
        counts[row["term"]] = row["n"]
    return counts


def build_index(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """Positional postings (term, doc_id, text_hash, positions) of the given terms over whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, hashes = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            out_term, out_row, out_pos = [], [], []
            for row, text in enumerate(batch.column("text")):
                found: dict[int, list[int]] = {}
                for pos, term in enumerate(map(known.get, words(text.as_py()))):
                    if term is not None:
                        found.setdefault(term, []).append(pos)
                out_term += found.keys()
                out_row += [row] * len(found)
                out_pos += found.values()
            if out_term:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_term, pa.int32()), pa.array([ids[r] for r in out_row], pa.int64()),
                     pa.array([hashes[r] for r in out_row], pa.int64()), pa.array(out_pos, pa.list_(pa.int32()))],
                    ["term", "doc_id", "text_hash", "positions"])

    return docs.select("doc_id", "text_hash", "text").mapInArrow(postings, INDEX_SCHEMA)


def rare_places(items: list[tuple[int, list[bytes]]], terms: dict[bytes, int], counts: np.ndarray, size: int) -> set:
    """(term, other term, item, place, other place): the two rarest places of each window, the rarest first."""
    probes = set()
    for item, tokens in items:
        rank = [(int(counts[terms[w]]), p) for p, w in enumerate(tokens)]
        for start in _windows(tokens, size):
            here = sorted(rank[start:start + size])[:2]
            if all(n for n, _ in here):  # a term that the corpus lacks: no window with it can occur
                first, other = here[0][1], here[-1][1]
                probes.add((terms[tokens[first]], terms[tokens[other]], item, first, other))
    return probes


def near_places(items: list[tuple[int, list[bytes]]], terms: dict[bytes, int], counts: np.ndarray, size: int) -> set:
    """As ``rare_places``: the first places of the two rarest different terms of each window that the corpus has."""
    probes = set()
    for item, tokens in items:
        rank = [(int(counts[terms[w]]), terms[w], p) for p, w in enumerate(tokens)]
        for start in _windows(tokens, size):
            first: dict[int, tuple] = {}
            for each in rank[start:start + size]:
                first.setdefault(each[1], each)
            here = sorted(each for each in first.values() if each[0])[:2]
            if len(here) == min(2, len(first)):
                probes.add((here[0][1], here[-1][1], item, here[0][2], here[-1][2]))
    return probes


def alignments(index: DataFrame, probes: set) -> DataFrame:
    """Intersect offset-adjusted lists: distinct (doc_id, text_hash, item, shift), shift = document minus item position."""
    spark = index.sparkSession
    asked = F.broadcast(spark.createDataFrame(  # bounded by the block of items
        pd.DataFrame(sorted(probes), columns=["term", "other", "item", "place", "other_place"]),
        "term int, other int, item int, place int, other_place int"))
    rare = index.join(asked, "term").select(
        "doc_id", "text_hash", "item", "other", "other_place",
        F.transform("positions", lambda p: p - F.col("place")).alias("shifts"))
    other = index.select(F.col("term").alias("other"), "doc_id", "text_hash", F.col("positions").alias("other_positions"))
    both = rare.join(other, (rare["other"] == other["other"]) & rare["doc_id"].eqNullSafe(other["doc_id"])
                     & (rare["text_hash"] == other["text_hash"]))
    return both.select(rare["doc_id"], rare["text_hash"], "item", F.explode(F.array_intersect(
        "shifts", F.transform("other_positions", lambda p: p - F.col("other_place")))).alias("shift")).distinct()


def proximity(index: DataFrame, probes: set, slop: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, item, place, other_place): both rare terms of a window within ``slop`` words, any order."""
    spark = index.sparkSession
    asked = F.broadcast(spark.createDataFrame(
        pd.DataFrame(sorted(probes), columns=["term", "other", "item", "place", "other_place"]),
        "term int, other int, item int, place int, other_place int"))
    rare = index.join(asked, "term")
    other = index.select(F.col("term").alias("other"), "doc_id", "text_hash", F.col("positions").alias("other_positions"))
    both = rare.join(other, (rare["other"] == other["other"]) & rare["doc_id"].eqNullSafe(other["doc_id"])
                     & (rare["text_hash"] == other["text_hash"]))
    near = F.exists("positions", lambda p: F.exists("other_positions", lambda q: F.abs(p - q) <= slop))
    return both.where(near).select(rare["doc_id"], rare["text_hash"], "item", "place", "other_place").distinct()


def _verify(docs: DataFrame, found: DataFrame, items: list[tuple[int, list[bytes]]], names: list[str], size: int) -> DataFrame:
    """Compare every alignment with the text: hit words and items, one row for each document row."""
    shared = docs.sparkSession.sparkContext.broadcast((items, names))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = dict(shared.value[0])
        label = shared.value[1]
        for batch in batches:
            n_words, n_hit, spans, hit_items = [], [], [], []
            for text, shifts in zip(batch.column("text"), batch.column("found").to_pylist()):
                doc = words(text.as_py())
                hit, seen = np.zeros(len(doc) + 2, np.int8), set()  # a margin on both sides
                for each in shifts or ():
                    item, shift = tokens[each["item"]], each["shift"]
                    length, run = min(size, len(item)), 0
                    for p in range(max(0, -shift), min(len(item), len(doc) - shift)):
                        run = run + 1 if doc[p + shift] == item[p] else 0
                        if run >= length:
                            hit[p + shift - length + 2:p + shift + 2] = 1
                            seen.add(label[each["item"]])
                edges = np.diff(hit)
                begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
                n_words.append(len(doc))
                n_hit.append(int((end - begin).sum()))
                spans.append([{"begin": b, "end": e} for b, e in zip(begin.tolist(), end.tolist())])
                hit_items.append(sorted(seen))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
                 pa.array(hit_items, pa.list_(pa.string()))],
                ["doc_id", "text_hash", "n_words", "n_hit", "spans", "item_ids"])

    by_doc = found.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("item", "shift")).alias("found"))
    kept = Stored(by_doc, "alignments")
    held = kept.df.agg(F.sum(F.size("found") * 8 + 64)).first()[0] or 0
    right = kept.df.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), "found")
    joined = docs.join(F.broadcast(right) if held <= BROADCAST_BYTES else right,
                       docs["doc_id"].eqNullSafe(F.col("_d")) & docs["text_hash"].eqNullSafe(F.col("_h")), "left")
    return joined.select("doc_id", "text_hash", "text", "found").mapInArrow(compare, HIT_SCHEMA)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", size: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES, slop: int | None = None) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, spans, item_ids), one row for each document row.

    ``spans`` are the hit runs of words (begin, end), ``item_ids`` the items with a window that occurs. With
    ``slop``, there is also ``near_ids``: the items with a window whose two rarest words occur within so many
    words. From ``size`` up, these include ``item_ids``.
    """
    keyed = _keyed(docs, id_col, text_col)
    bench = benchmark.select(F.col(item_col).cast("string").alias("item_id"),
                             F.col(item_text_col).cast("string").alias("text")).distinct()
    blocks = max(1, math.ceil(size_in_bytes(bench, "text") / block_bytes))
    parts, near = [], []
    for block in range(blocks):
        rows = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        named = sorted((str(r["item_id"]), words(r["text"])) for r in rows)
        items = [(i, tokens) for i, (_, tokens) in enumerate(named) if tokens]
        terms = {w: t for t, w in enumerate(sorted({w for _, tokens in items for w in tokens}))}
        counts = corpus_counts(keyed, terms)
        probes = rare_places(items, terms, counts, size)
        close = near_places(items, terms, counts, size) if slop is not None else set()
        wanted = {t for p in probes | close for t in p[:2]}
        index = Stored(build_index(keyed, {w: t for w, t in terms.items() if t in wanted}), "postings")
        parts.append(_verify(keyed, alignments(index.df, probes), items, [n for n, _ in named], size))
        if slop is not None:
            near.append(Stored(_named_near(proximity(index.df, close, slop), [n for n, _ in named]), "near").df)
        index.drop()
    hits = parts[0] if blocks == 1 else _merged(keyed, parts)
    return hits if slop is None else _with_near(hits, near)


def _named_near(found: DataFrame, names: list[str]) -> DataFrame:
    """(doc_id, text_hash, item_id) of the items found near a document."""
    label = F.broadcast(found.sparkSession.createDataFrame(  # bounded by the block of items
        pd.DataFrame({"item": np.arange(len(names), dtype=np.int32), "item_id": names}), "item int, item_id string"))
    return found.join(label, "item").select("doc_id", "text_hash", "item_id").distinct()


def _with_near(hits: DataFrame, near: list[DataFrame]) -> DataFrame:
    rows = near[0]
    for part in near[1:]:
        rows = rows.unionByName(part)
    by_doc = rows.groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).agg(
        F.array_sort(F.collect_set("item_id")).alias("near_ids"))
    joined = hits.join(by_doc, hits["doc_id"].eqNullSafe(F.col("_d")) & hits["text_hash"].eqNullSafe(F.col("_h")), "left")
    return joined.select(*[hits[c] for c in hits.columns], F.coalesce("near_ids", F.array().cast("array<string>")).alias("near_ids"))


def contaminated() -> Column:
    """The rule: any hit word, and one in twenty of a document's words or more."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def _merged(keyed: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """Unite the hits that several blocks of items found in a document."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    united = rows.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_set("spans"))).alias("all"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"))
    none = F.array().cast("array<struct<begin:int,end:int>>")
    merged = F.aggregate("all", none, lambda acc, s: F.when(
        F.coalesce(F.get(acc, F.size(acc) - 1)["end"] >= s["begin"], F.lit(False)),
        F.array_append(F.slice(acc, F.lit(1), F.size(acc) - 1), F.struct(
            F.get(acc, F.size(acc) - 1)["begin"].alias("begin"),
            F.greatest(F.get(acc, F.size(acc) - 1)["end"], s["end"]).alias("end")))).otherwise(F.array_append(acc, s)))
    counted = united.withColumn("spans", merged).select(
        F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"]).alias("n_hit"), "spans", "item_ids")
    return (keyed.select("doc_id", "text_hash")
            .join(counted, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("text_hash").eqNullSafe(F.col("_h")))
            .drop("_d", "_h"))
