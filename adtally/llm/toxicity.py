"""Toxic spans by a linear-chain conditional random field.

The labels are given for documents, so the token labels come from evidence: a word or word beginning
that documents labelled 1 hold significantly often, and others hardly ever, marks its tokens in
those documents. The field (two states, features of the word, its beginnings and its
neighbours, transitions) is trained on these tokens. Forward-backward gives each token of a text the
probability of being toxic; runs over one half are the offending spans, and a logistic function of the
expected number, the largest and the mean probability is the document's score.

Training: near copies teach once (one document for each label and smallest shingle hash). Evidence
and the score's function come from about ``MAX_TRAIN`` labelled documents, the field from ``FIELD_DOCS`` of
them, both picked by hash; below the bounds all are used. The model has a fixed size (``BUCKETS`` weights by three) and
is broadcast. Scoring covers all documents and whole texts, in one pass without a shuffle.

Defined results: null text: empty; an empty text scores like a text without toxic tokens; repeated
documents get equal scores; several labels of a document: the largest; null labels are left out;
without documents of both labels every score is the share of label 1 (no labels: 0).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, id_text

BUCKETS = 1 << 17
MAX_TRAIN, FIELD_DOCS = 40_000, 600
MIN_SUPPORT, MIN_PRECISION, CHANCE = 4, 0.9, 0.05
CACHE_WORDS = 200_000
BEGINNINGS = (3, 4, 5, 6, 7)
EPOCHS, LEARNING_RATE, DECAY = 25, 0.5, 1e-3
SCORE_SCHEMA = "doc_id long, score double, n_tokens long, spans array<struct<begin:int,end:int,probability:double>>"
_TOKEN = re.compile(r"\w+")


def features(word: str) -> list[str]:
    """The word and its beginnings, lower case."""
    low = word.lower()
    return [low] + [f"{low[:k]}*" for k in BEGINNINGS if len(low) >= k]


def bucket(feature: str) -> int:
    return crc32(feature.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)


# ---- chains of two states ------------------------------------------------------------------

def _times(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    """Scaled product of 2 x 2 matrices whose four entries (by rows) are arrays."""
    out = [a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3]]
    scale = 1 / (out[0] + out[1] + out[2] + out[3])
    return [x * scale for x in out]


def running_products(entries: list[np.ndarray], width: int = 32) -> list[np.ndarray]:
    """Products of the first 1, 2, ... n matrices, scaled: inside blocks side by side, then over the blocks."""
    n = len(entries[0])
    if n == 1:
        return entries
    width = min(width, n)
    blocks = -(-n // width)
    grid = []
    for k, x in enumerate(entries):
        padded = np.full(blocks * width, float(k in (0, 3)))
        padded[:n] = x
        grid.append(padded.reshape(blocks, width).T.copy())  # a row for each place in a block
    for j in range(1, width):
        for x, row in zip(grid, _times([x[j - 1] for x in grid], [x[j] for x in grid])):
            x[j] = row
    if blocks > 1:
        before = running_products([x[-1].copy() for x in grid], width)
        for x, later in zip(grid, _times([x[None, :-1] for x in before], [x[:, 1:] for x in grid])):
            x[:, 1:] = later
    return [x.T.ravel()[:n] for x in grid]


def forward_backward(odds: np.ndarray, starts: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginal of state 1 for each token, and the expected number of each pair of neighbouring states.

    ``odds``: log-odds of state 1 from the token's features; ``starts``: true where a text begins;
    ``transitions``: log weights (2, 2). A text's first token forgets what came before it.
    """
    n = len(odds)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    emit = np.exp(-np.maximum(odds, 0)), np.exp(np.minimum(odds, 0))
    weight = np.exp(transitions)
    steps = [np.where(starts, emit[j], weight[i, j] * emit[j]) for i in (0, 1) for j in (0, 1)]
    product = running_products(steps)
    forward = product[0] + product[2], product[1] + product[3]
    backward = np.ones(n), np.ones(n)
    if n > 1:
        back = running_products([steps[k][1:][::-1].copy() for k in (0, 2, 1, 3)])  # transposed, from the end
        for x, column in zip(backward, (back[0] + back[2], back[1] + back[3])):
            x[:-1] = column[::-1]
    single = forward[1] * backward[1] / (forward[0] * backward[0] + forward[1] * backward[1])
    inner = np.flatnonzero(~starts)
    pairs = [forward[i][inner - 1] * steps[2 * i + j][inner] * backward[j][inner] for i in (0, 1) for j in (0, 1)]
    total = pairs[0] + pairs[1] + pairs[2] + pairs[3]
    return single, np.array([(p / total).sum() for p in pairs]).reshape(2, 2)


class Words:
    """Numbers of words, with the weights that each brings as token, as the word before and as the word after."""

    def __init__(self, here: np.ndarray, before: np.ndarray, after: np.ndarray):
        self.weights = (here, before, after)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.table = np.zeros((1024, 3))

    def _learn(self, words: list[str]) -> None:
        here, before, after = self.weights
        while len(self.number) + len(words) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        for word in words:
            buckets = [bucket(f) for f in features(word)]
            self.table[len(self.number)] = here[buckets].sum(), before[buckets[0]], after[buckets[0]]
            self.number[word] = len(self.number)

    def odds(self, words: list[str], starts: np.ndarray) -> np.ndarray:
        if len(self.number) > CACHE_WORDS:
            self.clear()
        self._learn([w for w in set(words) if w not in self.number])
        at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        out = self.table[at, 0]
        inner = np.flatnonzero(~starts)
        out[inner] += self.table[at[inner - 1], 1]
        out[inner - 1] += self.table[at[inner], 2]
        return out


def train_field(docs: list[tuple[list[str], np.ndarray]]) -> dict:
    """Weights by gradient ascent on the conditional likelihood, from (words, token labels) of each text."""
    words = [w for ws, _ in docs for w in ws]
    truth = np.concatenate([y for _, y in docs]).astype(np.int64)
    starts = np.zeros(len(words), bool)
    starts[np.cumsum([0] + [len(ws) for ws, _ in docs])[:-1]] = True
    kinds: dict[str, int] = {}
    at = np.fromiter((kinds.setdefault(w, len(kinds)) for w in words), np.int64, len(words))
    owner, feature = [], []
    for word, kind in kinds.items():
        for f in features(word):
            owner.append(kind)
            feature.append(bucket(f))
    owner, feature = np.array(owner), np.array(feature)
    word_bucket = np.array([bucket(w.lower()) for w in kinds])
    inner = np.flatnonzero(~starts)
    weights = {"here": np.zeros(BUCKETS), "before": np.zeros(BUCKETS), "after": np.zeros(BUCKETS),
               "bias": np.full(1, -4.0), "transitions": np.zeros((2, 2))}
    seen = {k: np.full_like(v, 1e-8) for k, v in weights.items()}
    observed = np.zeros((2, 2))
    np.add.at(observed, (truth[inner - 1], truth[inner]), 1)
    for _ in range(EPOCHS):
        kind_odds = np.bincount(owner, weights["here"][feature], len(kinds)) + weights["bias"][0]
        odds = kind_odds[at]
        odds[inner] += weights["before"][word_bucket[at[inner - 1]]]
        odds[inner - 1] += weights["after"][word_bucket[at[inner]]]
        single, pairs = forward_backward(odds, starts, weights["transitions"])
        miss = truth - single
        per_kind = np.bincount(at, miss, len(kinds))
        gradient = {
            "here": np.bincount(feature, per_kind[owner], BUCKETS),
            "before": np.bincount(word_bucket[at[inner - 1]], miss[inner], BUCKETS),
            "after": np.bincount(word_bucket[at[inner]], miss[inner - 1], BUCKETS),
            "bias": np.array([miss.sum()]), "transitions": observed - pairs}
        for k, g in gradient.items():
            g = g - DECAY * weights[k]
            seen[k] += g * g
            weights[k] = weights[k] + LEARNING_RATE * g / np.sqrt(seen[k])
    return weights


def marginals(texts: list[list[str]], words: Words, weights: dict) -> list[np.ndarray]:
    sizes = [len(t) for t in texts]
    flat = [w for t in texts for w in t]
    starts = np.zeros(len(flat), bool)
    ends = np.cumsum(sizes)
    firsts = ends - sizes
    starts[firsts[np.array(sizes) > 0]] = True
    if not flat:
        return [np.zeros(0) for _ in texts]
    single, _ = forward_backward(words.odds(flat, starts) + weights["bias"][0], starts, weights["transitions"])
    return np.split(single, ends[:-1])


def summary(p: np.ndarray) -> list[float]:
    """What a score is made of: bias, expected toxic tokens (log), largest, mean and root of the mean probability."""
    if not len(p):
        return [1.0, 0.0, 0.0, 0.0, 0.0]
    mean = float(p.mean())
    return [1.0, math.log1p(mean * len(p)), float(p.max()), 10 * mean, 3 * math.sqrt(mean)]


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 30, ridge: float = 1e-2) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w = w + np.clip(step, -5, 5)
    return w


# ---- training over Spark -------------------------------------------------------------------

def _training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, label), one row for each label and smallest hash of a five-word shingle, at most MAX_TRAIN or so."""
    rows = docs.join(labels, "doc_id")
    total = rows.select("doc_id").count()
    share = max(1, -(-total // MAX_TRAIN))
    picked = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(share)) == 0)
    # bound as an array element, so that the words are cut once and not for every shingle
    smallest = F.get(F.transform(F.array(F.split(F.lower("text"), r"\s+")), lambda words: F.array_min(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(words) - 5, F.lit(0))),
        lambda i: F.xxhash64(F.slice(words, i + 1, F.lit(5)))))), F.lit(0))
    return (picked.select("text", "label", smallest.alias("first_shingle"))
            .groupBy("label", "first_shingle").agg(F.min("text").alias("text")).select("text", "label"))


def _counts(rows: DataFrame, wanted: set | None) -> DataFrame:
    """(feature, n): for each feature (of ``wanted``) its distinct words in a document, summed over the documents."""
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, known, keep = Counter(), {}, shared.value
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for word in set(_TOKEN.findall(text)):
                    if word not in known:
                        known[word] = [f for f in features(word) if keep is None or f in keep]
                    counts.update(known[word])
                if len(known) > CACHE_WORDS:
                    known.clear()
            if len(counts) > 2 * CACHE_WORDS:
                yield _count_batch(counts)
                counts = Counter()
        yield _count_batch(counts)

    return rows.select("text").mapInArrow(count, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _count_batch(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["feature", "n"])


def evidence(rows: DataFrame, n_clean: int, n_toxic: int) -> set[str]:
    """Words and beginnings that mark toxic tokens: the most general ones that are marks by themselves.

    A feature is a mark if it is significant (after Bonferroni's correction) and precise at equal shares
    of the labels. A beginning is one only if it stays so without the best of the longer beginnings or
    words in it; else those are looked at instead.
    """
    toxic = Stored(_counts(rows.where("label = 1"), None), "evidence")
    tested = toxic.df.count()
    share = n_toxic / (n_clean + n_toxic)
    needed = math.log(max(2, tested) / CHANCE)
    support = max(MIN_SUPPORT, math.ceil(needed / -math.log(share)))
    held = {r["feature"]: r["n"] for r in toxic.df.where(F.col("n") >= support).collect()}
    toxic.drop()
    clean = {r["feature"]: r["n"] for r in _counts(rows.where("label = 0"), set(held)).collect()}

    def marks(n1: int, n0: int) -> bool:
        if n1 < support:
            return False
        precision = n1 / (n1 + n0)
        gain = n1 * math.log(precision / share) + (n0 * math.log((1 - precision) / (1 - share)) if n0 else 0)
        rate1, rate0 = n1 / n_toxic, (n0 + 0.5) / n_clean
        return precision > share and gain >= needed and rate1 / (rate1 + rate0) >= MIN_PRECISION

    inside: dict[str, list[str]] = {}
    for feature in held:
        own = feature.removesuffix("*")
        longest = max((k for k in BEGINNINGS if k < len(own) or (k == len(own) and own == feature)), default=0)
        inside.setdefault(f"{own[:longest]}*" if longest else "", []).append(feature)
    found, look = set(), list(inside.get("", []))
    while look:
        feature = look.pop()
        parts = inside.get(feature, [])
        best = max(parts, key=lambda p: held[p], default=None)
        n1, n0 = held[feature], clean.get(feature, 0)
        alone = best is None or marks(n1 - held[best], n0 - clean.get(best, 0))
        if alone and marks(n1, n0):
            found.add(feature)
        else:
            look += parts
    return found


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """A model (plain arrays) from (doc_id, text) and (doc_id, label)."""
    rows = Stored(_training_rows(docs, labels), "training")
    sizes = {r["label"]: r["n"] for r in rows.df.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    constant = {"constant": n_toxic / (n_clean + n_toxic) if n_clean + n_toxic else 0.0}
    if not n_clean or not n_toxic:
        rows.drop()
        return constant
    marks = evidence(rows.df, n_clean, n_toxic)
    half = FIELD_DOCS // 2
    sample = [r for label in (0, 1) for r in rows.df.where(F.col("label") == label)
              .orderBy(F.xxhash64("text")).limit(half).collect()]
    texts = [(_TOKEN.findall(r["text"]), r["label"]) for r in sample]
    marked = [(words, np.array([bool(label) and not marks.isdisjoint(features(w)) for w in words], np.int8))
              for words, label in texts if words]
    if not marks or not marked:
        rows.drop()
        return constant
    weights = train_field(marked)
    weights = {k: v.astype(np.float32) if len(v) == BUCKETS else v for k, v in weights.items()}
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(shared.value["here"], shared.value["before"], shared.value["after"])
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                found = marginals([_TOKEN.findall(t) for t in part.column("text").to_pylist()], known, shared.value)
                yield pa.RecordBatch.from_arrays([part.column("label"), pa.array([summary(p) for p in found], pa.list_(pa.float64()))], ["label", "x"])

    seen = rows.df.select("label", "text").mapInArrow(summaries, "label int, x array<double>").toArrow()  # MAX_TRAIN rows or so
    rows.drop()
    return {"weights": weights, "score": fit_logistic(np.array(seen["x"].to_pylist()), seen["label"].to_numpy().astype(float))}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score, n_tokens, spans) of every document; spans are code points (begin, end) with their mean probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_ = shared.value
        weights = model_.get("weights")
        words = Words(weights["here"], weights["before"], weights["after"]) if weights else None
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                texts = part.column("text").to_pylist()
                tokens = [_TOKEN.findall(t) for t in texts]
                scores, spans = [], []
                if words is None:
                    scores, spans = [model_["constant"]] * len(texts), [[]] * len(texts)
                else:
                    for text, p in zip(texts, marginals(tokens, words, weights)):
                        scores.append(float(1 / (1 + np.exp(-np.clip(np.dot(summary(p), model_["score"]), -30, 30)))))
                        spans.append(offending(text, p) if len(p) and p.max() >= 0.5 else [])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores, pa.float64()), pa.array([len(t) for t in tokens], pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())])))],
                    ["doc_id", "score", "n_tokens", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, SCORE_SCHEMA)


def offending(text: str, p: np.ndarray) -> list[dict]:
    """Runs of tokens whose probability is at least one half."""
    places = [m.span() for m in _TOKEN.finditer(text)]
    edges = np.diff(np.concatenate([[0], (p >= 0.5).astype(np.int8), [0]]))
    return [{"begin": places[a][0], "end": places[b - 1][1], "probability": float(p[a:b].mean())}
            for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist())]


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Score all ``docs`` with a model trained on the rows of ``labels`` (their ids and 0 or 1)."""
    base = id_text(docs, id_col, text_col)
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .where("label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label")))
    return score(base, train(base, known))
