"""Quality classifier from weak labels.

Heuristic labellers look at a whole text and vote bad, good or abstain. They overlap and err, and
nobody tells by how much: expectation-maximisation over the vote patterns of the whole corpus
estimates each labeller's accuracy on good and on bad texts together with the share of bad ones
(votes taken as independent given the true class). The posterior of a pattern is the weak
label of its documents, and a linear scorer over hashed features of tokens and lines learns these labels;
it also scores texts on which the labellers abstain. No given label is used. "few words" is the mean over
stretches of 400 words; the last stretch ends with the text and may overlap the one before, so every word is read.

The votes of all documents are counted (patterns, of which there are ``3 ** len(LABELLERS)`` at most, reach the
driver); the scorer is fitted on about ``FIT_DOCS`` documents picked by hash, all if there are fewer.

Defined results: null text: empty; an empty text is bad (its score is 0); repeated documents get equal
scores; without any documents nothing is fitted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text

FIT_DOCS = 6_000
BUCKETS = 1 << 16
CACHE_TOKENS = 200_000
EM_STEPS, PRIOR_BAD = 60, 0.2
BAD, GOOD, ABSTAIN = 0, 1, 2
_SYMBOL = "$%&#*@^~<>{}[]|\\_=+"
_SYMBOLS = re.compile("[" + re.escape(_SYMBOL) + "]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_WORDLY = re.compile(r"[^\W_]")
_RUN = re.compile(r"([^\w\s])\1(?!\S)")  # two equal punctuation marks that end a word

# name: share of what, (good up to, bad from), fewest words to vote
LABELLERS = {
    "symbols": (0.01, 0.05, 1), "capitals": (0.10, 0.30, 5), "echoes": (0.05, 0.20, 10), "punctuation runs": (0.02, 0.10, 5),
    "bare marks": (0.05, 0.20, 5), "one word": (0.20, 0.35, 20), "few words": (0.55, 0.70, 30), "line copies": (0.10, 0.35, 1),
    "word length": (0.30, 0.60, 5),
}


def measures(text: str) -> tuple[list[str], list[float]]:
    """The tokens of a text and, for each labeller, the share that it judges."""
    words = text.split()
    n = len(words)
    if not n:
        return words, [0.0] * len(LABELLERS)
    kinds: dict[str, int] = {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    bare = sum(c for w, c in kinds.items() if not w[0].isalnum() and not _WORDLY.search(w))
    echoes = sum(map(str.__eq__, words, words[1:]))
    lines = [line for line in text.split("\n") if line.strip()]
    window = min(n, 400)  # the share of new words falls with length: mean over stretches of 400 words
    starts = [*range(0, n - window, window), n - window]  # the last one ends with the text
    new = np.mean([len(set(words[i:i + window])) / window for i in starts])
    return words, [
        len(_SYMBOLS.findall(text)) / len(text), len(_UPPER.findall(text)) / max(1, len(text) - n), echoes / max(1, n - 1),
        len(_RUN.findall(text)) / n, bare / n, max(kinds.values()) / n, 1 - float(new),
        1 - len(set(lines)) / max(1, len(lines)), abs(len(text) / n - 7) / 7]


def votes(n_words: int, shares: list[float]) -> list[int]:
    return [ABSTAIN if n_words < fewest else GOOD if share <= good else BAD if share >= bad else ABSTAIN
            for share, (good, bad, fewest) in zip(shares, LABELLERS.values())]


def estimate(patterns: np.ndarray, counts: np.ndarray, steps: int = EM_STEPS) -> tuple[np.ndarray, np.ndarray, float]:
    """(posterior of good for each pattern, probability of a bad vote [labeller, class], share of bad texts).

    An abstention says nothing: it is left out of the likelihood, so that short texts, which get few
    votes, do not pass for a class of their own.
    """
    says_bad, says_good = (patterns == BAD).astype(float), (patterns == GOOD).astype(float)
    chance_bad = np.tile([0.6, 0.05], (patterns.shape[1], 1))  # votes start as better than chance
    bad = PRIOR_BAD
    for _ in range(steps):
        fit = says_bad @ np.log(chance_bad) + says_good @ np.log(1 - chance_bad) + np.log([bad, 1 - bad])
        fit -= fit.max(axis=1, keepdims=True)
        posterior = np.exp(fit) / np.exp(fit).sum(axis=1, keepdims=True)
        weight = posterior * counts[:, None]
        bad = float(np.clip(weight[:, BAD].sum() / counts.sum(), 1e-4, 1 - 1e-4))
        # pseudo-counts of one document that agrees and one that does not
        chance_bad = (says_bad.T @ weight + 1) / ((says_bad + says_good).T @ weight + 2)
    return posterior[:, GOOD], chance_bad, bad


# ---- hashed linear scorer ------------------------------------------------------------------

def _bucket(feature: str) -> int:
    return crc32(feature.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)


def shape(token: str) -> str:
    """Letters as A or a, digits as 0, runs cut to two, twelve characters at most."""
    core = token.rstrip(".,;:!?")
    if core.isalpha():  # most tokens: a word, perhaps with a mark
        if core.islower():
            return "aa"[:len(core)] + token[len(core):][:2]
        if core[1:].islower() and core[0].isupper():
            return "Aaa"[:len(core)] + token[len(core):][:2]
    cut = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in token)
    return re.sub(r"(.)\1\1+", r"\1\1", cut)[:12]


def token_features(token: str) -> tuple[str, str, str]:
    """Shape, ending and beginning of a token."""
    return "s" + shape(token), "e" + token[-3:], "b" + token[:3].lower()


def share_features(shares: list[float]) -> list[int]:
    """One feature for the step of each labeller's share, and a constant one."""
    return [_bucket("bias")] + [_bucket(f"m{i}:{min(20, int(20 * s ** 0.5))}") for i, s in enumerate(shares)]


def hashed(words: list[str], shares: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features of a text (buckets, values): the mean over its tokens, and its shares' steps."""
    kinds, counts = np.unique(np.array(words, object), return_counts=True) if words else ([], np.zeros(0))
    at = [_bucket(f) for w in kinds for f in token_features(w)] + share_features(shares)
    buckets, inverse = np.unique(np.array(at), return_inverse=True)
    values = np.concatenate([np.repeat(counts / max(1, len(words)), 3), np.ones(len(shares) + 1)])
    return buckets, np.bincount(inverse, values)


class _FeatureWeights(dict):
    """Weight of each feature met."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, feature: str) -> float:
        found = self[feature] = float(self.weights[_bucket(feature)])
        return found


class TokenWeights(dict):
    """The summed weight of each token's features, kept for the tokens met lately."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights, self.parts = weights, _FeatureWeights(weights)

    def __missing__(self, token: str) -> float:
        found = self[token] = sum(map(self.parts.__getitem__, token_features(token)))
        return found

    def logit(self, words: list[str], shares: list[float]) -> float:
        if len(self) > CACHE_TOKENS:
            self.clear()
        if len(self.parts) > CACHE_TOKENS:
            self.parts.clear()
        return sum(map(self.__getitem__, words)) / max(1, len(words)) + float(self.weights[share_features(shares)].sum())


def fit(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = 12, rate: float = 0.3, decay: float = 1e-5) -> np.ndarray:
    """Logistic weights by AdaGrad, from (buckets, values, weak label)."""
    w, seen = np.zeros(BUCKETS), np.full(BUCKETS, 1e-6)
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            buckets, values, label = rows[i]
            p = 1 / (1 + np.exp(-np.clip(w[buckets] @ values, -30, 30)))
            g = (label - p) * values - decay * w[buckets]
            seen[buckets] += g * g
            w[buckets] += rate * g / np.sqrt(seen[buckets])
    return w.astype(np.float32)


# ---- over Spark ----------------------------------------------------------------------------

def vote_patterns(docs: DataFrame) -> DataFrame:
    """(pattern, n): how many documents get each combination of votes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for text in batch.column("text"):
                words, shares = measures(text.as_py())
                if words:
                    pattern = "".join(map(str, votes(len(words), shares)))
                    counts[pattern] = counts.get(pattern, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["pattern", "n"])

    return docs.select("text").mapInArrow(run, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> dict:
    """Labeller accuracies, posterior of each vote pattern, and the scorer's weights."""
    found = sorted((r["pattern"], r["n"]) for r in vote_patterns(docs).collect())
    if not found:
        return {"weights": np.zeros(BUCKETS, np.float32)}
    posterior, table, bad = estimate(np.array([[int(v) for v in p] for p, _ in found]), np.array([n for _, n in found], float))
    weak = {p: float(x) for (p, _), x in zip(found, posterior)}
    share = max(1, -(-sum(n for _, n in found) // FIT_DOCS))

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, values, patterns = [], [], []
            for text in batch.column("text"):
                words, shares = measures(text.as_py())
                at, value = hashed(words, shares)
                buckets.append(at.astype(np.int32))
                values.append(value.astype(np.float32))
                patterns.append("".join(map(str, votes(len(words), shares))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32())), pa.array(patterns, pa.string())],
                ["buckets", "weights", "pattern"])

    picked = docs.where((F.length("text") > 0) & (F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(share)) == 0))
    sample = picked.select("text").mapInArrow(featurize, "buckets array<int>, weights array<float>, pattern string").toArrow()
    rows = [(b.values.to_numpy(), v.values.to_numpy(), weak[p.as_py()])
            for b, v, p in zip(sample["buckets"], sample["weights"], sample["pattern"]) if p.as_py() in weak]
    return {"weights": fit(rows), "votes": table, "bad": bad, "weak": weak}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score, pattern): the probability that a text is good, and the labellers' votes."""
    shared = docs.sparkSession.sparkContext.broadcast(model["weights"])  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenWeights(shared.value)
        for batch in batches:
            scores, patterns = [], []
            for text in batch.column("text"):
                words, shares = measures(text.as_py())
                scores.append(float(1 / (1 + np.exp(-np.clip(known.logit(words, shares), -30, 30)))) if words else 0.0)
                patterns.append("".join(map(str, votes(len(words), shares))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(patterns, pa.string())],
                                             ["doc_id", "score", "pattern"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, pattern string")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, pattern) of every document by a model trained on ``docs`` itself."""
    base = id_text(docs, id_col, text_col)
    return score(base, train(base))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text scores ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(train(id_text(docs, id_col, text_col))["weights"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenWeights(shared.value)
        for batch in batches:
            odds, keep = np.log(threshold) - np.log1p(-threshold), []
            for text in batch.column(text_col):  # one text's words at a time
                words, shares = measures(text.as_py() or "")
                keep.append(bool(words) and known.logit(words, shares) >= odds)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
