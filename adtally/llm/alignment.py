"""Alignment of two tokenizers over the same texts by merge-path partitioning.

A is a byte-level BPE vocabulary (tokenizers library), B a piece vocabulary with byte fallback (sentencepiece). A encodes
space + text, B the text (it adds the space). Every token covers bytes of space + text; a text whose
joined A or B bytes differ from that (also a null or empty one) has no tokens. Where an A and a B token both
end, a group ends. An A and a B token whose byte ranges overlap are a link.

Merge path: the texts of a chunk stand one after another, so their A ends and B ends are two ascending lists.
Merging them is a path through a grid; binary searches on equally spaced diagonals find its crossings, and between
two crossings lies a piece of the merge of equal work, whatever the lengths of the texts are. A piece merges its
slices of the two lists alone: each distinct end is one overlap of an A and a B token, and an end of both is
the end of a group. Groups that cross a piece's boundary are stitched by the marks that the pieces leave on the tokens.

Texts are encoded once: the ids of a chunk of texts are a row of a stored table, compressed.

Corpus counts: (a, b, n) is how many links hold an id pair. Tasks count the links of many texts before they send a
pair; the pairs are summed by a group-by. To give each text the counts of its links, chunks of texts send their
distinct pairs to ranges of pairs, and the ranges answer in the same order. Ranges are split by chunk as well, so that
a pair that all texts hold is asked of many tasks. The highest count of each B id is a number for each entry
of B's vocabulary, and only that is broadcast.

Encoding: A's ids are merge ranks, so the tiktoken library gives the ids of the tokenizers library; where they are not,
the latter is asked itself. B is asked for blocks of a text, cut before single spaces: no piece of B goes on behind
a space (checked when it is loaded), and long blocks cost more than their share.

Defined results: null and empty texts have zeros and empty groups, as have texts that differ from their tokens' bytes;
rows with equal id stay rows of their own; a null id is an id like any other.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_letters
from .common import Stored, id_text

CHUNK_BYTES = 4 << 20  # text in a chunk, on average
PIECE_ENDS = 1 << 18  # ends that a piece merges
COUNTED_PAIRS = 3 << 20  # pairs that a task holds before it sends them
RANGE_PAIRS = 1 << 20  # distinct pairs in a range, on average
RANGE_CHUNKS = 64  # chunks that ask one copy of a range, on average
SPACE_PIECE = "▁"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value: A's word pattern
_BLOCK = re.compile(r"(?s).{200,}?(?<=\S)(?= \S)|.+")
ENCODED = "chunk long, doc_ids array<long>, n_a array<int>, n_b array<int>, a binary, b binary, pairs binary, counts binary"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


class Tables:
    """What the merge needs of two vocabularies: token lengths in bytes, and ids as text."""

    def __init__(self, a_length: np.ndarray, b_length: np.ndarray, shown: np.ndarray, width: np.ndarray):
        self.a_length, self.b_length, self.shown, self.width = a_length, b_length, shown, width
        self.n_a, self.n_b = len(a_length), len(b_length)


class Pair:
    """Both vocabularies, from their files' contents: token bytes by id, and ids of texts."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece
        import tiktoken

        spec = json.loads(a_file)
        byte_of = {letter: bytes([b]) for b, letter in enumerate(byte_letters())}
        special = {t["content"] for t in spec["added_tokens"]}
        a_ids = {b"".join(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        a_bytes = {i: token for token, i in a_ids.items()}
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        rule = spec["pre_tokenizer"] or {}
        words = rule.get("type") == "ByteLevel" and rule.get("use_regex", True) and not rule.get("add_prefix_space")
        if words and spec["normalizer"] is None and [spec["model"]["vocab"][m] for m in merged] == list(range(256, 256 + len(merged))):
            self._a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=a_ids, special_tokens={}).encode_ordinary
        else:
            self._a = self._a_library(a_file)
        self._b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self.a_bytes = [a_bytes.get(i, b"") for i in range(max(a_bytes) + 1)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace(SPACE_PIECE, " ").encode() for i, p in enumerate(pieces)]
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << 16:
            raise ValueError("ids over two bytes")
        plain = [p for i, p in enumerate(pieces) if not self._b.is_byte(i)]
        self.cuts = not any(SPACE_PIECE in p.lstrip(SPACE_PIECE) or " " in p for p in plain)

    @staticmethod
    def _a_library(a_file: bytes):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(a_file.decode())
        tokenizer.no_truncation()
        tokenizer.no_padding()
        tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids

    def tables(self) -> dict[str, np.ndarray]:
        """Arguments of ``Tables``."""
        # an id with what follows it: in its group, at its side's end, at the text's end (B)
        shown = [f"{i}{end}" for i in range(len(self.a_bytes)) for end in (",", "|", "")] + [f"{i}{end}" for i in range(len(self.b_bytes)) for end in (",", ";", "")]
        return {"a_length": np.array([len(x) for x in self.a_bytes], np.int64), "b_length": np.array([len(x) for x in self.b_bytes], np.int64),
                "shown": np.array(shown, "S6").view(np.uint8).reshape(-1, 6), "width": np.array([len(x) for x in shown], np.int64)}

    def encode(self, text: str | None) -> tuple[bytes, bytes]:
        """Ids of A and of B, two bytes each; empty where a text has no tokens."""
        if not text:
            return b"", b""
        blocks = _BLOCK.findall(text) if self.cuts else [text]
        b = self._b.encode([blocks[0], *[x[1:] for x in blocks[1:]]], num_threads=1)  # B adds each block's space
        a, b = self._a(" " + text), list(chain.from_iterable(b))
        if not (" " + text).encode() == b"".join([self.a_bytes[i] for i in a]) == b"".join([self.b_bytes[i] for i in b]):
            return b"", b""
        return array("H", a).tobytes(), array("H", b).tobytes()


def read_vocabularies(a_path: str, b_path: str) -> tuple[bytes, bytes]:
    """Contents of both files: some megabytes, which travel with the job."""
    with open(a_path, "rb") as a, open(b_path, "rb") as b:
        return a.read(), b.read()


def crossings(a_ends: np.ndarray, b_ends: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge path (A first on ties) crosses every ``step``-th diagonal: tokens of A and of B before it."""
    total = len(a_ends) + len(b_ends)
    diagonal = np.unique(np.append(np.arange(0, total, step), total))
    low, high = np.maximum(0, diagonal - len(b_ends)), np.minimum(diagonal, len(a_ends))
    while True:  # binary searches on all diagonals at once
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low, diagonal - low
        middle = (low[open_] + high[open_]) // 2
        a_first = a_ends[middle] <= b_ends[diagonal[open_] - 1 - middle]
        low[open_[a_first]] = middle[a_first] + 1
        high[open_[~a_first]] = middle[~a_first]


def piece_overlaps(a_ends: np.ndarray, b_ends: np.ndarray, i0: int, i1: int, j0: int, j1: int):
    """Overlaps that end in a piece, as (A, B) token numbers in two ascending lists, and the groups' last tokens."""
    ends = b_ends[j0:j1]
    covering = i0 + np.searchsorted(a_ends[i0:i1], ends, "right")
    shared = (covering > 0) & (a_ends[np.maximum(covering - 1, 0)] == ends)
    at_b = covering - shared, np.arange(j0, j1)
    ends = a_ends[i0:i1]
    over = j0 + np.searchsorted(b_ends[j0:j1], ends, "left")
    alone = b_ends[np.minimum(over, len(b_ends) - 1)] != ends  # an end of both is counted with B's
    at_a = np.arange(i0, i1)[alone], over[alone]
    return at_a, at_b, at_b[0][shared], at_b[1][shared]


class Chunk:
    """Tokens of several texts, one after another."""

    def __init__(self, tables: Tables, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray):
        self.tables, self.a, self.b = tables, a, b
        self.a_from, self.b_from = (np.concatenate([[0], np.cumsum(n, dtype=np.int64)]) for n in (n_a, n_b))
        self.a_ends, self.b_ends = np.cumsum(tables.a_length[a]), np.cumsum(tables.b_length[b])

    def pieces(self) -> Iterator[tuple]:
        """Of each piece: its A and B tokens' numbers by overlap, twice (see ``piece_overlaps``), and group ends."""
        i, j = crossings(self.a_ends, self.b_ends, PIECE_ENDS)
        for bounds in zip(i[:-1].tolist(), i[1:].tolist(), j[:-1].tolist(), j[1:].tolist()):
            yield piece_overlaps(self.a_ends, self.b_ends, *bounds)

    def keys(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.a[a].astype(np.int64) * self.tables.n_b + self.b[b]

    def pair_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct keys and how many links hold each."""
        parts = [np.unique(np.concatenate([self.keys(*at_a), self.keys(*at_b)]), return_counts=True) for at_a, at_b, _, _ in self.pieces()]
        return _summed(parts) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def aligned(self, lookup: Callable[[np.ndarray], np.ndarray], best: np.ndarray, ids: pa.Array) -> pa.Table:
        """Rows of ``ALIGNED``; ``lookup`` gives the counts of keys, ``best`` is the highest count of each B id."""
        rows = len(self.a_from) - 1
        n_a, n_b = np.diff(self.a_from), np.diff(self.b_from)
        n_best, sums = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        a_last, b_last = np.zeros(len(self.a), np.int8), np.zeros(len(self.b), np.int8)
        for at_a, at_b, last_a, last_b in self.pieces():
            a_last[last_a], b_last[last_b] = 1, 1
            for (a, b), own, start in ((at_a, at_a[0], self.a_from), (at_b, at_b[1], self.b_from)):
                if not len(own):
                    continue
                count = lookup(self.keys(a, b))
                first = np.searchsorted(own, start)  # overlaps of a text lie together
                for total, value in ((sums, count), (n_best, count == best[self.b[b]])):
                    total += np.diff(np.concatenate([[0], np.cumsum(value, dtype=np.int64)])[first])
        n_groups = np.diff(np.concatenate([[0], np.cumsum(a_last, dtype=np.int64)])[self.a_from])
        columns = [pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_a + n_b - n_groups, n_best, sums)]
        return pa.table([ids, *columns, self._groups(a_last, b_last)],
                        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    def _groups(self, a_last: np.ndarray, b_last: np.ndarray) -> pa.Array:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``, decimal ids in order."""
        a_stop, b_stop = np.flatnonzero(a_last) + 1, np.flatnonzero(b_last) + 1  # behind each group
        b_last[self.b_from[1:][np.diff(self.b_from) > 0] - 1] = 2  # nothing follows a text's last token
        a_width, b_width = self.tables.width[self.a.astype(np.int64) * 3 + a_last], self.tables.width[3 * self.tables.n_a + self.b.astype(np.int64) * 3 + b_last]
        offsets = sum(np.concatenate([[0], np.cumsum(w)])[start] for w, start in ((a_width, self.a_from), (b_width, self.b_from)))
        out, i, j = [], 0, 0
        for g in range(0, len(a_stop), PIECE_ENDS):  # some groups at a time
            h = min(len(a_stop), g + PIECE_ENDS)
            a, b = slice(i, a_stop[h - 1]), slice(j, b_stop[h - 1])
            a_sizes, b_sizes = (np.diff(np.concatenate([[x], stop[g:h]])) for x, stop in ((i, a_stop), (j, b_stop)))
            codes = np.empty(a.stop - a.start + b.stop - b.start, np.int64)
            codes[np.arange(a.stop - a.start) + np.repeat(np.cumsum(b_sizes) - b_sizes, a_sizes)] = self.a[a].astype(np.int64) * 3 + a_last[a]
            codes[np.arange(b.stop - b.start) + np.repeat(np.cumsum(a_sizes), b_sizes)] = 3 * (self.tables.n_a + self.b[b].astype(np.int64)) + b_last[b]
            letters = self.tables.shown[codes].ravel()
            out.append(letters[letters != 0].tobytes())
            i, j = a.stop, b.stop
        return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype("<i4").tobytes()), pa.py_buffer(b"".join(out)))


def counts_lookup(pairs: np.ndarray, counts: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Counts of keys that are all in ``pairs`` (sorted): by a table of hashes, and a search for those that clash in it."""
    bits = max(10, len(pairs).bit_length() + 2)

    def slot(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)

    table = np.zeros(1 << bits, np.int32)
    table[slot(pairs)] = np.arange(len(pairs))

    def find(keys: np.ndarray) -> np.ndarray:
        at = table[slot(keys)]
        wrong = np.flatnonzero(pairs[at] != keys)
        at[wrong] = np.searchsorted(pairs, keys[wrong])
        return counts[at]

    return find


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(counts[order], starts) if len(starts) else counts


def _packed(values: np.ndarray) -> bytes:
    """Long values, byte columns apart: the upper ones are all alike and compress away."""
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpacked(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(8, -1).T).view("<i8").ravel()


def encode(docs: DataFrame, files: tuple[bytes, bytes]) -> DataFrame:
    """Rows of ``ENCODED`` from (doc_id, text), each of some texts: their ids and the id pairs that their links hold.

    A chunk's number is that of its task and its place there, so a table of them must be stored before two uses.
    """
    shared = docs.sparkSession.sparkContext.broadcast(files)  # the vocabularies

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, chunk = Pair(*shared.value), TaskContext.get().partitionId() << 32
        tables = Tables(**pair.tables())
        ids, found, size = [], [], 0

        def row() -> pa.RecordBatch:
            raw = [b"".join([x[k] for x in found]) for k in (0, 1)]
            sizes = [np.array([len(x[k]) // 2 for x in found], np.int32) for k in (0, 1)]
            pairs, counts = Chunk(tables, *[np.frombuffer(r, "<u2") for r in raw], *sizes).pair_counts()
            columns = [pa.array([chunk], pa.int64()), pa.array([ids], pa.list_(pa.int64())), *[pa.array([n], pa.list_(pa.int32())) for n in sizes],
                       *[pa.array([zstandard.ZstdCompressor(3).compress(r)], pa.binary()) for r in raw],
                       pa.array([_packed(np.diff(pairs, prepend=0))], pa.binary()), pa.array([_packed(counts)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["chunk", "doc_ids", "n_a", "n_b", "a", "b", "pairs", "counts"])

        for batch in batches:
            for start in range(0, len(batch), 64):  # a few texts at a time
                part = batch.slice(start, 64)
                texts = part.column("text").to_pylist()
                ids += part.column("doc_id").to_pylist()
                found += [pair.encode(t) for t in texts]
                size += sum(map(len, texts))
                if size >= CHUNK_BYTES:
                    yield row()
                    chunk, ids, found, size = chunk + 1, [], [], 0
        if ids:
            yield row()

    return docs.select("doc_id", "text").mapInArrow(run, ENCODED)


def _pairs(encoded: DataFrame) -> DataFrame:
    """(pair, n) over all texts; a pair is A's id times B's size plus B's id."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for pairs, counts in zip(batch.column("pairs"), batch.column("counts")):
                held.append((np.cumsum(_unpacked(pairs.as_py())), _unpacked(counts.as_py())))
                size += len(held[-1][0])
                if size > COUNTED_PAIRS:
                    held = [_summed(held)]
                    size = len(held[0][0])
                    if size > COUNTED_PAIRS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in held.pop()], ["pair", "n"])
                        size = 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _summed(held)], ["pair", "n"])

    return encoded.select("pairs", "counts").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def pair_counts(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, n): ids of A and B and how many links of the corpus hold them."""
    files = read_vocabularies(a_path, b_path)
    n_b = len(Pair(*files).b_bytes)
    return _pairs(encode(id_text(docs, id_col, text_col), files)).select(
        F.floor(F.col("pair") / n_b).cast("int").alias("a"), (F.col("pair") % n_b).cast("int").alias("b"), "n")


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row of ``ALIGNED`` for each document row: tokens, groups and links, with the links' corpus counts."""
    spark = docs.sparkSession
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = read_vocabularies(a_path, b_path)
    encoded = Stored(encode(id_text(docs, id_col, text_col), files), "encoded").df
    counted = Stored(_pairs(encoded), "pairs").df
    tables = Pair(*files).tables()
    n_b = len(tables["b_length"])
    best = np.zeros(n_b, np.int64)
    for row in counted.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("n")).collect():  # B's vocabulary at most
        best[row["b"]] = row["n"]
    shared = spark.sparkContext.broadcast((tables, best))  # as long as the vocabularies
    parts = max(shuffle, -(-counted.count() // RANGE_PAIRS))
    copies = max(1, -(-encoded.count() // (RANGE_CHUNKS * parts)))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, packed in zip(batch.column("chunk").to_pylist(), batch.column("pairs")):
                pairs = np.cumsum(_unpacked(packed.as_py()))
                part = pairs % parts
                held = np.unique(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held, pa.int32()), pa.array(np.full(len(held), chunk % copies), pa.int32()), pa.array(np.full(len(held), chunk), pa.int64()),
                     pa.array([_packed(np.diff(pairs[part == p], prepend=0)) for p in held], pa.binary())], ["part", "copy", "chunk", "pairs"])

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        pairs, counts = known.column("pair").to_numpy(), known.column("n").to_numpy()
        order = np.argsort(pairs)
        pairs, counts = pairs[order], counts[order]
        found = [counts[np.searchsorted(pairs, np.cumsum(_unpacked(x.as_py())))] for x in asked.column("pairs")]
        return pa.table({"chunk": asked.column("chunk"), "part": asked.column("part"), "found": pa.array([_packed(x) for x in found], pa.binary())})

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        tables_, best_ = shared.value
        row = {c: table.column(c)[0] for c in table.column_names}
        a, b = (np.frombuffer(zstandard.decompress(row[c].as_py()), "<u2") for c in ("a", "b"))
        chunk = Chunk(Tables(**tables_), a, b, row["n_a"].values.to_numpy(), row["n_b"].values.to_numpy())
        pairs = np.cumsum(_unpacked(row["pairs"].as_py()))
        counts, part = np.zeros(len(pairs), np.int64), pairs % parts
        for p, packed in zip(answers.column("part").to_pylist(), answers.column("found")):
            counts[part == p] = _unpacked(packed.as_py())
        return chunk.aligned(counts_lookup(pairs, counts) if len(pairs) else np.zeros_like, best_, row["doc_ids"].values)

    asked = encoded.select("chunk", "pairs").mapInArrow(ask, "part int, copy int, chunk long, pairs binary")
    known = counted.select((F.col("pair") % parts).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"), "pair", "n")
    answers = asked.groupBy("part", "copy").cogroup(known.groupBy("part", "copy")).applyInArrow(answer, "chunk long, part int, found binary")
    return encoded.drop("counts").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish, ALIGNED)
