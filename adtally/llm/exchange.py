"""Ask and answer between chunks of documents and ranges of hashes.

Some operators need, for every hash that a document holds, a little that depends on all documents
(how often it occurs, whether another document has it). Sending each hash as a row costs far more
than the hash. Here the documents are dealt into chunks; a chunk sends each range of hashes one
packed row of its distinct sorted hashes (the aggregation before the shuffle: what a third of the
documents share is sent once by each chunk), the range answers with one packed row of one
byte for each hash, and the chunk, dealt again by the same rule, reads its answers. Both sides
depend on the rows of a chunk alone, not on their order or on the task, so a lost executor's chunks
can be computed again.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 2 << 20  # text in a chunk, on average
RANGE_HASHES = 1 << 20  # hashes in a range, on average
ASK = "part int, chunk int, hashes binary, counts binary"
ANSWER = "chunk int, part int, answer binary"


def chunk_count(total_bytes: int, chunk_bytes: int = CHUNK_BYTES) -> int:
    return max(1, math.ceil(total_bytes / chunk_bytes))


def with_chunk(docs: DataFrame, chunks: int) -> DataFrame:
    """Deal rows into chunks by id, rows without id by their text."""
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    return docs.withColumn("chunk", F.pmod(key, F.lit(chunks)).cast("int"))


def pack(hashes: np.ndarray) -> bytes:
    """Upper 48 bits of sorted hashes, byte columns apart: the upper columns hardly change and compress well."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].T).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    columns = np.frombuffer(packed, np.uint8).reshape(6, -1)
    out = np.zeros((columns.shape[1], 8), np.uint8)
    out[:, 2:] = columns.T
    return out.view("<u8").ravel()


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Range of each hash: equal slices of the hash values, in ascending order."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def ask(chunk: int, hashes: np.ndarray, counts: np.ndarray, parts: int) -> pa.Table:
    """A row for each range, from a chunk's distinct sorted hashes and how many documents hold each."""
    ends = np.searchsorted(part_of(hashes, parts), np.arange(parts + 1))
    rows = [(p, a, b) for p, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())) if b > a]

    def packed_counts(a: int, b: int) -> bytes:
        more = np.flatnonzero(counts[a:b] > 1)
        return np.stack([more, counts[a:b][more]]).astype("<u4").tobytes()

    return pa.table({
        "part": pa.array([p for p, _, _ in rows], pa.int32()), "chunk": pa.array([chunk] * len(rows), pa.int32()),
        "hashes": pa.array([pack(hashes[a:b]) for _, a, b in rows], pa.binary()),
        "counts": pa.array([packed_counts(a, b) for _, a, b in rows], pa.binary())})


def answer_by_count(classify: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Callable[[pa.Table], pa.Table]:
    """For a range: ``classify(documents, chunks)`` gives a byte for each distinct hash, sent to all that asked."""
    def answer(asked: pa.Table) -> pa.Table:
        parts = [unpack(x) for x in asked.column("hashes").to_pylist()]
        counts = []
        for values, packed in zip(parts, asked.column("counts").to_pylist()):
            each = np.ones(len(values), np.int64)
            more = np.frombuffer(packed, "<u4").reshape(2, -1)
            each[more[0]] = more[1]
            counts.append(each)
        every = np.concatenate(parts)
        order = np.argsort(every, kind="stable")
        in_order = every[order]
        first = np.ones(len(every), bool)
        first[1:] = in_order[1:] != in_order[:-1]
        starts = np.flatnonzero(first)
        documents = np.add.reduceat(np.concatenate(counts)[order], starts)
        chunks = np.diff(np.append(starts, len(every)))
        byte = np.empty(len(every), np.uint8)
        byte[order] = np.repeat(classify(documents, chunks), chunks)
        ends = np.cumsum([len(x) for x in parts])
        return pa.table({
            "chunk": asked.column("chunk"), "part": asked.column("part"),
            "answer": pa.array([zlib.compress(byte[e - len(x):e].tobytes(), 1) for x, e in zip(parts, ends)], pa.binary())})

    return answer


def read_answers(answers: pa.Table) -> np.ndarray:
    """The bytes of a chunk's distinct sorted hashes."""
    rows = sorted(zip(answers.column("part").to_pylist(), answers.column("answer").to_pylist()))
    return np.frombuffer(b"".join(zlib.decompress(x) for _, x in rows), np.uint8)
