"""Suffix-array dedup: remove text that an earlier document holds already.

Texts are UTF-8 bytes. A byte goes if a string of ``length`` bytes covers it that also starts in a
document with a smaller id. Every such string holds exactly one anchor, the place within it whose
``GRAM`` bytes have the smallest hash, and equal strings hold it at equal offsets; so the
suffixes that start at anchors (about one for each fifteen bytes) decide for all others.

1. Chunks of documents ask in how many documents each anchor's gram occurs (``exchange``). Suffixes whose
   gram no other document has drop out; no string on them repeats.
2. The remaining suffixes, with the bytes before the anchor that their strings reach, are
   range-partitioned by their leading bytes at sampled splitters. Equal contexts of a chunk travel
   once, with the smallest id of the chunk. A bucket is sorted by multikey quicksort on words of eight
   bytes; common prefixes of neighbours in suffix order, and the same on the reversed bytes before the
   anchor, give for each offset the groups of equal strings and the smallest id of each group.
   The splitters compare ``LEADING`` bytes, fewer than a gram, so equal strings never lie on both
   sides of a boundary. A gram that occurs in ``HOT`` documents or more could still overfill its bucket;
   its strings are sent one by one, equal ones of a chunk once, and meet by the hash of all their
   bytes, which splits the group.
3. The answer, a bit for each string, goes back to the chunk, which merges the covered bytes.

Defined results: null text: empty; texts under ``length`` bytes keep all; rows of equal id never remove
each other's bytes; repeated rows get equal results; a null id counts as smaller than any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, size_in_bytes
from .exchange import ANSWER, ASK, CHUNK_BYTES, RANGE_HASHES, answer_by_count, ask, chunk_count, read_answers, with_chunk

LENGTH, GRAM, LEADING = 50, 20, 16
HOT = 1024  # documents with one gram
SEGMENT = 1 << 16  # strings looked at together, so that what is computed on them stays in the cache
SAMPLE_BYTES, SAMPLE_SUFFIXES = 16 << 20, 50_000
BUCKET_BYTES = 4 << 20  # text for a bucket of suffixes
SMALL_SORT = 8192
NO_ID = np.iinfo(np.int64).min
SUFFIXES = "part int, chunk int, n_contexts int, contexts binary, n_strings int, strings binary"


def mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes at each place, by doubling the width."""
    with np.errstate(over="ignore"):
        wide, width, factor, out, at = data.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15, None, 0
        n = len(data) - size + 1
        for bit in range(size.bit_length()):
            if size >> bit & 1:
                piece = wide[at:at + n]
                out = piece if out is None else out * np.uint64(factor) + piece
                at += width
            if size >> (bit + 1):
                wide = wide[:len(wide) - width] * np.uint64(factor) + wide[width:]
                factor, width = factor * factor & 0xFFFFFFFFFFFFFFFF, 2 * width
    return mix(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, covered = values, 1
    while 2 * covered <= width:
        out = np.minimum(out[:len(out) - covered], out[covered:])
        covered *= 2
    n = len(values) - width + 1
    return np.minimum(out[:n], out[width - covered:width - covered + n])


class Chunk:
    """The documents of a chunk, by ascending id, as one run of bytes, and their anchors."""

    def __init__(self, table: pa.Table, length: int, gram: int):
        ids = table.column("doc_id").to_pylist()
        texts = [t.encode("utf-8", "surrogatepass") for t in table.column("text").to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, texts[i]))
        self.ids, self.texts = [ids[i] for i in order], [texts[i] for i in order]
        self.length, self.gram, self.before = length, gram, length - gram
        self.data = np.frombuffer(b"".join(self.texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in self.texts])
        self.id_of = np.array([NO_ID if i is None else i for i in self.ids], np.int64)
        self.at, self.first, self.last, self.hash, self.doc = self._anchors()
        # distinct grams in ascending order, and where each anchor's gram is among them
        self.by_hash = np.argsort(self.hash, kind="stable")
        in_order = self.hash[self.by_hash]
        self.new_gram = np.ones(len(in_order), bool)
        self.new_gram[1:] = in_order[1:] != in_order[:-1]
        self.grams = in_order[self.new_gram]

    def _anchors(self) -> tuple:
        """Anchors of all strings, each with the first and last string it stands for, its gram's hash and document."""
        starts = np.concatenate([[0], self.ends[:-1]]) if len(self.ends) else self.ends
        places, firsts, lasts, hashes = [], [], [], []
        for start in range(0, max(0, len(self.data) - self.length + 1), SEGMENT):
            data = self.data[start:start + SEGMENT + self.length - 1]
            grams = gram_hashes(data, self.gram)
            ranked = (grams >> np.uint64(24) << np.uint64(24)) | np.arange(len(grams), dtype=np.uint64)
            least = sliding_min(ranked, self.before + 1)
            new = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
            place = (least[new] & np.uint64((1 << 24) - 1)).astype(np.int64)
            places.append(place + start)
            firsts.append(new + start)
            lasts.append(np.append(new[1:], len(least)) - 1 + start)
            hashes.append(mix(grams[place] ^ np.uint64(0x9E3779B97F4A7C15)))  # the smallest are not spread evenly
        if not places:
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        at, first, last, gram = (np.concatenate(x) for x in (places, firsts, lasts, hashes))
        doc = np.searchsorted(self.ends, at, side="right")
        first, last = np.maximum(first, starts[doc]), np.minimum(last, self.ends[doc] - self.length)
        inside = np.flatnonzero(first <= last)  # no string lies across two documents
        return at[inside], first[inside], last[inside], gram[inside], doc[inside]

    def ask_grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct grams of the chunk and the number of its documents that hold each."""
        if not len(self.grams):
            return self.grams, np.zeros(0, np.int64)
        doc = self.doc[self.by_hash]  # ascending within a gram: the sort is stable
        other = self.new_gram.copy()
        other[1:] |= doc[1:] != doc[:-1]
        return self.grams, np.add.reduceat(other, np.flatnonzero(self.new_gram), dtype=np.int64)

    def repeating(self, answers: np.ndarray) -> tuple:
        """Distinct contexts and hot strings of the suffixes whose gram other documents hold."""
        byte = np.zeros(len(self.hash), np.uint8)
        byte[self.by_hash] = answers[np.cumsum(self.new_gram) - 1] if len(self.grams) else 0
        cool, hot = np.flatnonzero(byte == 1), np.flatnonzero(byte == 2)
        padded = np.concatenate([np.zeros(self.before, np.uint8), self.data, np.zeros(self.length, np.uint8)])
        # columns: the bytes from anchor - before to anchor + length, zero where no string of the anchor reaches
        columns = np.arange(self.before + self.length)
        low, high = self.first[cool] - self.at[cool] + self.before, self.last[cool] - self.at[cool] + self.before
        rows = sliding_window_view(padded, len(columns))[self.at[cool]]
        rows[(columns < low[:, None]) | (columns >= high[:, None] + self.length)] = 0
        rows = np.concatenate([rows, low[:, None].astype(np.uint8), high[:, None].astype(np.uint8)], axis=1)
        starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(self.first[hot].tolist(), self.last[hot].tolist())]) if len(hot) else np.zeros(0, np.int64)
        owner = np.repeat(hot, self.last[hot] - self.first[hot] + 1)
        return (cool, distinct_rows(rows, self.id_of[self.doc[cool]])), (starts, owner, distinct_strings(self.data, starts, self.length, self.id_of[self.doc[owner]]))


def row_hashes(rows: np.ndarray) -> np.ndarray:
    width = -(-rows.shape[1] // 8) * 8
    words = np.zeros((len(rows), width), np.uint8)
    words[:, :rows.shape[1]] = rows
    out = np.zeros(len(rows), np.uint64)
    with np.errstate(over="ignore"):
        for word in words.view("<u8").T:
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + word)
    return out


def distinct_rows(rows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct rows, the smallest id of each, the number of each row's distinct row)."""
    if not len(rows):
        return rows, ids, np.zeros(0, np.int64)
    _, first, inverse = np.unique(row_hashes(rows), return_index=True, return_inverse=True)
    if not np.array_equal(rows[first][inverse], rows):  # equal hashes of different rows
        _, first, inverse = np.unique(rows, axis=0, return_index=True, return_inverse=True)
        inverse = inverse.ravel()
    least = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(least, inverse, ids)
    return rows[first], least, inverse


def distinct_strings(data: np.ndarray, starts: np.ndarray, length: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``distinct_rows`` for the strings that start at some places: only distinct ones are gathered, by their hashes;
    the others are compared with them in segments."""
    if not len(starts):
        return np.zeros((0, length), np.uint8), ids, starts
    windows = sliding_window_view(data, length)
    _, first, inverse = np.unique(gram_hashes(data, length)[starts], return_index=True, return_inverse=True)
    rows = windows[starts[first]]
    segments = (slice(i, i + SEGMENT) for i in range(0, len(starts), SEGMENT))
    if not all(np.array_equal(windows[starts[s]], rows[inverse[s]]) for s in segments):  # equal hashes of different strings
        return distinct_rows(windows[starts], ids)
    least = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(least, inverse, ids)
    return rows, least, inverse


def words_of(columns: np.ndarray) -> np.ndarray:
    """Rows of bytes as big-endian words of eight, zero-padded."""
    padded = np.zeros((len(columns), -(-columns.shape[1] // 8) * 8), np.uint8)
    padded[:, :columns.shape[1]] = columns
    return padded.view(">u8").astype(np.uint64)


def multikey_quicksort(words: np.ndarray) -> np.ndarray:
    """Order of the rows: three-way partition on one word at a time, the equal part on the next word."""
    out, todo = [], [(np.arange(len(words)), 0)]
    while todo:
        rows, depth = todo.pop()
        if depth == words.shape[1] or len(rows) < 2:
            out.append(rows)
        elif len(rows) <= SMALL_SORT:
            out.append(rows[np.lexsort(words[rows, depth:].T[::-1])])
        else:
            word = words[rows, depth]
            pivot = np.sort(word[::max(1, len(word) // 31)])[len(word[::max(1, len(word) // 31)]) // 2]
            todo += [(rows[word > pivot], depth), (rows[word == pivot], depth + 1), (rows[word < pivot], depth)]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def common_prefixes(columns: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each row in suffix order shares with the one before (first: -1)."""
    same = columns[order[1:]] == columns[order[:-1]]
    shared = np.where(same.all(axis=1), columns.shape[1], same.argmin(axis=1))
    return np.concatenate([[-1], shared]) if len(order) else np.zeros(0, np.int64)


def earlier_strings(contexts: np.ndarray, ids: np.ndarray, length: int, gram: int) -> np.ndarray:
    """A bit for each string of each context: another context has the same string with a smaller id."""
    before = length - gram
    low, high = contexts[:, before + length], contexts[:, before + length + 1]
    after, back = contexts[:, before:before + length], contexts[:, :before][:, ::-1]
    order, back_order = multikey_quicksort(words_of(after)), multikey_quicksort(words_of(back))
    shared, back_shared = common_prefixes(after, order), common_prefixes(back, back_order)
    bits = np.zeros(len(contexts), np.uint64)
    group, back_group = np.empty(len(contexts), np.int64), np.empty(len(contexts), np.int64)
    for column in range(before + 1):  # strings that start ``before - column`` bytes before the anchor
        active = np.flatnonzero((low <= column) & (column <= high))
        if len(active) < 2:
            continue
        group[order] = np.cumsum(shared < gram + column)
        back_group[back_order] = np.cumsum(back_shared < before - column)
        key = group[active] * (len(contexts) + 1) + back_group[active]
        by_key = np.argsort(key, kind="stable")
        sorted_key = key[by_key]
        starts = np.flatnonzero(np.diff(sorted_key, prepend=-1))
        least = np.minimum.reduceat(ids[active][by_key], starts)
        sizes = np.diff(np.append(starts, len(by_key)))
        earlier = ids[active][by_key] > np.repeat(least, sizes)
        bits[active[by_key[earlier]]] |= np.uint64(1 << column)
    return bits


def _packed(rows: np.ndarray, ids: np.ndarray) -> bytes:
    return ids.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() + rows.tobytes()


def _unpacked(packed: bytes | pa.Buffer, n: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.ascontiguousarray(np.frombuffer(packed, np.uint8, 8 * n).reshape(8, n).T).view("<i8").ravel()
    return np.frombuffer(packed, np.uint8, offset=8 * n).reshape(n, -1) if n else np.zeros((0, 0), np.uint8), ids


def _parts_of_contexts(contexts: np.ndarray, before: int, splitters: np.ndarray) -> np.ndarray:
    leading = np.ascontiguousarray(contexts[:, before:before + LEADING]).view(f"S{LEADING}").ravel()
    return np.searchsorted(splitters, leading, side="right")


def sampled_splitters(docs: DataFrame, total_bytes: int, buckets: int, length: int, gram: int) -> list[bytes]:
    """Leading bytes that cut sampled suffixes into equal buckets; sample and result are of bounded size."""
    if buckets < 2:
        return []
    share = max(1, total_bytes // SAMPLE_BYTES)
    keep = max(1, min(total_bytes, SAMPLE_BYTES) // (length - gram) * 2 // SAMPLE_SUFFIXES)
    picked = docs.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(share)) == 0)

    def leading(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for start in range(0, len(table), 256):
                chunk = Chunk(table.slice(start, 256), length, gram)
                at = chunk.at[chunk.hash % np.uint64(keep) == 0].tolist()
                yield pa.RecordBatch.from_arrays([pa.array([chunk.data[a:a + LEADING].tobytes() for a in at], pa.binary())], ["leading"])

    rows = sorted(bytes(r["leading"]) for r in picked.select("doc_id", "text").mapInArrow(leading, "leading binary").limit(4 * SAMPLE_SUFFIXES).collect())
    return [rows[len(rows) * i // buckets] for i in range(1, buckets)] if rows else []


def remove_earlier_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                           gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): removed runs of bytes (begin, end) and the bytes that stay, a row for each document row."""
    base = id_text(docs, id_col, text_col)
    total = size_in_bytes(base, "text")
    shuffle = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks, parts = chunk_count(total, CHUNK_BYTES), max(shuffle, total // (length - gram) * 2 // RANGE_HASHES)
    buckets = max(shuffle, -(-total // BUCKET_BYTES))
    splitters = np.array(sampled_splitters(base, total, buckets, length, gram), f"S{LEADING}")
    before = length - gram
    dealt = with_chunk(base, chunks)

    def ask_grams(table: pa.Table) -> pa.Table:
        return ask(table.column("chunk")[0].as_py(), *Chunk(table, length, gram).ask_grams(), parts)

    def occurrence(documents: np.ndarray, chunks_: np.ndarray) -> np.ndarray:
        return ((documents > 1).astype(np.uint8) + (documents >= HOT)).astype(np.uint8)

    known = (dealt.groupBy("chunk").applyInArrow(ask_grams, ASK)
             .groupBy("part").applyInArrow(answer_by_count(occurrence), ANSWER))

    def send_suffixes(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table):
            return pa.table({"part": pa.array([], pa.int32()), "chunk": pa.array([], pa.int32()), "n_contexts": pa.array([], pa.int32()),
                             "contexts": pa.array([], pa.binary()), "n_strings": pa.array([], pa.int32()), "strings": pa.array([], pa.binary())})
        chunk = Chunk(table, length, gram)
        (_, (contexts, ids, _)), (_, _, (strings, string_ids, _)) = chunk.repeating(read_answers(answers))
        context_part = _parts_of_contexts(contexts, before, splitters) if len(contexts) else np.zeros(0, np.int64)
        string_part = (row_hashes(strings) % np.uint64(buckets)).astype(np.int64)
        rows = []
        for part in np.union1d(context_part, string_part).tolist():
            c, s = np.flatnonzero(context_part == part), np.flatnonzero(string_part == part)
            rows.append((part, table.column("chunk")[0].as_py(), len(c), _packed(contexts[c], ids[c]), len(s), _packed(strings[s], string_ids[s])))
        columns = list(zip(*rows)) or [()] * 6
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.binary()]
        names = ["part", "chunk", "n_contexts", "contexts", "n_strings", "strings"]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})

    def compare(table: pa.Table) -> pa.Table:
        n_contexts, n_strings = (table.column(c).to_pylist() for c in ("n_contexts", "n_strings"))
        answers = [b""] * len(table)

        def joined(name: str, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
            pieces = [_unpacked(x.as_buffer(), n) for x, n in zip(table.column(name), sizes) if n]
            return np.concatenate([p[0] for p in pieces]), np.concatenate([p[1] for p in pieces])

        def add(sizes: list[int], values: np.ndarray) -> None:
            at = 0
            for i, n in enumerate(sizes):
                answers[i] += values[at:at + n].tobytes()
                at += n

        if any(n_contexts):
            add(n_contexts, earlier_strings(*joined("contexts", n_contexts), length, gram).astype("<u8"))
        if any(n_strings):
            every, ids = joined("strings", n_strings)
            order = multikey_quicksort(words_of(every))
            starts = np.flatnonzero(common_prefixes(every, order) < length)
            least = np.minimum.reduceat(ids[order], starts)
            earlier = np.zeros(len(ids), np.uint8)
            earlier[order] = ids[order] > np.repeat(least, np.diff(np.append(starts, len(order))))
            add(n_strings, earlier)
        return pa.table({"chunk": table.column("chunk"), "part": pa.array([-1 - p for p in table.column("part").to_pylist()], pa.int32()),
                         "answer": pa.array(answers, pa.binary())})

    suffixes = dealt.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(send_suffixes, SUFFIXES)
    compared = suffixes.groupBy("part").applyInArrow(compare, ANSWER)

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(table, length, gram)
        is_known = np.array(answers.column("part").to_pylist(), np.int64) >= 0
        (cool, (contexts, ids, inverse)), (starts, owner, (strings, string_ids, string_inverse)) = chunk.repeating(
            read_answers(answers.filter(pa.array(is_known))))
        bits, earlier = np.zeros(len(contexts), np.uint64), np.zeros(len(strings), np.uint8)
        context_part = _parts_of_contexts(contexts, before, splitters) if len(contexts) else np.zeros(0, np.int64)
        string_part = (row_hashes(strings) % np.uint64(buckets)).astype(np.int64)
        for row in answers.filter(pa.array(~is_known)).to_pylist():
            part = -1 - row["part"]
            c, s = np.flatnonzero(context_part == part), np.flatnonzero(string_part == part)
            bits[c] = np.frombuffer(row["answer"], "<u8", len(c))
            earlier[s] = np.frombuffer(row["answer"], np.uint8, len(s), 8 * len(c))
        covered_from = np.zeros(len(chunk.data) + 1, np.int32)
        if len(cool):
            own = chunk.id_of[chunk.doc[cool]] > ids[inverse]
            columns = np.arange(before + 1)
            low, high = contexts[inverse, before + length], contexts[inverse, before + length + 1]
            hit = (own[:, None] | (bits[inverse][:, None] >> columns.astype(np.uint64) & np.uint64(1)).astype(bool)) & (
                low[:, None] <= columns) & (columns <= high[:, None])
            record, column = np.nonzero(hit)
            covered_from[chunk.at[cool[record]] - before + column] = 1
        if len(starts):
            covered_from[starts[(chunk.id_of[chunk.doc[owner]] > string_ids[string_inverse]) | (earlier[string_inverse] == 1)]] = 1
        total_from = np.cumsum(covered_from)[:len(chunk.data)]
        covered = total_from - np.concatenate([np.zeros(length, np.int32), total_from])[:len(chunk.data)] > 0
        spans, kept = [], []
        for end, text in zip(chunk.ends.tolist(), chunk.texts):
            mark = covered[end - len(text):end]
            edges = np.diff(np.concatenate([[0], mark.astype(np.int8), [0]]))
            spans.append([{"begin": b, "end": e} for b, e in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist())])
            kept.append(chunk.data[end - len(text):end][~mark].tobytes())
        return pa.table({
            "doc_id": pa.array(chunk.ids, pa.int64()), "n_bytes": pa.array([len(t) for t in chunk.texts], pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), "kept": pa.array(kept, pa.binary())})

    return dealt.groupBy("chunk").cogroup(known.union(compared).groupBy("chunk")).applyInArrow(
        remove, "doc_id long, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary")
