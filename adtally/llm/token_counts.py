"""Token counts by section: offset-mapped attribution.

A document is encoded once and as a whole, so no token is an artefact of cutting the text. Byte-level
tokens spell the text, so running sums of their lengths are their spans, and these are
joined with the spans of the sections (both ascending, by binary search). Sections are lines, each with
its newline, fields of a row (``field_spans``), or any given spans of code points, which may leave gaps
but must not overlap.

A token that lies across a boundary goes by an explicit rule:

* ``majority``: to the section with most of its bytes; of equal ones, to the first;
* ``start``: to the section of its first byte;
* ``share``: to each section in proportion to its bytes.

Bytes in a gap belong to section null. Whatever the rule, a document's counts sum up to its tokens.

Defined results: null text: empty; an empty text, or one without given sections, has one section (its
number 0, or null) without tokens or with all of them; rows of equal id stay rows of their own. Each
document is worked on by itself; nothing is shuffled unless spans are given as a table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

RULES = ("majority", "start", "share")
SPANS = "array<struct<section:long,begin:long,end:long>>"
COUNTS = "doc_id long, section long, begin long, end long, n_tokens double, n_crossing long"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def field_spans(columns: list[str], separator: str = "\n") -> tuple[Column, Column]:
    """(text, spans): the columns joined by a separator (null: empty), and a section for each column."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    at, spans = F.lit(0).cast("long"), []
    for i, field in enumerate(fields):
        end = at + F.length(field)
        spans.append(F.struct(F.lit(i).cast("long").alias("section"), at.alias("begin"), end.alias("end")))
        at = end + len(separator)
    return F.concat_ws(separator, *fields), F.array(*spans).cast(SPANS)


def line_starts(data: np.ndarray) -> np.ndarray:
    """First bytes of the lines; a newline belongs to the line that it ends."""
    after = np.flatnonzero(data == 10) + 1
    return np.concatenate([[0], after[after < len(data)]])


def allocate(token_ends: np.ndarray, begins: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of each section, crossing tokens that touch it); the last place is the gaps' account.

    Spans in bytes: tokens tile the text; sections [begin, end) ascend without overlap.
    """
    n = len(begins)
    counts, crossing = np.zeros(n + 1), np.zeros(n + 1, np.int64)
    if not len(token_ends):
        return counts, crossing
    token_begins = np.concatenate([[0], token_ends[:-1]])
    # pieces of the text: sections and the gaps between, so that every byte lies in one piece
    edges = np.unique(np.concatenate([[0], begins, ends, [token_ends[-1]]]))
    at = np.searchsorted(begins, edges[:-1], side="right") - 1
    owner = np.where((at >= 0) & (edges[:-1] < ends[np.maximum(at, 0)]), at, n) if n else np.full(len(edges) - 1, n)
    first = np.searchsorted(edges, token_begins, side="right") - 1
    last = np.searchsorted(edges, token_ends, side="left") - 1
    whole = first == last
    np.add.at(counts, owner[first[whole]], 1)
    for i in np.flatnonzero(~whole).tolist():
        pieces = np.arange(first[i], last[i] + 1)
        held = np.minimum(edges[pieces + 1], token_ends[i]) - np.maximum(edges[pieces], token_begins[i])
        owners, inverse = np.unique(owner[pieces], return_inverse=True)
        if len(owners) == 1:
            counts[owners[0]] += 1
            continue
        crossing[owners] += 1
        if rule == "share":
            np.add.at(counts, owner[pieces], held / held.sum())
        elif rule == "start":
            counts[owner[pieces[0]]] += 1
        else:
            total = np.bincount(inverse, held)
            best = [o for o, t in zip(owners.tolist(), total.tolist()) if t == total.max()]
            counts[next(o for o in owner[pieces].tolist() if o in best)] += 1
    return counts, crossing


def count_tokens(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 spans_col: str | None = None, rule: str = "majority") -> DataFrame:
    """(doc_id, section, begin, end, n_tokens, n_crossing): a row for each section; without ``spans_col``, for each line.

    The spans column is an array of (section, begin, end) in code points (see ``SPANS``).
    """
    if rule not in RULES:
        raise ValueError(f"rule {rule!r} is none of {RULES}")
    spans = F.col(spans_col).cast(SPANS) if spans_col else F.lit(None).cast(SPANS)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), spans.alias("spans"))
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary, of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tiktoken.Encoding("whole", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
        sizes = np.zeros(max(shared.value.values(), default=0) + 1, np.int64)
        for token, rank in shared.value.items():
            sizes[rank] = len(token)
        for batch in batches:
            for start in range(0, len(batch), 512):
                part = batch.slice(start, 512)
                columns: list[list] = [[] for _ in range(6)]
                for doc, text, given in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
                    text = text or ""
                    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                    token_ends = np.cumsum(sizes[np.array(encoding.encode_ordinary(text), np.int64)])
                    # code points that begin up to each byte, and the byte where each code point begins
                    lead = (data & 0xC0) != 0x80
                    point_at = np.append(np.flatnonzero(lead), len(data))
                    if spans_col is None:
                        begins = line_starts(data)
                        ends = np.append(begins[1:], len(data))
                        points = np.append(np.cumsum(lead) - 1, lead.sum())
                        numbers, shown = list(range(len(begins))), (points[begins], points[ends])
                    else:
                        given = sorted(given or [], key=lambda s: (s["begin"], s["end"]))
                        shown = [np.clip(np.array([s[k] for s in given], np.int64), 0, len(point_at) - 1) for k in ("begin", "end")]
                        begins, ends = point_at[shown[0]], point_at[shown[1]]
                        numbers = [s["section"] for s in given]
                    counts, crossing = allocate(token_ends, begins, ends, rule)
                    gap = int(counts[-1] > 0 or not numbers)
                    n = len(numbers) + gap
                    columns[0] += [doc] * n
                    columns[1] += numbers + [None] * gap
                    columns[2] += shown[0].tolist() + [None] * gap
                    columns[3] += shown[1].tolist() + [None] * gap
                    columns[4] += counts[:n].tolist()
                    columns[5] += crossing[:n].tolist()
                kinds = [pa.int64()] * 4 + [pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 ["doc_id", "section", "begin", "end", "n_tokens", "n_crossing"])

    return base.mapInArrow(run, COUNTS)


def with_span_table(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents with a column ``spans`` gathered from a table (id, section, begin, end); a document's spans meet in one row."""
    of = free_name(docs, "spans_of")
    gathered = spans.groupBy(F.col(id_col).alias(of)).agg(
        F.collect_list(F.struct("section", "begin", "end")).cast(SPANS).alias("spans"))
    return docs.join(gathered, F.col(id_col).eqNullSafe(F.col(of)), "left").drop(of)
