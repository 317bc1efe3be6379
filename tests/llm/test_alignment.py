"""Tokenizer alignment against the two libraries and plain loops."""

from bisect import bisect_left
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from adtally.llm import alignment, queries
from tests.conftest import SF_SMALL
from tests.llm import plain
from tests.llm.test_contracts import documents

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "  a  b", "\n", "x\n\ny \n z", "word", "▁ is a space there", "a▁b", "<|endoftext|> </s> <0x41>", "ﬁ ½ é 中文 😀 \x00\x1f",
       "tab\tand\u00a0more\u2003white", "a" * 3000, "no end " * 400, "don't  we'll 'S", "\r\n"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(text, libraries):
    """[(id, bytes)] of both, or nothing."""
    a, b = libraries
    if not text:
        return [], []
    letters = {c: i for i, c in enumerate(alignment.byte_letters())}
    left = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    return (left, right) if raw == b"".join(x for _, x in left) == b"".join(x for _, x in right) else ([], [])


def spans(side):
    at, out = 0, []
    for i, raw in side:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain_alignment(rows, libraries):
    done = []
    for doc, text in rows:
        a, b = map(spans, tokens(text, libraries))
        links = []
        first = 0
        for i, begin, end in a:
            while first < len(b) and b[first][2] <= begin:
                first += 1
            j = first
            while j < len(b) and b[j][1] < end:
                links.append((i, b[j][0]))
                j += 1
        ends = sorted({x[2] for x in a} & {x[2] for x in b})
        sides = [[[] for _ in ends] for _ in (a, b)]
        for side, held in zip((a, b), sides):
            for i, _, end in side:
                held[bisect_left(ends, end)].append(str(i))
        groups = ["|".join(map(",".join, both)) for both in zip(*sides)]
        done.append((doc, a, b, links, ";".join(groups), len(groups)))
    counts = Counter(link for row in done for link in row[3])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [(doc, len(a), len(b), n, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), shown)
            for doc, a, b, links, shown, n in done]


def test_op13_on_the_documents(spark, libraries):
    rows = sorted(map(tuple, queries.op13_tokenizer_alignment(spark, SF_SMALL).collect()))
    expected = plain_alignment(documents(SF_SMALL), libraries)
    assert rows == sorted((*row[:-1], plain.sha(row[-1]) if row[1] else "") for row in expected)


def test_odd_texts_extra_columns_repeated_and_null_ids(spark, libraries):
    rows = list(enumerate(ODD)) + [(3, "x\n\ny"), (3, "x\n\ny"), (None, "word"), (None, None)]
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, chunk string, part int").repartition(3)
    found = [tuple(r) for r in alignment.align(docs, A, B).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(found, key=key) == sorted(plain_alignment(rows, libraries), key=key)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(docs, A, B).collect() == [] and alignment.pair_counts(docs, A, B).collect() == []


def test_small_pieces_chunks_and_ranges_change_nothing(spark, libraries, monkeypatch):
    rows = [(i, t) for i, t in enumerate([*ODD, *[t for _, t in documents(SF_SMALL)[:20]]])]
    for name, value in {"PIECE_ENDS": 7, "CHUNK_BYTES": 500, "COUNTED_PAIRS": 50, "RANGE_PAIRS": 100, "RANGE_CHUNKS": 1}.items():
        monkeypatch.setattr(alignment, name, value)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    pair = alignment.Pair(*alignment.read_vocabularies(A, B))
    ids = [pair.encode(t) for _, t in rows]
    chunk = alignment.Chunk(alignment.Tables(**pair.tables()), *[np.frombuffer(b"".join(x[k] for x in ids), "<u2") for k in (0, 1)],
                            *[np.array([len(x[k]) // 2 for x in ids]) for k in (0, 1)])
    assert len(list(chunk.pieces())) > 1000
    import pyarrow as pa
    pairs, counts = chunk.pair_counts()
    best = np.zeros(len(pair.b_bytes), np.int64)
    np.maximum.at(best, pairs % len(pair.b_bytes), counts)
    done = chunk.aligned(alignment.counts_lookup(pairs, counts), best, pa.array(range(len(rows))))
    expected = plain_alignment(rows, libraries)
    assert [tuple(r.values()) for r in done.to_pylist()] == expected
    assert sorted(map(tuple, alignment.align(docs, A, B).collect())) == expected


def test_crossings_split_the_merge_evenly():
    import random
    pick = random.Random(5)
    for _ in range(200):
        a, b = (np.array(sorted(pick.sample(range(1, 60), pick.randint(1, 30))), np.int64) for _ in range(2))
        step = pick.randint(1, 9)
        merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
        i, j = alignment.crossings(a, b, step)
        for x, y in zip(i.tolist(), j.tolist()):
            assert x == sum(side == 0 for _, side in merged[:x + y]) and (x + y) % step * (x + y - len(merged)) == 0


def test_pair_counts(spark, libraries):
    rows = documents(SF_SMALL)[:30]
    found = {(r.a, r.b): r.n for r in alignment.pair_counts(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect()}
    assert sum(found.values()) == sum(r[4] for r in plain_alignment(rows, libraries))


def test_the_library_is_asked_where_ids_are_no_ranks(libraries):
    files = alignment.read_vocabularies(A, B)
    pair = alignment.Pair(*files)
    slow = pair._a_library(files[0])
    assert all(slow(" " + t) == pair._a(" " + t) for t in ODD if t)
