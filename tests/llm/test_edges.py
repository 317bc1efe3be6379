"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator and stage."""

import public_tokenizers
import pytest

import corpus_pipeline
from adtally.llm import (bpe, chat_format, decontamination, fingerprints, line_dedup, ngram_join, quality, suffix_dedup,
                         token_counts, toxicity)
from tests.llm import plain

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
SHARED = "one line that says something\nanother line that says more\nand a third line to close\n"
ROWS = [
    (1, SHARED + "first tail", "en"), (2, SHARED + "second tail", None), (3, None, "en"), (4, "", "en"), (5, LONG, "en"),
    (5, LONG, "en"), (6, LONG + " end", "en"), (None, SHARED + "of nobody", "en"), (7, "é ñ 漢字 🤦🏼‍♂️ \x00 \x1c", "xx"), (8, "word", "en"),
    (9, "word", "en"), (10, " \t\n ", "en"),
]
# names that the operators use inside
CLASHING = "text_hash long, bucket int, chunk int, starts string, next string, ids string, score double, node string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, lang, "src", 7, 1, 2, 3, "x", "y", "z", 0.5, "n") for d, t, lang in ROWS]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}").repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with odd benchmark items for the stages that read them."""
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, None), (2, ""), (3, "word"), (4, "word"), (4, "word"), (None, "of nobody")],
                          "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def ranks():
    return token_counts.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (2, 0), (4, None), (None, 1), (99, 1)], "doc_id long, toxic int")


def by_id(rows, *columns):
    return sorted(((r.doc_id is not None, r.doc_id or 0), *(r[c] for c in columns)) for r in rows)


OPERATORS = {
    "toxicity": lambda s, d: toxicity.toxicity(d, labels(s)),
    "suffixes": lambda s, d: suffix_dedup.remove_earlier_strings(d),
    "quality": lambda s, d: quality.quality(d),
    "links": lambda s, d: ngram_join.link_components(d),
    "bpe": lambda s, d: bpe.encode_decode(d, public_tokenizers.path("word_bpe_49k.json"), 100),
    "benchmark": lambda s, d: decontamination.contamination(d, s.createDataFrame([(1, "another LINE that says more and a third line to close"), (2, None)], "item_id long, text string")),
    "fingerprints": lambda s, d: fingerprints.successive_fingerprints(d, rows_per_range=2),
    "tokens": lambda s, d: token_counts.count_tokens(d, *ranks()),
    "lines": lambda s, d: line_dedup.dedup_lines(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, none, name):
    assert OPERATORS[name](spark, none).collect() == []


def test_row_for_row_operators_return_every_row(spark, docs):
    for name in ("toxicity", "quality", "links", "bpe", "benchmark", "fingerprints", "lines"):
        rows = OPERATORS[name](spark, docs).collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(d) for d, _, _ in ROWS), name


def test_suffixes_match_plain_version(spark, docs):
    rows = OPERATORS["suffixes"](spark, docs).collect()
    found = [(r.doc_id, r.n_bytes, sum(s.end - s.begin for s in r.spans), len(r.spans), plain.sha(bytes(r.kept))) for r in rows]
    key = lambda r: (str(r[0]), r[1:])
    assert sorted(found, key=key) == sorted(plain.remove_earlier([(d, t) for d, t, _ in ROWS]), key=key)


def test_links_of_odd_rows(spark, docs):
    found = {r.doc_id: r.component_id for r in OPERATORS["links"](spark, docs).collect()}
    assert found == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, None: None, 7: 7, 8: 8, 9: 8, 10: 10}


def test_lines_of_odd_rows(spark, docs):
    rows = OPERATORS["lines"](spark, docs).collect()
    kept = {(r.doc_id, r.n_lines, r.n_removed): r.kept_text for r in rows}
    # the null id sorts first, so the others lose the shared lines
    assert kept[(None, 4, 0)] == SHARED + "of nobody"
    assert kept[(1, 4, 3)] == "first tail" and kept[(2, 4, 3)] == "second tail"
    assert kept[(3, 0, 0)] is None and kept[(4, 1, 0)] == "" and kept[(5, 1, 0)] == LONG


def test_benchmark_of_odd_rows(spark, docs):
    rows = OPERATORS["benchmark"](spark, docs).collect()
    expected = plain.contamination([(d, t) for d, t, _ in ROWS], [(1, "another LINE that says more and a third line to close")])
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.item_ids) for r in rows) == sorted((str(d), *x) for d, *x in expected)
    assert sum(r.n_hit for r in rows) > 0


def test_fingerprints_of_odd_rows(spark, docs):
    rows = OPERATORS["fingerprints"](spark, docs).collect()
    order = sorted(((d is not None, d or 0), t or "") for d, t, _ in ROWS)
    edited = []
    for i, (key, text) in enumerate(order):
        n = len(text) // 4
        edited.append((key, text[:len(text) - n] + order[(i + 1) % len(order)][1][:n]))
    assert by_id(rows, "edited_text") == sorted(edited)
    assert all(r.sketch for r in rows)


def test_tokens_sum_up(spark, docs):
    rows = OPERATORS["tokens"](spark, docs).collect()
    assert {r.section for r in rows if r.doc_id == 4} == {0} and sum(r.n_tokens for r in rows if r.doc_id in (3, 4)) == 0
    assert all(r.begin <= r.end for r in rows)


def test_labels_of_one_kind_give_a_constant_score(spark, docs):
    only = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.toxicity(docs, only).collect()} == {1.0}


def test_chat_of_odd_rows(spark):
    rows = [(1, 0, None, None), (1, 0, "user", "a"), (1, 1, "user", "b<|im_sep|>\\|<\\|c"), (1, 1, "user", "b<|im_sep|>\\|<\\|c"),
            (None, None, "assistant", "x"), (None, 2, "assis\ntant<|nl|>", "y"), (2, 5, "assistant", "<\\\\|im_end|>" * 3),
            (2, 6, "assistant", "")]
    extra = spark.createDataFrame([(*r, "junk", 3) for r in rows], "conv_id long, turn long, role string, text string, formatted string, ts int")
    done = (chat_format.format_conversations(extra)
            .withColumn("turns", chat_format.read_back(chat_format.F.col("formatted")))
            .withColumn("loss", chat_format.masked_text(chat_format.F.col("formatted"), chat_format.F.col("loss_spans"))).collect())
    turns = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in done}
    assert turns[1] == [("", ""), ("user", "a"), ("user", rows[2][3]), ("user", rows[3][3])]
    assert turns[None] == [("assistant", "x"), ("assis\ntant<|nl|>", "y")]
    assert turns[2] == [("assistant", rows[6][3]), ("assistant", "")]
    assert {r.conv_id: r.loss for r in done} == {1: "", None: "x", 2: rows[6][3]}
    assert chat_format.format_conversations(extra.where("false")).collect() == []


@pytest.mark.parametrize("position", range(5))
def test_stages_take_odd_and_empty_tables(spark, docs, none, folder, position):
    name, stage = corpus_pipeline.STAGES[position]
    assert stage(spark, none, folder).collect() == []
    after = stage(spark, docs, folder)
    rows = after.collect()
    if position < 4:
        assert after.columns == docs.columns
    if position == 2:  # repeated rows and near copies stay once
        assert sorted(str(r.doc_id) for r in rows) == ["1", "10", "2", "3", "4", "5", "7", "8", "None"]
    if position == 3:  # "word" alone is an item
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(d) for d, t, _ in ROWS if t != "word" and d is not None)
