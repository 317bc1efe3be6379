"""The registered queries against plain versions, the public tokenizer libraries or held-out labels."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from adtally.llm import queries
from tests.compare import assert_same, duck_rows, spark_rows
from tests.conftest import SF_MID, SF_SMALL
from tests.llm import plain


def given(sf, sql):
    return duckdb.connect().execute(sql.format(**{t: f"'{sf}/{t}.parquet'" for t in ("documents", "labels", "benchmark")})).fetchall()


def documents(sf):
    return given(sf, "SELECT doc_id, text FROM {documents} ORDER BY doc_id")


def test_all_operators_and_the_pipeline_are_registered():
    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, duck, name):
    assert_same(spark_rows(queries.QUERIES[name](spark, SF_SMALL)), duck_rows(duck(SF_SMALL), queries.ORACLE[name]), name)


def test_op1_learns_without_the_held_out_rows_and_finds_toxic_documents(spark):
    labels = dict(given(SF_MID, "SELECT doc_id, toxic FROM {labels}"))
    rows = queries.op1_toxicity(spark, SF_MID).collect()
    assert len(rows) == len(documents(SF_MID)) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)
    assert sum(p for p, y in held if y) >= 0.9 * sum(y for _, y in held)


def test_op2_removes_what_smaller_documents_hold(spark):
    rows = queries.op2_suffix_array_dedup(spark, SF_SMALL).collect()
    assert sorted(tuple(r) for r in rows) == sorted(plain.remove_earlier(documents(SF_SMALL)))


def test_op4_agrees_with_labels_it_never_sees(spark):
    labels = dict(given(SF_MID, "SELECT doc_id, quality FROM {labels}"))
    kept = [(int(r.keep), labels[r.doc_id]) for r in queries.op4_quality_classifier(spark, SF_MID).collect() if r.doc_id in labels]
    assert sum(k == y for k, y in kept) >= 0.98 * len(kept)
    assert all(k for k, y in kept if y)


def test_op5_components(spark):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op5_ngram_jaccard_join(spark, SF_SMALL).collect()}
    assert found == plain.jaccard_components(documents(SF_SMALL), 3, 90)


def test_op6_is_the_tokenizer_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    library, expected = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for doc, text in documents(SF_SMALL):
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((doc, len(ids), plain.sha(" ".join(map(str, ids))), plain.sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(tuple(r) for r in queries.op6_bpe_encoding(spark, SF_SMALL).collect()) == sorted(expected)


def test_op8_edits_and_likeness(spark):
    docs = [(d, t or "") for d, t in documents(SF_SMALL)]
    rows = {r.doc_id: r for r in queries.op8_document_fingerprints(spark, SF_SMALL).collect()}
    by_text = {}
    for i, (doc, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        n = len(text) // 4
        r = rows[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), plain.sha(text[:len(text) - n] + after[:n]))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        if text == after:
            assert r.near_next == 1
    long_rows = [rows[d] for d, t in docs if len(t) > 1000]
    assert sum(r.near_edited for r in long_rows) / len(long_rows) > 0.7
    assert sum(r.near_edited > r.near_next for r in long_rows) > 0.9 * len(long_rows)


def test_op9_counts_are_those_of_whole_texts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    rows = queries.op9_token_counts(spark, SF_SMALL).groupBy("doc_id").agg(
        F.sum("n_tokens").alias("n"), F.max("end").alias("end"), F.count("*").alias("lines")).collect()
    found = {r.doc_id: (r.n, r.end) for r in rows}
    assert found == {d: (len(library.encode(t or "", add_special_tokens=False).ids), len(t or "")) for d, t in documents(SF_SMALL)}


def test_pipeline_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    state = {}
    for name, stage in corpus_pipeline.STAGES:
        before, after = docs, stage(spark, docs, SF_SMALL)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.schema.simpleString() == before.schema.simpleString()
        docs = spark.createDataFrame(after.collect(), after.schema)
        state[name] = ([(r.doc_id, r.text) for r in before.collect()], docs.collect())
    quality = dict(given(SF_SMALL, "SELECT doc_id, quality FROM {labels}"))
    kept = {r.doc_id for r in state["quality classifier"][1]}
    assert all((d in kept) == bool(q) for d, q in quality.items())
    before, after = state["line dedup"]
    expected = [(d, t) for d, n, gone, t in plain.dedup_lines(before) if gone < n or not n]
    assert sorted((r.doc_id, r.text) for r in after) == sorted(expected)
    assert all(r.n_chars == len(r.text) for r in after)
    before, after = state["n-gram Jaccard join"]
    assert sorted(r.doc_id for r in after) == sorted(d for d, (_, c) in plain.jaccard_components(before, 5, 80).items() if d == c)
    before, after = state["benchmark decontamination"]
    spoilt = {d for d, n, hit, _ in plain.contamination(before, given(SF_SMALL, "SELECT item_id, text FROM {benchmark}")) if hit and 20 * hit >= n}
    assert sorted(r.doc_id for r in after) == sorted(d for d, _ in before if d not in spoilt)
    before, after = state["BPE encoding and decoding"]
    assert sorted(r.doc_id for r in after) == sorted(d for d, _ in before)
    assert all(r.n_tokens == len(r.ids) for r in after)
