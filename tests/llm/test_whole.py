"""The operators do the whole job: nothing at a text's end, no row and no link is left out."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from adtally.llm import bpe, decontamination, fingerprints, ngram_join, quality, queries, token_counts
from adtally.session import scratch_path
from tests.conftest import SF_SMALL
from tests.llm import plain


def test_few_words_reads_the_text_to_its_end():
    rng = random.Random(4)
    prose = ["".join(rng.choice("abcdefghijklmnop") for _ in range(8)) for _ in range(400)]
    at = list(quality.LABELLERS).index("few words")
    share = lambda words: quality.measures(" ".join(words))[1][at]
    clean = share(prose)
    for n in (1, 100, 399, 400, 401, 799):
        spam = (["buy", "now"] * n)[:n]
        stretches = [(prose + spam)[i:i + 400] for i in range(0, n, 400)] + [(prose + spam)[-400:]]
        assert abs(share(prose + spam) - (1 - sum(len(set(s)) for s in stretches) / 400 / len(stretches))) < 1e-9
        assert share(prose + spam) > clean or n == 1
    assert share(prose[:30]) == 0 and share(prose) == clean


def test_join_stage_tells_rows_of_one_id_apart(spark):
    rng = random.Random(6)
    a, b, c, d = (" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(40)) for _ in range(4))
    rows = [(1, a), (2, a), (2, b), (None, a), (None, c), (None, c + " end"), (3, d), (3, d + " end"), (4, b + " end")]
    kept = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    found = [(r.doc_id, r.text.removesuffix(" end")) for r in kept]
    assert sorted(found, key=str) == sorted([(1, a), (2, b), (None, c), (3, d)], key=str)


def test_linked_sets_of_frequent_tokens_share_a_key_at_half():
    # dealt into 64 blocks of either kind, the 171 shared tokens would lie one or two to a block
    def tokens(n, start, per_block):
        return [((i // per_block) % 64 + 64 * (start + i)) << 8 for i in range(n)]

    pairs, triples = tokens(64, 1, 1), tokens(107, 1000, 2)
    keys = []
    for own in (tokens(85, 2000, 1), tokens(85, 3000, 1)):
        s = np.sort(np.array(pairs + triples + own, np.uint64))
        keys.append(set(ngram_join.prefix_keys(s, np.where(np.isin(s, np.array(pairs, np.uint64)), 6, 12), 50)))
    assert keys[0] & keys[1]


def test_every_prefix_outlasts_its_misses():
    for percent in range(1, 101):
        for n in [*range(1, 400), 1000, 5000, 20_000]:
            smallest, largest = -(-percent * n // 100), n * 100 // percent
            for scale in range(smallest.bit_length() - 1, largest.bit_length()):
                assert n - 3 * ngram_join.block_count(scale, percent) > ngram_join.allowed_misses(n, percent)


def test_short_texts_are_found_in_long_ones(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    rows = []
    for i in range(40):
        words = [word() for _ in range(300)]
        # the short one stands before the long one that holds it, after one that it holds, and before one that shares three words with it
        rows += [(4 * i, " ".join(words[100:110])), (4 * i + 1, " ".join(words)), (4 * i + 2, " ".join(words[200:210])),
                 (4 * i + 3, " ".join(words[207:210] + [word() for _ in range(7)]))]
    done = fingerprints.successive_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    like = fingerprints.likeness(F.col("sketch"), F.col("next_sketch"))
    low = F.size(F.filter(F.col("sketch.hashes"), lambda x: x < fingerprints._limit(fingerprints.FRACTION))) > 0
    found = {r.doc_id: r for r in done.select("doc_id", low.alias("low"), F.col("sketch.whole").alias("whole"), like.alias("like")).collect()}
    assert 10 < sum(found[4 * i].low for i in range(40)) < 35
    for i in range(40):
        assert found[4 * i].whole and not found[4 * i + 1].whole
        # nothing of the short text under the threshold: the long one's sketch cannot say
        assert found[4 * i].like == (1 if found[4 * i].low else 0)
        assert found[4 * i + 2].like == 0


def exact_containment(a, b):
    x, y = ({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.split(), b.split()))
    return len(x & y) / min(len(x), len(y))


def test_likeness_follows_from_the_fingerprints_and_its_error_from_the_length(spark):
    """Edited and next texts of given lengths: estimates against exact containment, class by class."""
    rng = random.Random(12)
    rows, shared = [], {}
    for length in (20, 60, 200, 800, 3000):
        for i in range(40):
            words = [f"w{rng.randrange(10 ** 6)}" for _ in range(length)]
            keep = rng.choice([0, length // 4, length // 2, length])
            rows += [" ".join(words), " ".join(words[:keep] + [f"v{rng.randrange(10 ** 6)}" for _ in range(length - keep)])]
            shared[len(rows) - 2] = length
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    done = fingerprints.successive_fingerprints(frame).select(
        "doc_id", fingerprints.likeness(F.col("sketch"), F.col("next_sketch")).alias("like"),
        fingerprints.fingerprint(F.col("sketch")).alias("a"), fingerprints.fingerprint(F.col("next_sketch")).alias("b"))
    again = done.withColumn("again", fingerprints.likeness(fingerprints.read_fingerprint(F.col("a")), fingerprints.read_fingerprint(F.col("b")))).collect()
    worst = {}
    for r in again:
        assert r.like == r.again and (r.a != r.b or r.like == 1)
        if r.doc_id in shared:
            error = abs(r.like - exact_containment(rows[r.doc_id], rows[r.doc_id + 1]))
            worst[shared[r.doc_id]] = max(error, worst.get(shared[r.doc_id], 0))
    for length, error in worst.items():
        allowed = 0 if length <= fingerprints.WHOLE else 4 * (0.25 / (length * fingerprints.FRACTION)) ** 0.5
        assert error <= allowed + 1e-9, (length, error)


def test_sketches_unite(spark):
    texts = ["a b c d e f g", "x y z", " ".join(f"w{i}" for i in range(400)), " ".join(f"w{i}" for i in range(200, 900)), "same " * 500, ""]
    pairs = [(i, j, x, y) for i, x in enumerate(texts) for j, y in enumerate(texts)]
    frame = spark.createDataFrame(pairs, "i int, j int, x string, y string").select("*", fingerprints.sketch(F.col("x")).alias("a"), fingerprints.sketch(F.col("y")).alias("b"))
    for r in frame.select("*", fingerprints.united(F.col("a"), F.col("b")).alias("u")).collect():
        assert r.u.whole == (r.a.whole and r.b.whole) and r.u.hashes == sorted(set(r.u.hashes))
        assert set(r.u.hashes) <= set(r.a.hashes) | set(r.b.hashes)
        if r.i == r.j:
            assert r.u == r.a
    assert {r.i: r.a.whole for r in frame.select("i", "a").collect()} == {0: True, 1: True, 2: False, 3: False, 4: True, 5: True}


def test_contamination_names_items_near_a_document(spark):
    item = "rare1 the the the the the the the the the the the rare2"
    items = spark.createDataFrame([(1, item), (2, "absent " + "of " * 10 + "seldom scarce"), (3, "single"), (4, "the the")],
                                  "item_id long, text string")
    docs = [(1, item), (2, "rare2 x x rare1"), (3, "rare1 " + "x " * 20 + "rare2"), (4, "scarce x seldom of"), (None, "rare1 x rare2"),
            (6, None), (7, "a single one"), (8, "x the"), (9, "rare1 of the")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for block_bytes in (1 << 20, 40):
        found = decontamination.contamination(frame, items, block_bytes=block_bytes, slop=13).collect()
        assert {r.doc_id: r.near_ids for r in found} == {
            1: ["1", "4"], 2: ["1"], 3: [], 4: ["2"], None: ["1"], 6: [], 7: ["3"], 8: ["4"], 9: ["4"]}
        assert {r.doc_id: r.item_ids for r in found}[1] == ["1", "4"] and len(found) == len(docs)
    assert "near_ids" not in decontamination.contamination(frame, items).columns


def test_lexicon_is_never_empty_however_large_the_counts(spark):
    counts = spark.createDataFrame([("a", 5 << 20), ("b", 3 << 20), ("c", 2 << 20), ("d", 7), ("e", 7), ("f", 7)], "word string, n long")
    assert bpe.frequent_words(counts, 2) == ["a", "b"]
    assert bpe.frequent_words(counts.where("n = 7"), 2) == ["d", "e"]
    assert bpe.frequent_words(counts, 100) == ["a", "b", "c", "d", "e", "f"]


def test_long_words_are_merged_as_the_library_merges_them():
    import time

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    vocabulary, library = bpe.Vocabulary.load(path), Tokenizer.from_file(path)
    rng = random.Random(3)
    for length, letters in [(n, "abcdefghijklmnopqrstuvwxyz") for n in (63, 64, 65, 66, 200, 5000)] + [(500, "a"), (501, "ab"), (700, "é"), (3000, "thea")]:
        word = "".join(rng.choice(letters) for _ in range(length))
        assert list(bpe.merged(word.encode(), vocabulary)) == library.encode(word, add_special_tokens=False).ids
    word = "".join(rng.choice("etaoinshr") for _ in range(1 << 20))
    start = time.time()
    ids = bpe.merged(word.encode(), vocabulary)
    assert time.time() - start < 60 and "".join(vocabulary.tokens[i] for i in ids) == word + bpe.END
    assert list(ids) == library.encode(word, add_special_tokens=False).ids


def test_pipeline_stages_keep_columns_of_any_name(spark):
    names = ["_id", "_HASH", "kept", "gone_id", "Kept_Id", "text_hash", "node", "_d"]
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, *"abcdefgh"), (2, text + " more", *"ijklmnop"), (3, "other words entirely " * 5, *"qrstuvwx"), (None, text, *"abcdefgh")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    for stage in (corpus_pipeline.near_duplicate_stage, corpus_pipeline.decontamination_stage):
        kept = stage(spark, frame, SF_SMALL)
        assert kept.columns == frame.columns
        assert {r.doc_id for r in kept.collect()} == ({1, 3} if stage is corpus_pipeline.near_duplicate_stage else {1, 2, 3, None})
        assert {tuple(r) for r in kept.collect()} <= set(rows)


def test_spans_join_documents_of_any_column_names(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "c", "y")], "doc_id long, text string, _id string").withColumnRenamed("_id", "spans_of")
    spans = spark.createDataFrame([(1, 0, 0, 1)], "doc_id long, section long, begin long, end long")
    done = {r.doc_id: r for r in token_counts.with_span_table(docs, spans).collect()}
    assert done[1].spans_of == "x" and len(done[1].spans) == 1 and done[2].spans is None


def test_op1_null_ids_are_not_held_out_and_spans_are_returned(spark):
    folder = scratch_path(spark, "op1_null")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = docs.limit(1).withColumn("doc_id", F.lit(None).cast("long"))
    docs.unionByName(extra).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF_SMALL}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    rows = queries.op1_toxicity(spark, folder).collect()
    assert len(rows) == docs.count() + 1 and all(r.held_out is not None for r in rows)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert any(r.spans for r in rows)
    for r in rows:
        assert len(r.spans) == r.n_spans and all(0 <= s.begin < s.end <= len(texts[r.doc_id]) for s in r.spans if r.doc_id is not None)


def test_large_groups_of_copies_and_of_others_keep_every_link(spark, monkeypatch):
    """Groups cut by number and by bytes: near copies of one text, a chain of versions, and sets that share frequent tokens only."""
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 8)
    monkeypatch.setattr(ngram_join, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(ngram_join, "SHORT_LIST", 4)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(60)]
    copies = [base[:i] + [f"x{i}"] + base[i + 1:] for i in range(60)]
    chain, versions = list(base), []
    for i in range(60):
        chain = chain[:i] + [f"c{i}"] + chain[i + 1:]
        versions.append(list(chain))
    others = [rng.sample(base, 40) for _ in range(30)]
    rows = [(i, " ".join(words)) for i, words in enumerate(copies + versions + others)]
    rng.shuffle(rows)
    for percent in (80, 90):
        found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link_components(
            spark.createDataFrame(rows, "doc_id long, text string"), size=1, percent=percent).collect()}
        assert found == plain.jaccard_components(sorted(rows), 1, percent)


def test_rows_without_id_are_dealt_by_their_text(spark):
    from adtally.llm.exchange import with_chunk

    docs = spark.createDataFrame([(None, f"text {i}") for i in range(400)] + [(1, "a"), (1, "b")], "doc_id long, text string")
    chunks = with_chunk(docs, 16).where("doc_id IS NULL").groupBy("chunk").count().collect()
    assert len(chunks) == 16 and max(r["count"] for r in chunks) < 100
    assert with_chunk(docs, 16).where("doc_id = 1").select("chunk").distinct().count() == 1


def peak_mb(code):
    """Peak memory of a process that runs some code, above that of its imports."""
    import subprocess
    import sys
    head = "import resource, numpy as np, pyarrow as pa\nfrom adtally.llm import suffix_dedup, ngram_join\n"
    peak = "resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024"
    run = subprocess.run([sys.executable, "-c", f"{head}first = {peak}\n{code}\nprint({peak} - first)"], capture_output=True, text=True, check=True, timeout=200)
    return int(run.stdout.split()[-1])


def test_a_chunk_of_hot_strings_stays_small():
    assert peak_mb("""
rng = np.random.default_rng(1)
text = "".join(map(chr, rng.integers(97, 123, 2 << 20)))
chunk = suffix_dedup.Chunk(pa.table({"doc_id": pa.array([1], pa.int64()), "text": [text]}), 50, 20)
cool, hot = chunk.repeating(np.full(len(chunk.grams), 2, np.uint8))
assert len(hot[0]) == len(text) - 49
""") < 800


def test_a_block_of_long_near_copies_stays_small():
    assert peak_mb("""
base = np.arange(20_000, dtype=np.uint64) * 7919
rows = [(str(i), np.sort(np.append(np.delete(base, i), np.uint64(10 ** 12 + i))).tobytes()) for i in range(ngram_join.BLOCK_BYTES // 160_000)]
table = pa.table({"name": ["g"] * len(rows), "node": [r[0] for r in rows], "is_first": [i == 0 for i in range(len(rows))], "tokens": pa.array([r[1] for r in rows], pa.binary())})
assert sum(ngram_join._star(80)(table).column("linked").to_pylist()) == len(rows) - 1
assert ngram_join._verify(80)(table).num_rows == len(rows) - 1
""") < 400
