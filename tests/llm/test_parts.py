"""Parts of the operators against plain computations, and their ways for hot groups and large inputs."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adtally.llm import bpe, chat_format, components, decontamination, exchange, ngram_join, suffix_dedup, token_counts, toxicity
from tests.llm import plain


@pytest.mark.parametrize("n", [1, 2, 33, 500])
def test_forward_backward_is_the_textbook_recursion(n):
    rng = np.random.default_rng(n)
    odds, starts, transitions = rng.normal(size=n) * 3, rng.random(n) < 0.1, rng.normal(size=(2, 2))
    starts[0] = True
    single, pairs = toxicity.forward_backward(odds, starts, transitions)
    expected, counted, step = np.zeros(n), np.zeros((2, 2)), np.exp(transitions)
    edges = [*np.flatnonzero(starts), n]
    for a, b in zip(edges, edges[1:]):
        emit = np.exp(np.stack([np.zeros(b - a), odds[a:b]], axis=1))
        forward, backward = [emit[0]], [np.ones(2)]
        for e in emit[1:]:
            forward.append(forward[-1] @ step * e)
        for e in emit[:0:-1]:
            backward.insert(0, step @ (e * backward[0]))
        for t in range(b - a):
            joint = forward[t] * backward[t]
            expected[a + t] = joint[1] / joint.sum()
            if t:
                both = forward[t - 1][:, None] * step * emit[t] * backward[t]
                counted += both / both.sum()
    assert np.allclose(single, expected) and np.allclose(pairs, counted)


def test_toxic_words_are_found_with_their_offsets(spark):
    rng = random.Random(1)
    clean = ["tree", "house", "river", "walks", "slowly", "over", "green", "fields", "today", "again"]
    rows = []
    for i in range(240):
        words = [rng.choice(clean) + rng.choice(["", "s", "ing"]) for _ in range(40)]
        if i % 3 == 0:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(["vexling", "grubnard"])
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    for r in toxicity.toxicity(docs.select("doc_id", "text"), docs.select("doc_id", "toxic")).collect():
        text, label = rows[r.doc_id][1:]
        assert (r.score >= 0.5) == bool(label)
        marked = {w for s in r.spans for w in text[s.begin:s.end].split()}
        assert marked == {w for w in text.split() if w in ("vexling", "grubnard")}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc<|>\\ims_endpt\n", max_size=12), max_size=6))
def test_escapes_are_reversible(texts):
    import re
    for text in texts:
        escaped = re.sub(r"<(\\*)\|", r"<\\\1|", text)
        assert "<|" not in escaped and re.sub(r"<\\(\\*)\|", r"<\1|", escaped) == text
    assert chat_format.START.startswith("<|")


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(min_size=20, max_size=20), max_size=60))
def test_multikey_quicksort_sorts(rows):
    data = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), 20)
    saved, suffix_dedup.SMALL_SORT = suffix_dedup.SMALL_SORT, 3
    try:
        order = suffix_dedup.multikey_quicksort(suffix_dedup.words_of(data))
    finally:
        suffix_dedup.SMALL_SORT = saved
    assert [rows[i] for i in order] == sorted(rows)


def _copies(n):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8)))
    line = " ".join(word() for _ in range(40))
    base = " ".join(word() for _ in range(120))
    rows = []
    for i in range(n):
        words = base.split()
        for _ in range(i % 12):
            words[rng.randrange(len(words))] = word()
        own = " ".join(word() for _ in range(60))
        rows.append((i * 7 % n, " ".join(words) if i % 3 else own + " " + line + " " + own[:80]))
    return rows


@pytest.mark.parametrize("hot, segment", [(2, 1 << 16), (6, 64), (1024, 64)])
def test_suffixes_of_hot_groups_and_short_segments(spark, monkeypatch, hot, segment):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 1500)
    rows = _copies(36)
    found = suffix_dedup.remove_earlier_strings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_bytes, sum(s.end - s.begin for s in r.spans), len(r.spans), plain.sha(bytes(r.kept)))
                  for r in found) == sorted(plain.remove_earlier(rows))


@pytest.mark.parametrize("short, block, percent", [(64, 1024, 80), (2, 8, 80), (2, 8, 90)])
def test_links_of_long_lists_and_blocks(spark, monkeypatch, short, block, percent):
    monkeypatch.setattr(ngram_join, "SHORT_LIST", short)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", block)
    monkeypatch.setattr(ngram_join, "FREQUENT", 4)
    monkeypatch.setattr(ngram_join, "VERY_FREQUENT", 16)
    rows = _copies(60)
    found = ngram_join.link_components(spark.createDataFrame(rows, "doc_id long, text string"), size=3, percent=percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == plain.jaccard_components(rows, 3, percent)


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2 ** 32), st.integers(1, 400), st.sampled_from([80, 90]))
def test_similar_sets_share_a_key(seed, n, percent):
    rng = np.random.default_rng(seed)
    universe = np.unique(ngram_join.mix(rng.integers(1, 1 << 60, 3 * n + 8).astype(np.uint64)))
    classes = dict(zip(universe.tolist(), rng.choice([1, 2, 6, 12], len(universe)).tolist()))
    a = rng.permutation(universe)[:n]
    changes = rng.integers(0, max(1, n * (100 - percent) // 100) + 1)
    others = np.setdiff1d(universe, a)
    b = np.concatenate([rng.permutation(a)[:n - changes], rng.permutation(others)[:rng.integers(0, changes + 1)]])
    if not len(b):
        return
    shared = len(np.intersect1d(a, b))
    if 100 * shared >= percent * (len(a) + len(b) - shared):
        keys = [set(ngram_join.prefix_keys(np.sort(s), np.array([classes[x] for x in np.sort(s).tolist()]), percent)) for s in (a, b)]
        assert keys[0] & keys[1] or set(a.tolist()) == set(b.tolist())


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(5)
    links = [(f"p{i:03}", f"p{i + 1:03}") for i in range(150)] + [("hub", f"s{i}") for i in range(60)] + [(f"r{i}", f"r{(i + 1) % 9}") for i in range(9)]
    links += [(f"q{rng.randrange(80)}", f"q{rng.randrange(80)}") for _ in range(60)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a string, b string")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert found == {k: v for k, v in plain.components(sorted(nodes), [x for x in links if x[0] != x[1]]).items()}


def test_packed_hashes_keep_their_order():
    hashes = np.sort(np.random.default_rng(0).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    assert np.array_equal(exchange.unpack(exchange.pack(hashes)), hashes >> np.uint64(16) << np.uint64(16))
    parts = exchange.part_of(hashes, 7)
    assert (np.diff(parts) >= 0).all() and parts.min() >= 0 and parts.max() < 7


def test_automaton_accepts_its_words_only_and_shares_suffixes():
    rng = random.Random(2)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))).encode() for _ in range(400)} | {"é".encode(), b"\xff\x00"}
    entries = [(w, tuple(range(len(w)))) + () for w in words]
    automaton = bpe.Automaton(bpe.Automaton.compile(entries))
    assert all(automaton.get(w) == ids for w, ids in entries)
    others = {"".join(rng.choice("abcd") for _ in range(rng.randint(0, 8))).encode() for _ in range(400)} - words
    assert all(automaton.get(w) is None for w in others)
    assert len(automaton.final) < sum(len(w) for w in words) / 3
    assert bpe.Automaton(bpe.Automaton.compile([])).get(b"a") is None


def test_encoder_is_the_library_on_odd_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, vocabulary = Tokenizer.from_file(path), bpe.Vocabulary.load(path)
    lexicon = bpe.Automaton.compile([(w, bpe.merged(w, vocabulary)) for w in (b"the", b"and", b"'s", b"!!", b"this")])
    encoder = bpe.Encoder(vocabulary, lexicon, cache_words=3)
    rng = random.Random(1)
    pool = ["the ", "And", "ΣΑΣ ", "İ", "é", "é", " ", " ", "\x1c", "\x85", "½", "²", "٣", "中文", "<|startoftext|>", "<|endoftext|>",
            "<|", "\n", "'s", "'LL", "🤦🏼‍♂️", "_", "12", "ª", "ﬁ", "ß", "​", "ǅ", "が", "が", "!!", "\x00", "�", "K", "Å", "thisthis"]
    for _ in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))
        ids = encoder.encode(text)
        assert ids == library.encode(text, add_special_tokens=False).ids, text
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_benchmark_in_blocks_is_the_benchmark_at_once(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 4, 13, 20])))) for i in range(12)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(20)) + " " + rng.choice(items)[1] + " " + rng.choice(items)[1]) for i in range(15)]
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    expected = plain.contamination(docs, items)
    for block_bytes in (1 << 20, 150):
        found = decontamination.contamination(frame, bench, block_bytes=block_bytes).collect()
        assert sorted((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in found) == sorted(expected)


def test_proximity_finds_rare_terms_near_each_other(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta"), (2, "beta x alpha"), (3, "alpha " + "x " * 20 + "beta"), (4, "alpha")], "doc_id long, text string")
    keyed = decontamination._keyed(docs, "doc_id", "text")
    terms = {b"alpha": 0, b"beta": 1}
    index = decontamination.build_index(keyed, terms)
    probes = decontamination.rare_places([(0, [b"alpha", b"beta"])], terms, decontamination.corpus_counts(keyed, terms), 13)
    assert {r.doc_id for r in decontamination.proximity(index, probes, slop=4).collect()} == {1, 2}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 5), max_size=12), st.sets(st.integers(0, 40), max_size=8), st.sampled_from(token_counts.RULES))
def test_allocation_rules(lengths, cuts, rule):
    total = sum(lengths)
    edges = sorted(c for c in cuts if c <= total)
    begins, ends = np.array(edges[::2][:len(edges) // 2], np.int64), np.array(edges[1::2], np.int64)
    counts, _ = token_counts.allocate(np.cumsum(np.array(lengths, np.int64)), begins, ends, rule)
    expected, at = np.zeros(len(begins) + 1), 0
    for n in lengths:
        owners = [next((j for j, (b, e) in enumerate(zip(begins, ends)) if b <= x < e), len(begins)) for x in range(at, at + n)]
        held = {o: owners.count(o) for o in owners}
        if rule == "share":
            for o, h in held.items():
                expected[o] += h / n
        elif rule == "start":
            expected[owners[0]] += 1
        else:
            expected[next(o for o in owners if held[o] == max(held.values()))] += 1
        at += n
    assert np.allclose(counts, expected)


def test_fields_and_span_tables(spark):
    ranks = token_counts.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rows = spark.createDataFrame([(1, "a title", "the body é text", None), (2, None, "", "x")], "doc_id long, title string, body string, note string")
    text, spans = token_counts.field_spans(["title", "body", "note"], " ")
    counted = token_counts.count_tokens(rows.select("doc_id", text.alias("text"), spans.alias("s")), ranks, public_tokenizers.PATTERN, spans_col="s").collect()
    one = {r.section: r.n_tokens for r in counted if r.doc_id == 1}
    assert set(one) - {None} == {0, 1, 2} and one[2] == 0 and one[0] == 2
    table = spark.createDataFrame([(1, 7, 0, 7)], "doc_id long, section long, begin long, end long")
    joined = token_counts.with_span_table(rows.select("doc_id", text.alias("text")), table)
    found = token_counts.count_tokens(joined, ranks, public_tokenizers.PATTERN, spans_col="spans").collect()
    assert sum(r.n_tokens for r in found if r.doc_id == 1) == sum(one.values())
    assert {r.section for r in found if r.doc_id == 2} == {None}
