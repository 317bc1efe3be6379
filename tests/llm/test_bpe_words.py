"""The words that a BPE worker remembers: numbered, bounded, kept for its next tasks."""

import random

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adtally.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


def odd_texts(n):
    rng = random.Random(5)
    pool = ["the ", "and", " this", "é", "中文", "<|endoftext|>", "🤦", "!!", "\x00", " ", "12"]
    return ["", None] + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 9))) + " w" * rng.randint(0, 1) + str(rng.randint(0, 400)) * rng.randint(0, 3)
                         + "".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 5))) for _ in range(n)]


def test_forgetting_changes_nothing_and_bounds_the_table():
    library, vocabulary = Tokenizer.from_file(PATH), bpe.Vocabulary.load(PATH)
    lexicon = bpe.Automaton.compile([(w, bpe.merged(w, vocabulary)) for w in (b"the", b"and", b"w")])
    texts, limit = odd_texts(1500), 20
    expected = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for cache_words, step in ((limit, 7), (10_000, 256), (0, 1)):
        encoder = bpe.Encoder(vocabulary, lexicon, cache_words)
        for at in range(0, len(texts), step):
            ids, decoded = encoder.encode_decode(texts[at:at + step])
            assert ids.to_pylist() == expected[at:at + step]
            assert decoded.to_pylist() == [library.decode(e, skip_special_tokens=False) for e in expected[at:at + step]]
            if cache_words == limit:
                assert len(encoder.known) <= 2 * limit + 3 + len(vocabulary.special) + sum(len(encoder.splitter.pieces(t)) for t in texts[at:at + step])
                assert len(encoder.known.ends) - 1 == len(encoder.known) and encoder.known.ends[-1] == len(encoder.known.ids)


def test_portions_cover_all_texts_and_are_bounded():
    rng = random.Random(6)
    for _ in range(200):
        texts = ["x" * rng.randint(0, 12) for _ in range(rng.randint(0, 20))]
        found = list(bpe.portions(texts, most=4, chars=15))
        assert [i for begin, end in found for i in range(begin, end)] == list(range(len(texts)))
        assert all(end - begin <= 4 and (end - begin == 1 or sum(map(len, texts[begin:end])) <= 15) for begin, end in found)


def test_a_worker_keeps_its_words_for_the_next_tasks():
    class Shared:
        value = (vars(bpe.Vocabulary.load(PATH)), bpe.Automaton.compile([]))

    first = bpe.kept_encoder("one run", Shared)
    first.encode("an odd wordling")
    assert bpe.kept_encoder("one run", Shared) is first and "wordling" in first.known
    other = bpe.kept_encoder("another run", Shared)
    assert other is not first and "wordling" not in other.known and len(bpe._KEPT) == 1
    bpe._KEPT.clear()


def test_many_tasks_of_few_workers_encode_as_the_library(spark):
    library, texts = Tokenizer.from_file(PATH), odd_texts(300)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for lexicon_words in (0, 50):
        found = bpe.encode_decode(docs.repartition(12, F.col("doc_id")), PATH, lexicon_words).collect()
        assert len(found) == len(texts)
        for r in found:
            ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
            assert (r.ids, r.decoded) == (ids, library.decode(ids, skip_special_tokens=False))
