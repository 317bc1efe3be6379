"""BPE encoding and decoding with a minimal acyclic transducer for the frequent words.

The vocabulary file (a path) gives tokens, merges and special tokens. Texts are cut at special
tokens, normalised (NFC, white space runs to a space, lower case), cut into words, and each word is
spelt in bytes, the last with a word-end mark, and merged.

1. The words of the whole corpus are counted; the ``LEXICON_WORDS`` most frequent ones are encoded once (each task
   keeps that many at most, so the driver gets a bounded number).
2. They are compiled into a minimal automaton: equal suffixes share states. Every transition carries
   an output, and the outputs along a word's path sum up to its number, which leads to its ids.
3. The automaton has a fixed bound (words times letters); it is broadcast as one block of bytes, and
   every worker maps it into memory from an unnamed file.
4. Words that the automaton does not accept are merged exactly, by the lowest rank first, leftmost first; long ones
   with a heap, in n log n steps.

A worker also keeps the words it met, of the rare ones the last ``CACHE_WORDS`` to twice as many, for its later tasks as
well: each has a number, and its ids lie in a flat table, from which those of a few texts are gathered at once. Decoding joins
the tokens of the ids.

Defined results: null text: empty; an empty text has no ids and decodes to an empty text; rows with equal
id stay rows of their own.
"""

from __future__ import annotations

import gc
import json
import mmap
import re
import struct
import tempfile
import unicodedata
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, id_text

LEXICON_WORDS = 65_536
CACHE_WORDS = 150_000
SHORT_WORD = 64  # bytes, up to which a list is faster than a heap
END = "</w>"
_NO_MERGE = 1 << 62
_BYTES = [bytes([b]) for b in range(256)]
# fixed values: the vocabulary's white space and word pattern
_SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_SPACES = f"[{_SPACE}]+"
_WORD = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_SPACE}\p{{L}}\p{{N}}]+"
# the same for texts of ASCII and accented Latin letters only, in the faster module
_LATIN = "a-zß-öø-ÿ"
_PLAIN_TEXT = f"[\t-\r -~{_LATIN}À-ÖØ-Þ]*"
_PLAIN_WORD = f"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[0-9]|[^\t-\r {_LATIN}0-9]+"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and special tokens of one vocabulary file."""

    def __init__(self, special: dict, tokens: dict, inner: list, final: list, merges: dict):
        self.special, self.tokens, self.inner, self.final, self.merges = special, tokens, inner, final, merges

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters, merges = byte_letters(), {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            merges.setdefault(ids[a] << 32 | ids[b], rank << 32 | ids[a + b])
        return cls(special, {i: t for t, i in [*ids.items(), *special.items()]},
                   [ids[c] for c in letters], [ids[c + END] for c in letters], merges)


def merged(word: bytes, vocabulary: Vocabulary) -> tuple[int, ...]:
    """Ids of one word: merge the pair of lowest rank, leftmost first, until none is left."""
    if len(word) > SHORT_WORD:
        return _merged_long(word, vocabulary)
    inner, get = vocabulary.inner, vocabulary.merges.get
    symbols = [inner[b] for b in word]
    symbols[-1] = vocabulary.final[word[-1]]
    pairs = [get(a << 32 | b, _NO_MERGE) for a, b in zip(symbols, symbols[1:])]
    while pairs:
        best = min(pairs)
        if best == _NO_MERGE:
            break
        at = pairs.index(best)  # the leftmost
        new = symbols[at] = best & 0xFFFFFFFF
        del symbols[at + 1], pairs[at]
        if at < len(pairs):
            pairs[at] = get(new << 32 | symbols[at + 1], _NO_MERGE)
        if at:
            pairs[at - 1] = get(symbols[at - 1] << 32 | new, _NO_MERGE)
    return tuple(symbols)


def _merged_long(word: bytes, vocabulary: Vocabulary) -> tuple[int, ...]:
    """The same in n log n steps: linked symbols, and a heap of pairs by rank and place."""
    inner, get = vocabulary.inner, vocabulary.merges.get
    symbols = [inner[b] for b in word]
    symbols[-1] = vocabulary.final[word[-1]]
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(value, i) for i, value in enumerate(get(a << 32 | b) for a, b in zip(symbols, symbols[1:])) if value is not None]
    heapify(heap)
    while heap:
        value, i = heappop(heap)
        j = after[i]
        if symbols[i] < 0 or j == n or get(symbols[i] << 32 | symbols[j]) != value:
            continue  # one of the two was merged meanwhile
        symbols[i], symbols[j] = value & 0xFFFFFFFF, -1
        after[i] = following = after[j]
        if following < n:
            before[following] = i
            if (pair := get(symbols[i] << 32 | symbols[following])) is not None:
                heappush(heap, (pair, i))
        if (left := before[i]) >= 0 and (pair := get(symbols[left] << 32 | symbols[i])) is not None:
            heappush(heap, (pair, left))
    return tuple(x for x in symbols if x >= 0)


class Splitter:
    """Cut a text into words and special tokens."""

    def __init__(self, special: dict[str, int]):
        self.special = special
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.plain_text, self.plain_word = re.compile(_PLAIN_TEXT), re.compile(_PLAIN_WORD)
        self.spaces, self.word = re.compile(_SPACES), regex.compile(_WORD)

    def _words(self, text: str) -> list[str]:
        if self.plain_text.fullmatch(text):  # composed already; white space only separates words
            return self.plain_word.findall(text.lower())
        text = self.spaces.sub(" ", unicodedata.normalize("NFC", text))
        return self.word.findall(text.replace("Σ", "σ").lower())  # letter by letter, also at the end of a word

    def pieces(self, text: str | None) -> list[str]:
        """Words, and special tokens as themselves, in order."""
        if not text:
            return []
        if self.cut is None or "<|" not in text:
            return self._words(text)
        out: list[str] = []
        for i, part in enumerate(self.cut.split(text)):
            out += [part] if i % 2 else self._words(part)
        return out


class Automaton:
    """Minimal acyclic automaton over sorted words, with outputs that number them, as flat arrays.

    Layout: header (states, transitions, words, ids); for each state the first transition and whether it is
    final; for each transition target and output; labels; for each word the end of its ids; ids.
    """

    @staticmethod
    def compile(entries: list[tuple[bytes, tuple[int, ...]]]) -> bytes:
        entries = sorted(entries)
        registered: dict[tuple, int] = {}
        states: list[tuple[bool, list[tuple[int, int]]]] = []  # final, [(label, state)]
        path: list[tuple[list, list[tuple[int, int]]]] = [([False], [])]  # states of the last word, not registered yet
        before = b""

        def register(depth: int) -> None:
            """Fold the path down to ``depth``: a state like a registered one is that one."""
            while len(path) > depth + 1:
                final, arcs = path.pop()
                key = (final[0], tuple(arcs))
                if key not in registered:
                    registered[key] = len(states)
                    states.append((final[0], arcs))
                path[-1][1].append((before[len(path) - 1], registered[key]))

        for word, _ in entries:
            shared = next((i for i, (a, b) in enumerate(zip(before, word)) if a != b), min(len(before), len(word)))
            register(shared)
            path += [([False], []) for _ in word[shared:]]
            path[-1][0][0] = True
            before = word
        register(0)
        states.append((path[0][0][0], path[0][1]))
        sizes = []  # words from a state on; targets come before their sources
        for final, arcs in states:
            sizes.append(final + sum(sizes[t] for _, t in arcs))
        first, targets, outputs, labels = [0], [], [], bytearray()
        for final, arcs in states:
            passed = int(final)
            for label, target in arcs:
                labels.append(label)
                targets.append(target)
                outputs.append(passed)
                passed += sizes[target]
            first.append(len(targets))
        ends = np.cumsum([0] + [len(ids) for _, ids in entries])
        flat = [i for _, ids in entries for i in ids]
        head = struct.pack("<4I", len(states), len(targets), len(entries), len(flat))
        words = [first, [int(f) for f, _ in states], targets, outputs, ends, flat]
        return head + b"".join(np.array(w, "<u4").tobytes() for w in words) + bytes(labels)

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as file:  # without a name: gone with the worker
            file.write(block)
            file.flush()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        states, arcs, words, ids = struct.unpack_from("<4I", self.map)
        view, at = memoryview(self.map), 16
        arrays = []
        for n in (states + 1, states, arcs, arcs, words + 1, ids):
            arrays.append(view[at:at + 4 * n].cast("I"))
            at += 4 * n
        self.first, self.final, self.targets, self.outputs, self.ends, self.ids = arrays
        self.labels, self.root = at, states - 1

    def get(self, word: bytes) -> tuple[int, ...] | None:
        """Ids of an accepted word."""
        state, number, labels, find = self.root, 0, self.labels, self.map.find
        first, outputs, targets = self.first, self.outputs, self.targets
        for byte in word:
            arc = find(_BYTES[byte], labels + first[state], labels + first[state + 1]) - labels
            if arc < 0:
                return None
            number += outputs[arc]
            state = targets[arc]
        if not self.final[state]:
            return None
        return tuple(self.ids[self.ends[number]:self.ends[number + 1]])


def word_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(word, n) over all texts; a task hands on its counts whenever it holds ``CACHE_WORDS`` words."""
    special = vocabulary.special

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, counts = Splitter(special), Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column("text"):
                counts.update(splitter.pieces(text.as_py()))
                if len(counts) >= 2 * CACHE_WORDS:
                    yield flush()
        yield flush()

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, limit: int) -> list[str]:
    """The ``limit`` most frequent words (all, if there are fewer); of equally frequent ones the first by their letters."""
    return [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(limit).select("word").collect()]


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, words: int = LEXICON_WORDS, text_col: str = "text") -> bytes:
    """Compiled automaton of the corpus's most frequent words."""
    counts = Stored(word_counts(docs.select(F.col(text_col).cast("string").alias("text")), vocabulary), "words")
    chosen = [w.encode("utf-8", "surrogatepass") for w in frequent_words(counts.df, words) if w not in vocabulary.special]
    counts.drop()
    return Automaton.compile([(w, merged(w, vocabulary)) for w in chosen])


class _Known(dict):
    """Numbers of words; one that is not there yet is looked up in the automaton, or else merged, and gets the next.

    The ids of word n lie at place n of a flat table. Lexicon words stay. Of the others, the last ``limit`` to twice as many are
    remembered.
    """

    def __init__(self, vocabulary: Vocabulary, automaton: Automaton, limit: int):
        super().__init__()
        self.vocabulary, self.automaton, self.limit = vocabulary, automaton, limit
        self.rare: list[str] = []
        self.ids, self.ends = array("i"), array("i", [0])
        for word, i in vocabulary.special.items():
            self._add(word, (i,))

    def _add(self, word: str, ids: tuple[int, ...]) -> int:
        number = self[word] = len(self.ends) - 1
        self.ids.extend(ids)
        self.ends.append(len(self.ids))
        return number

    def __missing__(self, word: str) -> int:
        raw = word.encode("utf-8", "surrogatepass")
        ids = self.automaton.get(raw)
        if ids is None:
            ids = merged(raw, self.vocabulary)
            self.rare.append(word)
        return self._add(word, ids)

    def table(self) -> pa.ListArray:
        """Ids by number, as a view: no word can be added while it is held."""
        ids = pa.Array.from_buffers(pa.int32(), len(self.ids), [None, pa.py_buffer(self.ids)])
        return pa.Array.from_buffers(pa.list_(pa.int32()), len(self.ends) - 1, [None, pa.py_buffer(self.ends)], children=[ids])

    def forget(self) -> None:
        if len(self.rare) <= 2 * self.limit:
            return
        older = len(self.rare) - self.limit
        for word in self.rare[:older]:
            del self[word]
        del self.rare[:older]
        kept = self.table().take(pa.array(list(self.values()), pa.int32()))
        self.ids, self.ends = (array("i", a.to_numpy().tobytes()) for a in (kept.values, kept.offsets))
        for number, word in enumerate(self):
            self[word] = number


class Encoder:
    """Ids of texts, by lexicon, exact merges and a bounded memory of words."""

    def __init__(self, vocabulary: Vocabulary, block: bytes, cache_words: int = CACHE_WORDS):
        self.vocabulary, self.splitter, self.automaton = vocabulary, Splitter(vocabulary.special), Automaton(block)
        self.known = _Known(vocabulary, self.automaton, cache_words)
        self.tokens = pa.array([vocabulary.tokens.get(i) for i in range(max(vocabulary.tokens) + 1)], pa.string())

    def encode_decode(self, texts: list[str | None]) -> tuple[pa.ListArray, pa.StringArray]:
        """The ids of each text, and the text that they decode to."""
        self.known.forget()
        number, numbers, ends = self.known.__getitem__, array("i"), [0]
        for text in texts:
            numbers.extend(map(number, self.splitter.pieces(text)))
            ends.append(len(numbers))
        words = pa.Array.from_buffers(pa.int32(), len(numbers), [None, pa.py_buffer(numbers)])
        of_words = self.known.table().take(words)
        ids = pa.ListArray.from_arrays(of_words.offsets.take(pa.array(ends, pa.int32())), of_words.values)
        return ids, self.decoded(ids)

    def decoded(self, ids: pa.ListArray) -> pa.StringArray:
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self.tokens.take(ids.values)), " ")

    def encode(self, text: str | None) -> list[int]:
        return self.encode_decode([text])[0][0].as_py()

    def decode(self, ids: list[int]) -> str:
        return self.decoded(pa.array([ids], pa.list_(pa.int32())))[0].as_py()


_KEPT: dict[str, Encoder] = {}


def kept_encoder(name: str, shared: Broadcast) -> Encoder:
    """The encoder of one run: a worker's next tasks go on with the words that it knows."""
    if name not in _KEPT:
        _KEPT.clear()
        parts, block = shared.value
        _KEPT[name] = Encoder(Vocabulary(**parts), block)
    return _KEPT[name]


def portions(texts: list[str], most: int = 256, chars: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Begin and end of runs of texts: so many, and together not longer than ``chars`` if they are several."""
    begin = held = 0
    for i, text in enumerate(texts):
        if i > begin and (i - begin == most or held + len(text) > chars):
            yield begin, i
            begin, held = i, 0
        held += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def encode_decode(docs: DataFrame, vocabulary_path: str, lexicon_words: int = LEXICON_WORDS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of every whole text."""
    vocabulary = Vocabulary.load(vocabulary_path)
    # of fixed size: the vocabulary, and a lexicon of so many words
    shared = docs.sparkSession.sparkContext.broadcast((vars(vocabulary), build_lexicon(docs, vocabulary, lexicon_words, text_col)))

    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(name, shared)
        gc.collect()
        gc.freeze()  # the vocabulary stays as it is: later collections need not walk it
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for begin, end in portions(texts):  # a few texts at a time bound the memory
                ids, decoded = encoder.encode_decode(texts[begin:end])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(begin, end - begin), ids, decoded], ["doc_id", "ids", "decoded"])
        gc.unfreeze()  # the worker is used again

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")
