"""N-gram Jaccard join by token-combination prefixes.

A document's tokens are the hashes of its distinct word shingles. All documents order tokens
alike: by frequency class over the whole corpus, rarest first, then by hash. Two sets of Jaccard
similarity >= t miss at most tau = |x| - ceil(t |x|) of each other's tokens, so a prefix that
survives tau misses holds something shared. Rare tokens are indexed one by one. Tokens of the
frequent classes are dealt by hash into blocks; a block is indexed by its combinations of k = 2 or
k = 3 tokens, and as a block of b tokens stands for b - k + 1 misses only, the prefix is extended
until rare tokens and blocks together outlast tau misses; there are few enough blocks that it always does, for any
percent from 1 to 100 (at low ones frequent tokens are indexed one by one). Two similar sets then share a token or a
combination, since of the two prefixes the one that ends first lies within the other's reach.

Equal sets are joined first (one representative goes on). Index lists are then read in two ways:

* lists of up to ``SHORT_LIST`` sets give pairs; size and a parity bitmap (the bits that differ never
  outnumber the tokens that differ) drop most of the wrong ones, and what remains joins up to small groups;
* longer lists are groups of their own, lists with the same first member (by hash) one group together.

A group of up to ``BLOCK_SETS`` sets and ``BLOCK_BYTES`` is verified in one task from the exact token sets. A larger one is dealt into
blocks, each compared with the group's first set, so near copies cost their own size once; only sets that are not linked with the
first one meet all others, in pairs of blocks.

A link is emitted only where it joins two parts of a group, never all pairs. Components over these links are the answer: a link that is
not emitted has both ends in one component already.

Defined results: null text: empty; texts without words have no tokens and link with nothing; a text
of fewer words than a shingle is one token; rows with equal id stay rows of their own, and equal
texts are linked; a null id takes part, and a component of null ids alone has a null component_id.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stored, id_text, size_in_bytes
from .components import components
from .exchange import (ANSWER, ASK, RANGE_HASHES, answer_by_count, ask, chunk_count, read_answers, with_chunk)

SIZE, PERCENT = 5, 80
FREQUENT, VERY_FREQUENT = 16, 1024  # documents that hold a token of the classes with k = 2 and k = 3
SHORT_LIST = 64
BLOCK_SETS, BLOCK_BYTES = 1024, 8 << 20  # sets that one task compares with each other, and their bytes
BITMAP_BITS = 1024
BROADCAST_BYTES = 8 << 20
PROFILE = "doc_id long, text_hash long, node string, n long, bitmap array<long>, keys array<long>"


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; words lie between ASCII white space, A-Z count as a-z."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - size + 1)
    parts = [h[j:j + n] for j in range(min(size, len(h)))]
    out = np.full(n, len(parts), np.uint64)
    with np.errstate(over="ignore"):
        for part in parts:
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + part)
    return np.unique(out)


def set_name(tokens: np.ndarray) -> str | None:
    return xxhash.xxh3_128_hexdigest(tokens.tobytes()) if len(tokens) else None


def allowed_misses(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100


def bitmap(tokens: np.ndarray) -> list[int]:
    odd = np.bincount((tokens & np.uint64(BITMAP_BITS - 1)).astype(np.int64), minlength=BITMAP_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def block_count(scale: int, percent: int) -> int:
    """Blocks of either kind for sets of a scale; 0 if every token is indexed by itself.

    A block hides k - 1 shared tokens, so a block of k = 2 and one of k = 3 hide three. What two linked sets share
    must be more, or a prefix could run out before it outlasts its misses. Where that takes blocks of over twice the
    wanted size, their combinations would be too many. Scale and percent alone decide, so partners decide alike.
    """
    wanted = max(1, (100 - percent) * (1 << scale) // 100)
    smallest = -(-percent * (1 << scale) // 100)  # the smallest set with a partner of this scale
    blocks = min(wanted, (-(-percent * smallest // 100) - 1) // 3)
    return blocks if scale >= 6 and wanted <= 2 * blocks else 0


def prefix_keys(tokens: np.ndarray, classes: np.ndarray, percent: int) -> list[int]:
    """Index keys of a set: single rare tokens and combinations of frequent ones of its extended prefix.

    ``classes``: 0 for a token that no other document holds, else 1 + floor(log2(documents)). Sets of
    very different size never link, so blocks are cut for each scale (power of two) that the
    partners of this set can have. Under 64 tokens, or where ``block_count`` is 0, every token is indexed by itself.
    """
    n = len(tokens)
    if not n:
        return []
    tau = allowed_misses(n, percent)
    rank = np.where(classes > FREQUENT.bit_length() - 1, classes, np.minimum(classes, 1))
    order = np.lexsort((tokens, rank))
    smallest, largest = -(-percent * n // 100), n * 100 // percent
    scales = range(smallest.bit_length() - 1, largest.bit_length())
    need = np.ones(n, np.int64)
    need[classes > FREQUENT.bit_length() - 1] = 2
    need[classes > VERY_FREQUENT.bit_length() - 1] = 3
    keys: set[int] = set()
    for scale in scales:
        blocks = block_count(scale, percent)
        outlasts, held = 0, {}
        for i in order.tolist():
            k = int(need[i]) if blocks else 1
            if k == 1:
                outlasts += 1
                if classes[i]:
                    keys.add(int(mix(tokens[i:i + 1])[0]))
            else:
                block = held.setdefault((k, int(tokens[i] >> np.uint64(8)) % blocks), [])
                block.append(int(tokens[i]))
                outlasts += len(block) >= k
            if outlasts > tau:
                break
        for (k, block), members in held.items():
            for chosen in combinations(sorted(members), k):
                keys.add(xxhash.xxh64_intdigest(np.array([scale, k, block, *chosen], np.uint64).tobytes()))
    return [k - (1 << 64) if k >> 63 else k for k in keys]


def _sets(table: pa.Table, size: int) -> list[np.ndarray]:
    return [shingle_set(text, size) for text in table.column("text").to_pylist()]


def profiles(docs: DataFrame, size: int, percent: int, chunks: int, parts: int) -> DataFrame:
    """A row for each document: its set's name and size, parity bitmap and index keys."""
    dealt = with_chunk(docs.withColumn("text_hash", F.xxhash64("text")), chunks)

    def ask_frequency(table: pa.Table) -> pa.Table:
        sets = _sets(table, size)
        hashes, counts = np.unique(np.concatenate(sets), return_counts=True)
        return ask(table.column("chunk")[0].as_py(), hashes, counts, parts)

    def frequency_class(documents: np.ndarray, chunks_: np.ndarray) -> np.ndarray:
        return np.where(documents < 2, 0, 1 + np.floor(np.log2(documents))).astype(np.uint8)

    answers = (dealt.groupBy("chunk").applyInArrow(ask_frequency, ASK)
               .groupBy("part").applyInArrow(answer_by_count(frequency_class), ANSWER))

    def profile(table: pa.Table, answered: pa.Table) -> pa.Table:
        sets = _sets(table, size)
        lengths = [len(s) for s in sets]
        _, inverse = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_inverse=True)
        classes = np.split(read_answers(answered)[inverse], np.cumsum(lengths)[:-1]) if sets else []
        return pa.table({
            "doc_id": table.column("doc_id"), "text_hash": table.column("text_hash"), "node": pa.array([set_name(s) for s in sets], pa.string()),
            "n": pa.array(lengths, pa.int64()), "bitmap": pa.array([bitmap(s) for s in sets], pa.list_(pa.int64())),
            "keys": pa.array([prefix_keys(s, c, percent) for s, c in zip(sets, classes)], pa.list_(pa.int64()))})

    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(profile, PROFILE)


def _short_list_pairs(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) from short lists that size and bitmap allow."""
    a, b = lists.select("key", F.col("node").alias("a"), F.col("n").alias("na")), lists.select("key", F.col("node").alias("b"), F.col("n").alias("nb"))
    sized = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    pairs = a.join(b, "key").where((F.col("a") < F.col("b")) & sized).select("a", "b").distinct()
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bitmap").alias("ma"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bitmap").alias("mb"))
    differ = F.aggregate(F.zip_with("ma", "mb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    # |x xor y| <= (1 - t) / (1 + t) * (|x| + |y|)
    return (pairs.join(left, "a").join(right, "b")
            .where(differ * (100 + percent) <= (100 - percent) * (F.col("na") + F.col("nb"))).select("a", "b"))


def _verify(percent: int):
    """Spanning links of a group: (a, b) from rows (node, tokens)."""
    def verify(table: pa.Table) -> pa.Table:
        found = dict(zip(table.column("node").to_pylist(), table.column("tokens").to_pylist()))
        nodes = sorted(found)
        sets = [np.frombuffer(found[x], np.uint64) for x in nodes]
        sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = count[token] > 1
        owner, token = owner[shared], token[shared]
        _, token = np.unique(token, return_inverse=True)
        overlap = np.zeros((len(sets), len(sets)), np.float32)
        width = max(1, (16 << 20) // max(1, len(sets)))
        by_token = np.argsort(token, kind="stable")
        owner, token = owner[by_token], token[by_token]
        for start in range(0, int(token[-1]) + 1 if len(token) else 0, width):
            lo, hi = np.searchsorted(token, (start, start + width))
            held = np.zeros((len(sets), min(width, int(token[-1]) + 1 - start)), np.float32)
            held[owner[lo:hi], token[lo:hi] - start] = 1
            overlap += held @ held.T
        linked = 100 * overlap >= percent * (sizes[:, None] + sizes[None, :] - overlap)
        root, a, b = np.full(len(sets), -1), [], []
        for first in range(len(sets)):  # breadth-first over the matrix; each found set is linked with its finder
            if root[first] >= 0:
                continue
            root[first], queue = first, [first]
            while queue:
                at = queue.pop()
                for other in np.flatnonzero(linked[at] & (root < 0)).tolist():
                    root[other] = first
                    queue.append(other)
                    a.append(nodes[first])
                    b.append(nodes[other])
        return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string())})

    return verify


def _star(percent: int):
    """Whether each set of a block is linked with its group's first one: rows (name, node, rep, linked)."""
    def compare(table: pa.Table) -> pa.Table:
        first = pa.compute.index(table.column("is_first"), True).as_py()
        rep = table.column("node")[first].as_py()
        center = np.frombuffer(table.column("tokens")[first].as_buffer(), np.uint64)
        nodes, linked = [], []
        for node, is_first, packed in zip(table.column("node").to_pylist(), table.column("is_first").to_pylist(), table.column("tokens")):
            if node != rep and not is_first:
                tokens = np.frombuffer(packed.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(center, tokens), len(center) - 1)
                shared = int((center[at] == tokens).sum())
                nodes.append(node)
                linked.append(100 * shared >= percent * (len(tokens) + len(center) - shared))
        n = len(nodes)
        return pa.table({"name": pa.array(table.column("name").to_pylist()[:1] * n, pa.string()), "node": pa.array(nodes, pa.string()),
                         "rep": pa.array([rep] * n, pa.string()), "linked": pa.array(linked, pa.bool_())})

    return compare


def _large_group_links(members: DataFrame, tokens: DataFrame, percent: int) -> tuple[DataFrame, list[Stored]]:
    """Links (a, b) that span the groups of ``members`` (name, node, n, cut), which are larger than a block.

    Each block of a group is compared with the group's first set, so a group of near copies takes time in proportion to its
    sets. Only sets that are not linked with it are then compared with all others, block by block.
    """
    block = F.pmod(F.xxhash64("node"), F.col("cut")).cast("int")
    rows = members.select("name", "node", block.alias("block"), F.lit(False).alias("is_first"))
    firsts = members.groupBy("name", "cut").agg(F.min_by("node", F.xxhash64("node")).alias("node")).select(
        "name", "node", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)).alias("block"), F.lit(True).alias("is_first"))
    star = Stored(rows.unionByName(firsts).join(tokens, "node").select("name", "block", "node", "is_first", "tokens")
                  .groupBy("name", "block").applyInArrow(_star(percent), "name string, node string, rep string, linked boolean"), "star")
    apart = star.df.where("NOT linked").select("name", "node").join(members, ["name", "node"])
    sizes = apart.groupBy("name").agg(_blocks("n").alias("open_cut"), F.first("cut").alias("all_cut"))
    open_side = apart.join(sizes.select("name", "open_cut"), "name").select("name", "node", F.pmod(F.xxhash64("node"), F.col("open_cut")).cast("int").alias("i"),
                                                                             F.explode(F.sequence(F.lit(0), F.col("cut") - 1)).alias("j"))
    all_side = members.join(sizes.select("name", "open_cut"), "name").select("name", "node", F.explode(F.sequence(F.lit(0), F.col("open_cut") - 1)).alias("i"), block.alias("j"))
    rest = (open_side.unionByName(all_side).distinct().join(tokens, "node").select("name", "i", "j", "node", "tokens")
            .groupBy("name", "i", "j").applyInArrow(_verify(percent), "a string, b string"))
    return star.df.where("linked").select(F.col("rep").alias("a"), F.col("node").alias("b")).unionByName(rest), [star]


def _blocks(n: str) -> Column:
    """Blocks of a group by its sets' number and bytes."""
    return F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum(F.col(n) * 8) / BLOCK_BYTES)).cast("int")


def _token_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, tokens) of the wanted representatives (doc_id, node), computed again from their texts."""
    held = wanted.agg(F.count("*") * 64).first()[0]
    want = wanted.select(F.col("doc_id").alias("rep"), "node")
    matched = docs.join(F.broadcast(want) if held <= BROADCAST_BYTES else want, F.col("doc_id").eqNullSafe(F.col("rep")))

    def tokens(batches):
        for batch in batches:
            for start in range(0, len(batch), 512):
                part = batch.slice(start, 512)
                sets = [shingle_set(text, size) for text in part.column("text").to_pylist()]
                keep = [i for i, (s, node) in enumerate(zip(sets, part.column("node").to_pylist())) if set_name(s) == node]
                yield pa.RecordBatch.from_arrays([part.column("node").take(pa.array(keep, pa.int64())),
                                                  pa.array([sets[i].tobytes() for i in keep], pa.binary())], ["node", "tokens"])

    return matched.select("node", "text").mapInArrow(tokens, "node string, tokens binary").dropDuplicates(["node"])


def _named_rows(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """(doc_id, text_hash, n, name) for every row: the name of its component, null for a text without words."""
    base = id_text(docs, id_col, text_col)
    total = size_in_bytes(base, "text")
    chunks = chunk_count(total)
    parts = max(1, -(-total // (6 * RANGE_HASHES)))  # a token has six bytes of text or so
    parts = max(parts, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = Stored(profiles(base, size, percent, chunks, parts), "profiles")
    sets = Stored(rows.df.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap"),
        F.first("keys").alias("keys")), "sets")
    lists = sets.df.select("node", "n", F.explode("keys").alias("key"))
    counted = lists.groupBy("key").agg(F.count("*").alias("m"), F.min(F.xxhash64("node")).alias("first")).where("m > 1")
    short = lists.join(counted.where(F.col("m") <= SHORT_LIST), "key").drop("m", "first")
    pairs = Stored(_short_list_pairs(short, sets.df, percent), "pairs")
    groups = components(pairs.df).select(F.concat(F.lit("g"), "root").alias("name"), "node")
    # the many lists of one hot group hold nearly the same sets: lists with the same first member (by hash) are one
    long_lists = lists.join(counted.where(F.col("m") > SHORT_LIST), "key").select(
        F.concat(F.lit("k"), F.col("first").cast("string")).alias("name"), "node").distinct()
    members = Stored(groups.unionByName(long_lists).join(sets.df.select("node", "n"), "node").select("name", "node", "n"), "members")
    # groups over a block are few: at most one for each BLOCK_SETS members or BLOCK_BYTES of their sets
    large = Stored(members.df.groupBy("name").agg(_blocks("n").alias("cut")).where("cut > 1"), "large")
    some = F.broadcast(large.df) if large.df.count() <= BROADCAST_BYTES // 64 else large.df
    wanted = sets.df.join(members.df.select("node").distinct(), "node", "left_semi").select("doc_id", "node")
    tokens = Stored(_token_sets(base, wanted, size), "tokens")
    in_block = (members.df.join(some, "name", "left_anti").join(tokens.df, "node").select("name", "node", "tokens")
                .groupBy("name").applyInArrow(_verify(percent), "a string, b string"))
    spanning, spent_too = _large_group_links(members.df.join(some, "name"), tokens.df, percent)
    links = Stored(in_block.unionByName(spanning), "links")
    roots = components(links.df).withColumnRenamed("node", "linked")
    for spent in (pairs, members, large, tokens, links, *spent_too):
        spent.drop()
    return rows.df.select("doc_id", "text_hash", "n", "node").join(roots, F.col("node") == F.col("linked"), "left").select(
        "doc_id", "text_hash", "n", F.coalesce("root", "node").alias("name"))


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                    percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row: the smallest id that its links reach."""
    named = _named_rows(docs, id_col, text_col, size, percent)
    smallest = named.where("name IS NOT NULL").groupBy("name").agg(F.min("doc_id").alias("smallest"))
    return named.join(smallest, "name", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"))


def spare_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
               percent: int = PERCENT) -> DataFrame:
    """Distinct (doc_id, text_hash) of the rows that are not the first of their component.

    The first one has the smallest id (a null id comes last) and, of several texts with that id, the smallest hash.
    """
    named = _named_rows(docs, id_col, text_col, size, percent).where("name IS NOT NULL")
    first = named.groupBy("name").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"))
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    return named.join(first, "name").where(~stays).select("doc_id", "text_hash").distinct()
