"""Plain single-machine versions of the operators, for comparison on small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def lower_ascii(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def components(ids, links) -> dict:
    parent = {i: i for i in ids}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def remove_earlier(rows, length=50):
    """(n_bytes, n_removed, n_spans, kept digest) by row number; rows (doc_id, text)."""
    first = {}
    data = [((text or "").encode(), doc) for doc, text in rows]
    smallest = lambda d: (d is not None, d or 0)
    for raw, doc in data:
        for i in range(len(raw) - length + 1):
            s = raw[i:i + length]
            if s not in first or smallest(doc) < smallest(first[s]):
                first[s] = doc
    out = []
    for raw, doc in data:
        covered = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if smallest(first[raw[i:i + length]]) < smallest(doc):
                covered[i:i + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(covered)))
        out.append((doc, len(raw), sum(covered), spans, sha(bytes(b for b, c in zip(raw, covered) if not c))))
    return out


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def jaccard_components(rows, size, percent):
    """{doc_id: (n_shingles, component)} for rows (doc_id, text) with distinct ids."""
    sets = {doc: shingles(text, size) for doc, text in rows}
    holders = defaultdict(list)
    for doc, s in sets.items():
        for x in s:
            holders[x].append(doc)
    pairs = {(a, b) for docs in holders.values() for a in docs for b in docs if a < b}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    found = components(sets, links)
    return {doc: (len(s), found[doc]) for doc, s in sets.items()}


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text or ""))


def contamination(docs, items, size=13):
    """(doc_id, n_words, n_hit, sorted item ids) for each row."""
    windows = defaultdict(set)
    for item, text in items:
        w = bench_words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i:i + size])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = bench_words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                got = windows.get(tuple(w[i:i + n]))
                if got:
                    found |= got
                    hit.update(range(i, i + n))
        out.append((doc, len(w), len(hit), sorted(found)))
    return out


def dedup_lines(rows, size=3):
    """(doc_id, n_lines, n_removed, kept text or None) for rows (doc_id, text) with distinct ids."""
    seen, out = set(), []
    for doc, text in sorted(rows):
        if text is None:
            out.append((doc, 0, 0, None))
            continue
        lines, covered = text.split("\n"), set()
        for i in range(len(lines) - size + 1):
            window = tuple(lines[i:i + size])
            if window in seen:
                covered.update(range(i, i + size))
            seen.add(window)
        out.append((doc, len(lines), len(covered), "\n".join(x for i, x in enumerate(lines) if i not in covered)))
    return out
