"""Queries without SQL against plain versions: labeller accuracies, lines' tokens, toxic documents held out."""

import base64
import math
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from adtally.llm import quality, queries
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.test_contracts import documents, given


def plain_accuracies(rows, steps):
    """Expectation-maximisation document by document, with loops."""
    labellers = range(len(rows[0]))
    chance = [[0.6, 0.05] for _ in labellers]
    bad, posterior = quality.PRIOR_BAD, []
    for _ in range(steps):
        posterior = []
        for votes in rows:
            fit = []
            for kind, share in ((quality.BAD, bad), (quality.GOOD, 1 - bad)):
                fit.append(math.log(share) + sum(math.log(chance[j][kind] if votes[j] == quality.BAD else 1 - chance[j][kind])
                                                 for j in labellers if votes[j] != quality.ABSTAIN))
            most = max(fit)
            weights = [math.exp(f - most) for f in fit]
            posterior.append([w / sum(weights) for w in weights])
        bad = min(max(sum(p[quality.BAD] for p in posterior) / len(rows), 1e-4), 1 - 1e-4)
        chance = [[(sum(p[kind] for votes, p in zip(rows, posterior) if votes[j] == quality.BAD) + 1)
                   / (sum(p[kind] for votes, p in zip(rows, posterior) if votes[j] != quality.ABSTAIN) + 2) for kind in (quality.BAD, quality.GOOD)]
                  for j in labellers]
    return [p[quality.GOOD] for p in posterior], chance, bad


@pytest.mark.parametrize("seed", range(3))
def test_op4_estimates_like_the_plain_loop(seed):
    pick = random.Random(seed)
    rows = []
    for _ in range(300):
        truly_bad = pick.random() < 0.2
        rows.append(tuple(quality.ABSTAIN if pick.random() < 0.3 else quality.BAD if pick.random() < (0.8 if truly_bad else 0.1) else quality.GOOD for _ in range(5)))
    patterns = sorted(set(rows))
    posterior, chance, bad = quality.estimate(np.array(patterns), np.array([rows.count(p) for p in patterns]))
    expected, plain_chance, plain_bad = plain_accuracies(rows, quality.EM_STEPS)
    found = dict(zip(patterns, posterior))
    assert max(abs(found[r] - e) for r, e in zip(rows, expected)) < 1e-9 and abs(bad - plain_bad) < 1e-9
    assert np.allclose(chance, plain_chance, atol=1e-9)


def plain_line_counts(text, encoding):
    """(section, begin, end, tokens, crossing) of each line; a crossing token goes to the line with most of its bytes."""
    lines = (text or "").split("\n")
    lines = [line + "\n" for line in lines[:-1]] + ([lines[-1]] if lines[-1] or len(lines) == 1 else [])
    of_byte = [i for i, line in enumerate(lines) for _ in line.encode()]
    counts, crossing, at = [0] * len(lines), [0] * len(lines), 0
    for token in encoding.encode_ordinary(text or ""):
        size = len(encoding.decode_single_token_bytes(token))
        held = of_byte[at:at + size]
        at += size
        touched = sorted(set(held))
        counts[max(touched, key=lambda i: (held.count(i), -i))] += 1
        if len(touched) > 1:
            for i in touched:
                crossing[i] += 1
    out, begin = [], 0
    for i, line in enumerate(lines):
        out.append((i, begin, begin + len(line), counts[i], crossing[i]))
        begin += len(line)
    return out


def test_op9_lines(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    encoding = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = sorted((doc, *row) for doc, text in documents(SF_SMALL) for row in plain_line_counts(text, encoding))
    assert sorted(tuple(r) for r in queries.op9_token_counts(spark, SF_SMALL).collect()) == expected


def test_op1_finds_held_out_toxic_documents(spark):
    labels = dict(given(SF_MID, "SELECT doc_id, toxic FROM {labels}"))
    rows = [r for r in queries.op1_toxicity(spark, SF_MID).collect() if r.held_out and r.doc_id in labels]
    toxic = [r for r in rows if labels[r.doc_id]]
    assert len(toxic) >= 5 and sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(not r.predicted for r in rows if not labels[r.doc_id]) >= 0.95 * (len(rows) - len(toxic))
