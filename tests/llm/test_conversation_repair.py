"""Conversation repair against a search over all edits."""

import itertools
import random
import re
import zlib

import pytest

from adtally.llm import conversation_repair as repair, queries
from tests.conftest import SF_SMALL
from tests.llm import plain
from tests.llm.test_contracts import duckdb

GOOD = re.compile("(s?(ua)+)?")


def all_edits(rows):
    """Cheapest (cost, audit, repaired rows) of rows (role, text, kind) by trying everything (three inserts at most in a place)."""
    best = None

    def go(i, cost, audit, out):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows):
            for n in range(3):
                for roles in itertools.product(("user", "assistant"), repeat=n):
                    whole = out + [(r, "") for r in roles]
                    if GOOD.fullmatch("".join(r[:1] or "-" for r, _ in whole)):
                        found = (cost + 2 * n, audit + "I" * n, whole)
                        if best is None or found[:2] < best[:2]:
                            best = found
            return
        role, text, kind = rows[i]
        for n in range(3):
            for roles in itertools.product(("user", "assistant"), repeat=n):
                with_inserts = out + [(r, "") for r in roles]
                base, letters = cost + 2 * n, audit + "I" * n
                go(i + 1, base + 3, letters + "D", with_inserts)
                if kind in "bd":
                    continue
                more = int(kind == "t")
                go(i + 1, base + more, letters + "K", with_inserts + [(role, text)])
                for r in ("user", "assistant"):
                    go(i + 1, base + 2 + more, letters + "R", with_inserts + [(r, text)])

    go(0, 0, "", [])
    return best


def kinds(rows):
    """Rows (role, text) with their first fault."""
    seen, out = set(), []
    for role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        kind = "b" if not last else "d" if (role, text) in seen else "-" if last[-1] in ".!?" else "t"
        seen.add((role, text))
        out.append((role, text, kind))
    return out


def plain_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of rows (turn, role, text) in order."""
    marked = kinds([(r, t) for _, r, t in rows])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, done = all_edits(marked)
    return (gaps, *[sum(k == kind for _, _, k in marked) for kind in "bdt"], illegal, cost, audit,
            plain.sha("\n".join(f"{r}:{t}" for r, t in done)))


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], plain.sha(r[2])))


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault:
            row = (turn, "user" if fault == 4 else role, "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text)
            out += [row, row] if fault == 3 else [row]
    return in_order(out)


def test_op12_on_the_conversations(spark):
    given = duckdb.connect().execute(f"SELECT conv_id, turn, role, text FROM '{SF_SMALL}/conversations.parquet'").fetchall()
    expected = sorted((conv, *plain_repair(plain_damage([r for r in given if r[0] == conv]))) for conv in {r[0] for r in given})
    assert sorted(map(tuple, queries.op12_conversation_repair(spark, SF_SMALL).collect())) == expected


def test_cheapest_edits_against_all_edits():
    pick = random.Random(3)
    symbols = [a + b for a in "sua-" for b in "bdt-"]
    for n in (0, 1, 2, 3, 4, 5):
        for _ in range(25):
            chosen = pick.choices(symbols, weights=[1 + 2 * (s[1] in "t-") for s in symbols], k=n)
            rows = [({"s": "system", "u": "user", "a": "assistant", "-": "tool"}[s[0]], str(i), s[1]) for i, s in enumerate(chosen)]
            assert repair.cheapest_edits(chosen) == all_edits(rows)[:2], chosen


@pytest.mark.parametrize("block", [1, 2, 5])
def test_blocks_change_nothing(monkeypatch, block):
    pick = random.Random(block)
    whole = [[pick.choice("sua-") + pick.choice("bdt--") for _ in range(n)] for n in (7, 30, 100) for _ in range(10)]
    expected = [repair.cheapest_edits(s) for s in whole]
    monkeypatch.setattr(repair, "BLOCK", block)
    assert [repair.cheapest_edits(s) for s in whole] == expected


def test_a_long_conversation_takes_time_in_proportion():
    import time
    symbols = ["u-", "at", "u-", "ub", "s-"] * 10_000
    start = time.time()
    cost, audit = repair.cheapest_edits(symbols)
    assert len(audit.replace("I", "")) == len(symbols) and cost > 0 and time.time() - start < 60


def test_edge_rows_and_clashing_names(spark):
    rows = [(1, None, "user", "First."), (1, 5, "assistant", None), (1, 5, None, "Odd role."), (1, 9, "assistant", "End"), (1, 9, "assistant", "End"),
            (2, 3, "", "no role."), (2, 4, "assistant", "\t\n "), (None, 1, "user", "Lost?"), (3, None, "sys", "s."), (3, None, "user", "u" * 100_000 + "!"),
            (4, 0, "user", "é 中文。"), (4, 1, "assistant", "ok!")]
    frame = spark.createDataFrame([(*r, 7, "x") for r in rows], "conv_id long, turn long, role string, text string, symbol int, edit string")
    found = sorted(map(tuple, repair.with_digest(repair.repair_conversations(frame)).collect()), key=str)
    expected = []
    for conv in {r[0] for r in rows}:
        own = in_order([(t, *(" " if x is None else x for x in (role, text))) for c, t, role, text in rows if c == conv])
        expected.append((conv, *plain_repair(own)))
    assert found == sorted(expected, key=str)
    damaged = repair.with_digest(repair.repair_conversations(repair.damaged(frame), there="there")).collect()
    assert {r.conv_id for r in damaged} == {r[0] for r in rows}


def test_all_rows_dropped_and_no_rows(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(conv, 0, "user", "Gone.")], "conv_id long, turn long, role string, text string")
    done = repair.with_digest(repair.repair_conversations(repair.damaged(frame), there="there")).collect()
    assert [tuple(r) for r in done] == [(conv, 0, 0, 0, 0, 0, 0, "", plain.sha(""))]
    assert repair.with_digest(repair.repair_conversations(repair.damaged(frame.limit(0)), there="there")).collect() == []


def test_repaired_rows_are_grammatical(spark):
    given = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = repair.repair_conversations(repair.damaged(given), there="there").orderBy("conv_id", "place").collect()
    for _, own in itertools.groupby(rows, key=lambda r: r.conv_id):
        report, *edits = own
        assert "".join(e.edit for e in edits) == report.audit
        assert GOOD.fullmatch("".join(e.role[0] for e in edits if e.edit != "D"))
