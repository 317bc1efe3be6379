"""Conversation structure repair: cheapest edits by a shortest path whose weights are single integers.

Rows of a conversation are taken by turn (null first; ties by role, then the text's digest). A row's first fault counts: *blank* (no
character outside 0x20, 0x09-0x0D), *duplicate* (its role and text stand on an earlier row), *truncated* (its last such
character is none of ``.!?``). Edits make the initials of the roles match ``(s?(ua)+)?``: Keep (0), Rerole to user
or assistant (2), Delete (3, required for blank and duplicate rows), Insert an empty user or assistant turn (2); a
truncated row that stays costs 1. Of the cheapest lists of edits the one with the ASCII-least initials is taken.

The grammar has four states (nothing yet, after the system row, after a user, after an assistant), so a node
of the graph is a row and a state, and an edit is an edge. An edge's weight is one integer: its high digits are the cost, its
low digits, of fixed width, hold the letters of its edits (D, I, K, R: 1 to 4; 0 behind the last), the first letter
highest. A path's weight is the edges' costs summed and their letters one behind the other, and the least integer decides
cost and letters at once. Inserts before a row belong to that row's edge, so letters of two paths over
the same rows are equal or differ where both have one. For the same reason the rows can be cut into blocks: behind
a block only the order of its four states' best ends matters, a digit below the letters. Integers so stay as long
as a block, and a conversation takes time in proportion to its rows.

Scale: rows are shuffled once, by conversation; the duplicates are found by a window within that partitioning and every
row is then read twice from a sort, first without text (all of a conversation's symbols, a byte each, from which the edits
follow), then with it. So a task holds symbols and edits of one conversation, never its texts, whatever its
length; sorts spill. A conversation stays in one task: its digest is a chain over its rows.

Defined results: a null role or text is one space, a null turn is the first turn; an empty role has no initial and
is never kept; only user and assistant rows are inserted; a conversation without rows after the damage has zeros, no edits
and an empty repaired text; a null conversation id is a conversation like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 128  # rows of a block of the graph
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # fixed values: costs
LETTERS = {"D": 1, "I": 2, "K": 3, "R": 4}
START, SYSTEM, USER, ASSISTANT = range(4)
# state -> (state, initial) by the next role's initial
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ROLE = {"u": "user", "a": "assistant"}
DIGIT = 3  # bits of a letter
RANK = 2  # bits for the order of the states behind a block
WIDTH = 3 * BLOCK + 2  # letters of a block: an edit and two inserts for each row, and inserts behind the last
SPACE = " \t\n\x0b\x0c\r"
BATCH = 256  # rows handed on at once
DROP, EMPTY, STRIP, REPEAT, USER_ROLE = range(5)
REPAIRED = ("conv_id long, place long, edit string, role string, text string, gaps long, blank long, duplicate long, "
            "truncated long, illegal long, cost long, audit string")
_KINDS = [(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in REPAIRED.split(", ")]


def _shown(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, there) with faults planted by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row (it stays with ``there`` false), 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes it a user's.
    """
    fault = F.crc32(F.concat_ws(":", _shown("conv_id"), _shown("turn"))) % 20
    rows = conversations.select("conv_id", "turn", _shown("role").alias("role"), _shown("text").alias("text"), fault.alias("fault"))
    kind, text = F.col("fault"), F.col("text")
    copies = F.when(kind == REPEAT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", F.when(kind == USER_ROLE, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind == EMPTY, F.lit("")).when(kind == STRIP, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind != DROP).alias("there"), F.explode(copies).alias("copy")).drop("copy")


def _edges(symbol: str) -> list[tuple[int, int, int, str]]:
    """(state, next state, cost, letters) over a row; ``symbol``: role's initial (else ``-``) and fault (b, d, t or -)."""
    initial, fault = symbol
    out = []
    for state in NEXT:
        for inserts in range(3):  # three would come back to a state already left
            at, steps = state, "I" * inserts
            for _ in range(inserts):
                at = ASSISTANT if at == USER else USER
            cost = INSERT * inserts
            out.append((state, at, cost + DELETE, steps + "D"))
            if fault in "bd":
                continue
            cost += TRUNCATED * (fault == "t")
            if initial in NEXT[at]:
                out.append((state, NEXT[at][initial], cost + KEEP, steps + "K"))
            for role in ROLE:
                if role in NEXT[at]:
                    out.append((state, NEXT[at][role], cost + REROLE, steps + "R"))
    return out


def _number(letters: str) -> int:
    """Letters as the highest digits of the fixed width."""
    value = 0
    for letter in letters:
        value = value << DIGIT | LETTERS[letter]
    return value << DIGIT * (WIDTH - len(letters)) + RANK


def _letters(number: int) -> str:
    """Letters of a weight, to the zeros at their end."""
    shown = {n: letter for letter, n in LETTERS.items()}
    out, at = [], DIGIT * (WIDTH - 1) + RANK
    while at >= RANK and (digit := number >> at & 7):
        out.append(shown[digit])
        at -= DIGIT
    return "".join(out)


COST_AT = DIGIT * WIDTH + RANK  # the cost's lowest bit
_LOW, _RANKS = (1 << COST_AT) - 1, (1 << RANK) - 1
_EDGES: dict[str, list[tuple[int, int, int, int]]] = {}


def _weights(symbol: str) -> list[tuple[int, int, int, int]]:
    """(state, next state, weight, how far the letters behind it move down)."""
    if symbol not in _EDGES:
        _EDGES[symbol] = [(a, b, (cost << COST_AT) + _number(letters), DIGIT * len(letters)) for a, b, cost, letters in _edges(symbol)]
    return _EDGES[symbol]


def _ranks(value: dict[int, int]) -> dict[int, int]:
    """The order of the states' letters, equal ones equal."""
    order = {low: i for i, low in enumerate(sorted({total & _LOW for total in value.values()}))}
    return {state: order[total & _LOW] for state, total in value.items()}


def cheapest_edits(symbols: Sequence[str]) -> tuple[int, str]:
    """(cost, initials of the edits) of rows given by symbols (see ``_edges``)."""
    value = {START: 0, ASSISTANT: 0, USER: (INSERT << COST_AT) + _number("I"), SYSTEM: (2 * INSERT << COST_AT) + _number("II")}
    ends = {state: _letters(total) for state, total in value.items()}
    blocks = [symbols[i:i + BLOCK] for i in range(0, len(symbols), BLOCK)]
    choices: list[dict[int, tuple[str, int]]] = []  # of each block, last first: letters and the state behind it
    for block in reversed(blocks):
        rank = _ranks(value)
        value = {state: (total >> COST_AT << COST_AT) + rank[state] for state, total in value.items()}
        for symbol in reversed(block):
            best: dict[int, int] = {}
            for state, following, weight, moved in _weights(symbol):
                tail = value[following]
                low = tail & _LOW
                total = weight + tail - low + (low >> RANK + moved << RANK) + (low & _RANKS)
                if state not in best or total < best[state]:
                    best[state] = total
            value = best
        letters = {state: _letters(total) for state, total in value.items()}
        choices.append({state: (edits, _walk(state, block, edits)) for state, edits in letters.items()})
    state, out = START, []
    for left in reversed(choices):
        edits, state = left[state]
        out.append(edits)
    return value[START] >> COST_AT, "".join(out) + ends[state]


def _walk(state: int, block: Sequence[str], letters: str) -> int:
    """The state behind a block's edits."""
    rows = iter(block)
    for letter in letters:
        if letter == "I":
            state = ASSISTANT if state == USER else USER
            continue
        symbol = next(rows)
        if letter == "K":
            state = NEXT[state][symbol[0]]
        elif letter == "R":
            state = ASSISTANT if state == USER else USER
    return state


class _Conversation:
    """One conversation: its symbols while they are read, then its edits row by row."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.symbols, self.turns, self.last = conv_id, [], [], None
        self.distinct, self.edits, self.place, self.state = 0, None, 0, START

    def add(self, turn: int | None, symbol: str | None) -> None:
        if symbol is None:  # names the conversation only
            return
        self.symbols.append(symbol)
        if turn is not None and turn != self.last:
            self.turns = [*self.turns[:1], turn]  # the first and the last
            self.distinct += 1
            self.last = turn

    def _row(self, edit: str | None, role: str | None, text: str | None, counts: tuple = (None,) * 7) -> tuple:
        place, self.place = self.place, self.place + 1
        return self.conv_id, place, edit, role, text, *counts

    def report(self) -> tuple:
        """The row of place 0; decides the edits."""
        cost, audit = cheapest_edits(self.symbols)
        faults = [sum(s[1] == kind for s in self.symbols) for kind in "bdt"]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(self.symbols, self.symbols[1:]))
        gaps = self.turns[-1] - self.turns[0] + 1 - self.distinct if self.turns else 0
        self.edits = iter(audit)
        return self._row(None, None, None, (gaps, *faults, illegal, cost, audit))

    def _inserted(self) -> tuple:
        self.state = ASSISTANT if self.state == USER else USER
        return self._row("I", "assistant" if self.state == ASSISTANT else "user", "")

    def edited(self, role: str, text: str) -> Iterator[tuple]:
        """The edits up to that of the next row."""
        while (edit := next(self.edits)) == "I":
            yield self._inserted()
        if edit == "K":
            self.state = NEXT[self.state][role[0]]
        elif edit == "R":
            self.state = ASSISTANT if self.state == USER else USER
            role = "assistant" if self.state == ASSISTANT else "user"
        yield self._row(edit, role, text)

    def rest(self) -> Iterator[tuple]:
        """What has not been given yet when the conversation's rows end."""
        if self.edits is None:
            yield self.report()
        for _ in self.edits:
            yield self._inserted()


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    current = None
    for batch in batches:
        for conv_id, again, turn, role, text, symbol in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "again", "turn", "role", "text", "symbol")]):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    yield from current.rest()
                current = _Conversation(conv_id)
            if not again:
                current.add(turn, symbol)
                continue
            if current.edits is None:
                yield current.report()
            yield from current.edited(role, text)
    if current is not None:
        yield from current.rest()


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = _repaired(batches)
    while part := list(islice(rows, BATCH)):
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*part), _KINDS)], [n for n, _ in _KINDS])


def repair_conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", there: str | None = None) -> DataFrame:
    """Rows of ``REPAIRED``, in order within a task: for each conversation one of place 0 with its counts, cost and edits, then
    one for each edit with the row as it then is (a deleted one as it was). ``there``: a boolean column, false for
    rows that only name their conversation.
    """
    given = rows.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), _shown(role_col).alias("role"),
                        _shown(text_col).alias("text"), (F.col(there) if there else F.lit(True)).alias("there"))
    same = Window.partitionBy("conv_id", "there", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    numbered = (given.withColumn("digest", F.sha2("text", 256)).repartition("conv_id").withColumn("nth", F.row_number().over(same)))
    last = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    fault = (F.when(last == "", F.lit("b")).when(F.col("nth") > 1, F.lit("d"))
             .when(last.isin(".", "!", "?"), F.lit("-")).otherwise(F.lit("t")))
    initial = F.substring("role", 1, 1)
    symbol = F.when(F.col("there"), F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("-")), fault))
    again = F.when(F.col("there"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    twice = numbered.select("conv_id", "turn", "role", "text", "digest", "nth", symbol.alias("symbol"), F.explode(again).alias("again"))
    return (twice.withColumn("text", F.when(F.col("again"), F.col("text")))
            .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "again", F.col("turn").asc_nulls_first(), "role", "digest", "nth")
            .select("conv_id", "again", "turn", "role", "text", "symbol").mapInArrow(_repair, REPAIRED))


def with_digest(repaired: DataFrame) -> DataFrame:
    """A row for each conversation, with the digest of its repaired rows ``role:text``, joined by line ends.

    ``repaired`` as ``repair_conversations`` gives it: the rows of a conversation stand together, in order.
    """
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, current, digest, opened = [], None, None, False

        def finished() -> pa.RecordBatch:
            columns = list(zip(*done))
            done.clear()
            return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:7]], *[pa.array(c, pa.string()) for c in columns[7:]]],
                                              ["conv_id", *counts, "audit", "repaired_sha256"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["place"] == 0:
                    if current is not None:
                        done.append((*current, digest.hexdigest()))
                    current, digest, opened = (row["conv_id"], *[row[c] for c in counts], row["audit"]), hashlib.sha256(), False
                elif row["edit"] != "D":
                    digest.update(f"{chr(10) if opened else ''}{row['role']}:{row['text']}".encode())
                    opened = True
            if len(done) >= BATCH:
                yield finished()
        if current is not None:
            done.append((*current, digest.hexdigest()))
            yield finished()

    return repaired.mapInArrow(run, "conv_id long, " + ", ".join(f"{c} long" for c in counts) + ", audit string, repaired_sha256 string")
