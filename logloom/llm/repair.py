"""Conversation structure repair by a run-length min-plus recurrence.

A conversation should be an optional system turn and then pairs of user and assistant turns.
Turns that are blank or repeat an earlier turn must go, turns that break off cost a little, and
the cheapest edits that give a legal order of roles are looked for: keep, give the role
that fits, delete, insert an empty turn.

The state between two turns is what the last kept turn was: nothing yet (0), system
(1), user (2), assistant (3).  A turn is a symbol: its role's initial and its fault.  Equal neighbours
form a run; the cost to go over a run comes from the binary powers of the symbol's
4 x 4 min-plus matrix, which are kept.  Costs to go in hand, choices are unrolled from
the front; a letter leads to one state only, so taking the least letter that keeps the
cost gives the least of the cheapest audits.

Nothing needs a conversation in one task.  Equal rows are counted before they move, rows are sorted by
ranges of (conversation, turn) and cut into pieces of bounded size.  A piece of a conversation that
goes on elsewhere is one matrix; costs to go pass over these matrices from the back, choices over
the pieces' state maps from the front (a few numbers for thousands of turns), then every piece is unrolled by itself.

Defined results: turns are ordered by number, null numbers first, equal numbers by role and text; a
null role or text is empty; a repeated row is a repeated turn, so a duplicate; a null conversation
id is a conversation; roles count by their first character; other columns are not read; texts of any
length are read whole; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import materialize, prepare
from logloom.operators.lookup import lookup

# Fixed values of the contract: what edits and faults cost.
DELETE, REROLE, INSERT, BROKEN = 3, 2, 2, 1
BLANKS = " \t\n\x0b\x0c\r"

PIECE_ROWS, PIECE_CHARS, PIECE_COPIES = 2000, 4_000_000, 1_000_000
FIRST_TURN = -(2**63)

STATES = range(4)
# The state that an inserted or re-roled turn leads to, and the role it gets.
NEXT = (2, 2, 3, 2)
GIVEN = {2: "user", 3: "assistant"}
# By initial: the states a kept turn may follow and the state it leads to.
KEPT = {"s": ((0,), 1), "u": ((0, 1, 3), 2), "a": ((2,), 3)}
INITIALS = ("s", "u", "a", "")
LEGAL = {"su", "ua", "au"}
GONE = 0
FAR = 1 << 60

Matrix = tuple[tuple[int, ...], ...]
Costs = tuple[int, ...]


def symbol(initial: str, broken: bool) -> int:
    """A turn that may stay; turns that must go are ``GONE``."""
    return 1 + 2 * (INITIALS.index(initial) if initial in INITIALS[:3] else 3) + int(broken)


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in STATES) for j in STATES) for i in STATES)


def _apply(m: Matrix, v: Costs) -> Costs:
    return tuple(min(m[i][k] + v[k] for k in STATES) for i in STATES)


def _inserts() -> Matrix:
    one = tuple(tuple(0 if i == j else INSERT if NEXT[i] == j else FAR for j in STATES) for i in STATES)
    return _times(_times(one, one), one)


_INSERTS = _inserts()
# Cost to end after the last turn: nothing and assistant are ends.
END: Costs = _apply(_INSERTS, (0, FAR, FAR, 0))


@lru_cache(maxsize=None)
def power(sym: int, j: int) -> Matrix:
    """The min-plus transition of 2^j turns of one symbol, inserts before each turn included."""
    if j:
        half = power(sym, j - 1)
        return _times(half, half)
    edges = [[DELETE if s == t else FAR for t in STATES] for s in STATES]
    if sym != GONE:
        initial, fee = INITIALS[(sym - 1) // 2], (sym - 1) % 2 * BROKEN
        for s in STATES:
            edges[s][NEXT[s]] = min(edges[s][NEXT[s]], REROLE + fee)
            if initial and s in KEPT[initial][0]:
                edges[s][KEPT[initial][1]] = min(edges[s][KEPT[initial][1]], fee)
    return _times(_INSERTS, tuple(map(tuple, edges)))


@lru_cache(maxsize=1 << 16)
def before(sym: int, n: int, after: Costs) -> tuple[Costs, int]:
    """Costs to go before a run of ``n`` turns: differences to the least of them, and the least."""
    v, j = after, 0
    while n >> j:
        if n >> j & 1:
            v = _apply(power(sym, j), v)
        j += 1
    least = min(v)
    return tuple(x - least for x in v), least


@lru_cache(maxsize=1 << 16)
def choose(sym: int, after: Costs, state: int) -> tuple[str, int, int]:
    """The least letters that take one turn at the cost to go, the new state, and their cost."""
    costs = _apply(power(sym, 0), after)
    letters, spent = "", 0
    initial, fee = (INITIALS[(sym - 1) // 2], (sym - 1) % 2 * BROKEN) if sym != GONE else ("", 0)
    while True:
        left = costs[state]
        if DELETE + after[state] == left:
            return letters + "D", state, spent + DELETE
        follower = NEXT[state]
        if INSERT + costs[follower] == left:
            letters, state, spent = letters + "I", follower, spent + INSERT
            continue
        if initial and state in KEPT[initial][0] and fee + after[KEPT[initial][1]] == left:
            return letters + "K", KEPT[initial][1], spent + fee
        return letters + "R", follower, spent + REROLE + fee


def closing(state: int) -> list[int]:
    """States of the turns inserted at the end."""
    out = []
    while END[state]:
        state = NEXT[state]
        out.append(state)
    return out


def run_costs(syms: list[int], lens: list[int], end: Costs) -> list[Costs]:
    """Costs to go behind every run, differences only."""
    behind = [end]
    for sym, n in zip(reversed(syms), reversed(lens)):
        behind.append(before(sym, n, behind[-1])[0])
    return behind[::-1][1:]


def letters_of(sym: int, n: int, after: Costs, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(letters, state before, state after, cost) of every turn of a run, in order."""
    if sym == GONE:
        yield "D" * n, state, state, DELETE * n
        return
    behind = [after]
    for _ in range(n - 1):
        behind.append(before(sym, 1, behind[-1])[0])
    for costs in reversed(behind):
        letters, then, spent = choose(sym, costs, state)
        yield letters, state, then, spent
        state = then


def matrix_of(syms: list[int], lens: list[int]) -> Matrix:
    total: Matrix = tuple(tuple(0 if i == j else FAR for j in STATES) for i in STATES)
    for sym, n in zip(syms, lens):
        j = 0
        while n >> j:
            if n >> j & 1:
                total = _times(total, power(sym, j))
            j += 1
    return total


def exits(syms: list[int], lens: list[int], end: Costs) -> list[int]:
    """The state behind a piece for each state before it."""
    behind, out = run_costs(syms, lens, end), []
    for state in STATES:
        for sym, n, after in zip(syms, lens, behind):
            for _, _, then, _ in letters_of(sym, n, after, state):
                state = then
        out.append(state)
    return out


def unroll(syms: list[int], lens: list[int], roles: list[str], texts: list[str], end: Costs, state: int, last: bool):
    """(audit, cost, roles, texts) of a piece."""
    audit, cost, out_roles, out_texts, at = [], 0, [], [], 0
    for sym, n, after in zip(syms, lens, run_costs(syms, lens, end)):
        for letters, state, then, spent in letters_of(sym, n, after, state):
            audit.append(letters)
            cost += spent
            if sym == GONE:
                continue
            for letter in letters:
                if letter == "I":
                    state = NEXT[state]
                    out_roles.append(GIVEN[state])
                    out_texts.append("")
                elif letter != "D":
                    out_roles.append(roles[at] if letter == "K" else GIVEN[then])
                    out_texts.append(texts[at])
            at += 1
        if syms:
            state = then
    for given in closing(state) if last else []:
        audit.append("I")
        cost += INSERT
        out_roles.append(GIVEN[given])
        out_texts.append("")
    return "".join(audit), cost, out_roles, out_texts


_COUNTS = ("n_rows", "blank", "duplicate", "truncated", "illegal")
_TURNS = ("min_turn", "max_turn", "n_turns")
_HEAD = (
    "part int, no int, whole boolean, "
    + ", ".join(f"{c} bigint" for c in (*_COUNTS, *_TURNS))
    + ", first_initial string, last_initial string"
)
_PIECES = _HEAD + ", syms array<int>, lens array<bigint>, roles array<string>, texts array<string>"
_REPAIRED = _HEAD + ", last boolean, cost bigint, audit string, roles array<string>, texts array<string>"

_ARROW = {
    "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(),
    "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
}


def _batch(rows: list[dict], fields: str, kind: pa.DataType) -> pa.RecordBatch:
    names = ["conv_id"] + [f.split()[0] for f in fields.split(", ")]
    kinds = [kind] + [_ARROW[f.split()[1]] for f in fields.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names)


class _Piece:
    """Turns of one conversation in order, as counts and runs."""

    def __init__(self, conv, no: int):
        self.row = {"conv_id": conv, "no": no, "syms": [], "lens": [], "roles": [], "texts": []}
        self.row |= dict.fromkeys((*_COUNTS, "n_turns"), 0)
        self.row |= dict.fromkeys(("min_turn", "max_turn", "first_initial", "last_initial"))
        self.size, self.taken = 0, 0

    def add(self, turn, role: str, text: str, copies: int, fault: str | None, repeats: bool) -> None:
        row, initial = self.row, role[:1]
        self.taken += 1
        if row["n_rows"] == 0:
            row["first_initial"] = initial
        else:
            row["illegal"] += row["last_initial"] + initial not in LEGAL
        row["illegal"] += (copies - 1) * (initial + initial not in LEGAL)
        row["last_initial"] = initial
        row["n_rows"] += copies
        if turn is not None:
            row["n_turns"] += turn != row["max_turn"]
            row["max_turn"] = turn
            row["min_turn"] = turn if row["min_turn"] is None else row["min_turn"]
        if fault == "blank":
            row["blank"] += copies
            return self.run(GONE, copies)
        gone = copies if repeats else copies - 1
        row["duplicate"] += gone
        if not repeats:
            row["truncated"] += fault == "truncated"
            self.run(symbol(initial, fault == "truncated"), 1)
            row["roles"].append(role)
            row["texts"].append(text)
            self.size += len(text) + len(role)
        self.run(GONE, gone)

    def run(self, sym: int, n: int) -> None:
        if n and self.row["syms"] and self.row["syms"][-1] == sym:
            self.row["lens"][-1] += n
        elif n:
            self.row["syms"].append(sym)
            self.row["lens"].append(n)

    def full(self, rows: int, copies: int) -> bool:
        return self.taken >= rows or self.size >= PIECE_CHARS or self.row["n_rows"] >= copies


def _cut(kind: pa.DataType, most_rows: int, most_copies: int):
    """Sorted rows of a partition to pieces.  Only a conversation inside it, in one piece, is known whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no = TaskContext.get().partitionId(), 0
        piece, first, rows, size = None, True, [], 0

        def close(whole: bool) -> None:
            nonlocal size
            rows.append(piece.row | {"part": part, "whole": whole})
            size += piece.size + 100

        alone = False  # this piece is its conversation's first
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for conv, turn, role, text, copies, fault, repeats in zip(*columns):
                if piece is not None and piece.row["conv_id"] != conv:
                    close(alone and not first)
                    piece, first = None, False
                    no += 1
                while copies:
                    if piece is not None and piece.full(most_rows, most_copies):
                        close(False)
                        no += 1
                        piece, alone = _Piece(conv, no), False
                    elif piece is None:
                        piece, alone = _Piece(conv, no), True
                    some = min(copies, most_copies)
                    piece.add(turn, role, text, some, fault, repeats)
                    copies, repeats = copies - some, True
                if size >= PIECE_CHARS:
                    yield _batch(rows, _PIECES, kind)
                    rows, size = [], 0
        if piece is not None:
            close(False)
        if rows:
            yield _batch(rows, _PIECES, kind)

    return run


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        syms, lens = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        made = [[x for line in matrix_of(s, n) for x in line] for s, n in zip(syms, lens)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(made, pa.list_(pa.int64()))], names=["conv_id", "part", "no", "matrix"]
        )


def _costs_to_go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a conversation from the back: costs to go behind each."""
    conv, open_, costs = None, False, END
    for batch in batches:
        ends, last = [], []
        for c, flat in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
            new = not open_ or c != conv
            conv, open_, costs = c, True, END if new else costs
            ends.append(list(costs))
            last.append(new)
            v = _apply(tuple(tuple(flat[4 * i : 4 * i + 4]) for i in STATES), costs)
            costs = tuple(x - min(v) for x in v)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:3], pa.array(ends, pa.list_(pa.int64())), pa.array(last)], names=["part", "no", "behind", "last"]
        )


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        syms, lens, ends = (batch.column(i).to_pylist() for i in (3, 4, 5))
        made = [exits(s, n, tuple(e)) for s, n, e in zip(syms, lens, ends)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], batch.column(5), batch.column(6), pa.array(made, pa.list_(pa.int32()))],
            names=["conv_id", "part", "no", "behind", "last", "exits"],
        )


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a conversation from the front: the state before each."""
    conv, open_, state = None, False, 0
    for batch in batches:
        entry = []
        for c, out in zip(batch.column(0).to_pylist(), batch.column(5).to_pylist()):
            state = 0 if not open_ or c != conv else state
            conv, open_ = c, True
            entry.append(state)
            state = out[state]
        yield pa.RecordBatch.from_arrays([*batch.columns[1:5], pa.array(entry, pa.int32())], names=["part", "no", "behind", "last", "entry"])


def _repaired(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                known = r["behind"] is not None
                end, state = (tuple(r["behind"]), r["entry"]) if known else (END, 0)
                r["last"] = r["last"] if known else True
                r["audit"], r["cost"], r["roles"], r["texts"] = unroll(
                    r["syms"], r["lens"], r["roles"], r["texts"], end, state, r["last"]
                )
            yield _batch(rows, _REPAIRED, kind)

    return run


def counted(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Distinct turns with their number of copies, their fault, and whether an equal turn stands before them."""
    named = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    same = F.sha2(F.concat_ws("\n", conv, F.length("role").cast("string"), "role", "text").cast("binary"), 256)
    at = F.coalesce("turn", F.lit(FIRST_TURN))
    firsts = named.groupBy(same.alias("_same")).agg(F.min(at).alias("_first"), F.max(at).alias("_last"), F.count("*").alias("n"))
    firsts = materialize(firsts.where("_first < _last").drop("_last"), "first-turns")
    rows = named.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    rows = rows.withColumns({"_same": same, "_at": at})
    rows = lookup(rows, firsts, ["_same"], {"_first": None}, row_id="_at")
    ending = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    fault = F.when(ending == "", "blank").when(~ending.isin(".", "!", "?"), "truncated")
    return rows.select(
        "conv_id", "turn", "role", "text", "copies", fault.alias("fault"),
        F.coalesce(F.col("_at") > F.col("_first"), F.lit(False)).alias("repeats"),
    )


def repair(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    piece_rows: int = PIECE_ROWS,
    piece_copies: int = PIECE_COPIES,
) -> DataFrame:
    """Pieces of repaired conversations.

    A row has the counts of its turns, its part of the audit, what the edits cost, and the repaired
    roles and texts.  Pieces of a conversation are ordered by (part, no); ``whole`` pieces are whole conversations.
    ``piece_rows`` and ``piece_copies`` bound a piece and do not change the result.
    """
    spark = turns.sparkSession
    prepare(spark)
    rows = counted(turns, conv_id, turn, role, text)
    kind = rows.schema["conv_id"].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    # Ranges are drawn on the head of role and text, rows are sorted by the whole of them.
    key = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first()]
    heads = [F.substring("role", 1, 50), F.substring("text", 1, 200)]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, *key, *heads).sortWithinPartitions(*key, "role", "text")
    pieces = materialize(ordered.mapInArrow(_cut(arrow, piece_rows, piece_copies), f"conv_id {kind}, {_PIECES}"), "pieces")

    open_ = pieces.where("NOT whole").select("conv_id", "part", "no", "syms", "lens")
    matrices = open_.select("conv_id", "part", "no", "syms", "lens").mapInArrow(
        _matrices, f"conv_id {kind}, part int, no int, matrix array<bigint>"
    )
    back = matrices.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("no"))
    behind = back.mapInArrow(_costs_to_go, "part int, no int, behind array<bigint>, last boolean")
    known = open_.join(behind, ["part", "no"]).select("conv_id", "part", "no", "syms", "lens", "behind", "last")
    mapped = known.mapInArrow(
        _exits, f"conv_id {kind}, part int, no int, behind array<bigint>, last boolean, exits array<int>"
    )
    front = mapped.repartition("conv_id").sortWithinPartitions("conv_id", "part", "no")
    entries = materialize(front.mapInArrow(_entries, "part int, no int, behind array<bigint>, last boolean, entry int"), "entries")
    ready = pieces.join(entries, ["part", "no"], "left").select(*pieces.columns, "behind", "last", "entry")
    return ready.mapInArrow(_repaired(arrow), f"conv_id {kind}, {_REPAIRED}")
