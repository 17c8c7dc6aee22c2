"""Conversation repair against a search over all edits, and odd rows."""

import hashlib
import heapq
import random
import re
import zlib
from itertools import count

import pytest

from logloom.llm import repair
from logloom.llm.queries_structure import damaged, op11_structure_repair, repaired_conversations, report

SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, part string"
LAST = re.compile(r"[.!?][\x20\x09-\x0D]*\Z")
WORD = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    """Rows of one conversation in order, each with its first fault."""
    seen, out = set(), []
    for turn, role, text in rows:
        fault = None
        if not WORD.search(text):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif not LAST.search(text):
            fault = "truncated"
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


# What may follow a kept turn.
AFTER = {"": "su", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """(cost, audit, lines) by a search in the order of cost, then letters."""
    open_, done, order = [(0, "", 0, 0, "", None)], set(), count()
    while open_:
        cost, audit, _, at, state, lines = heapq.heappop(open_)
        if at == len(rows) and state in ("", "a"):
            out = []
            while lines:
                lines, line = lines
                out.append(line)
            return cost, audit, out[::-1]
        if (at, state) in done:
            continue
        done.add((at, state))

        def push(more, letter, to, initial, line):
            if initial and initial in AFTER[state]:
                heapq.heappush(open_, (cost + more, audit + letter, next(order), to, initial, (lines, line)))

        for given in ("user", "assistant"):
            push(2, "I", at, given[0], f"{given}:")
        if at < len(rows):
            turn, role, text, fault = rows[at]
            heapq.heappush(open_, (cost + 3, audit + "D", next(order), at + 1, state, lines))
            if fault in (None, "truncated"):
                fee = int(fault == "truncated")
                push(fee, "K", at + 1, role[:1], f"{role}:{text}")
                for given in ("user", "assistant"):
                    push(2 + fee, "R", at + 1, given[0], f"{given}:{text}")


def plain(rows):
    """The report of one conversation of (turn, role, text)."""
    rows = faults(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    by_fault = [sum(r[3] == f for r in rows) for f in ("blank", "duplicate", "truncated")]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = cheapest(rows)
    return (gaps, *by_fault, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def by_conversation(rows):
    out = {}
    for conv, turn, role, text, *_ in rows:
        out.setdefault(conv, []).append((turn, role or "", text or ""))
    return out


def damage(conv, turn, role, text):
    sp = lambda x: " " if x is None else x
    n = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
    role, text = "user" if n == 4 else sp(role), "" if n == 1 else sp(text)
    text = re.sub("[.!?]", "", text) if n == 2 else text
    return [] if n == 0 else [(turn, role, text)] * (2 if n == 3 else 1)


def random_rows(n_conv, longest, seed):
    rng = random.Random(seed)
    roles = ["user"] * 4 + ["assistant"] * 4 + ["system", "tool", "", None, "User", "service"]
    texts = ["Yes.", "No!", "Why?", "open", " ", "", None, "Long text. " * 3, "Ü?\n\t", "cut off,"] + [f"Line {i}." for i in range(20)]
    rows = []
    for conv in range(n_conv):
        for t in range(rng.randrange(longest + 1)):
            rows.append((None if conv == 3 else conv, rng.choice([t, t, t, t + 2, None]), rng.choice(roles), rng.choice(texts), "x", "y"))
    return rows + rows[:5] + rows[:5]


@pytest.mark.parametrize("piece_rows", [2000, 3])
def test_random_conversations(spark, piece_rows):
    """Whole conversations and, with small pieces, conversations over many of them."""
    rows = random_rows(60, 12, 5)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r[0]: tuple(r)[1:] for r in report(repair.repair(frame, piece_rows=piece_rows)).collect()}
    want = {c: plain(r) for c, r in by_conversation(rows).items()}
    assert got == want


def test_damage_and_missing_conversations(spark):
    rows = random_rows(50, 6, 9) + [(c, 0, "user", "Hi.", None, None) for c in range(100, 160)]
    got = {r.conv_id: tuple(r)[1:] for r in repaired_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {}
    for conv, turn, role, text, *_ in rows:
        want.setdefault(conv, []).extend(damage(conv, turn, role, text))
    assert got == {c: plain(r) for c, r in want.items()}
    assert any(not r for r in want.values())


def test_one_conversation_with_most_rows(spark):
    """A long conversation is spread over pieces and partitions, and equal rows over none."""
    rng = random.Random(1)
    rows = [(1, i, rng.choice(["user", "assistant"]), f"Text {rng.randrange(300)}{rng.choice(['.', ''])}") for i in range(1500)]
    rows += [(1, 700, "user", "Again.")] * 400 + [(2, 0, "user", "Hi."), (0, 0, "assistant", "Hm.")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    pieces = repair.repair(frame, piece_rows=50, piece_copies=70)
    assert pieces.where("conv_id = 1").count() > 20
    got = {r[0]: tuple(r)[1:] for r in report(pieces).collect()}
    assert got == {c: plain(r) for c, r in by_conversation(rows).items()}


def test_very_long_text_and_empty_table(spark):
    rows = [(1, 0, "user", "word " * 200_000), (1, 1, "assistant", "x" * 1_000_000 + ".")]
    schema = "conv_id bigint, turn bigint, role string, text string"
    got = {r[0]: tuple(r)[1:] for r in report(repair.repair(spark.createDataFrame(rows, schema))).collect()}
    assert got == {1: plain([r[1:] for r in rows])}
    assert repaired_conversations(spark.createDataFrame([], schema)).count() == 0


def test_powers_match_single_steps():
    rng = random.Random(4)
    for sym in range(9):
        for n in (1, 2, 7, 64, 1000):
            costs = tuple(rng.randrange(6) for _ in range(4))
            v = repair._apply(repair._INSERTS, costs)
            step, total = v, 0
            for _ in range(n):
                step, least = repair.before(sym, 1, step)
                total += least
            assert repair.before(sym, n, v) == (step, total)


def test_given_conversations(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    want = {}
    for r in rows:
        want.setdefault(r.conv_id, []).extend(damage(r.conv_id, r.turn, r.role, r.text))
    got = {r.conv_id: tuple(r)[1:] for r in op11_structure_repair(spark, sf).collect()}
    assert got == {c: plain(r) for c, r in want.items()}
    assert damaged(spark.read.parquet(f"{sf}/conversations.parquet")).count() == sum(map(len, want.values()))
