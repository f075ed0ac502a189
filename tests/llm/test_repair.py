"""Conversation repair against uniform-cost search, row by row, on every short conversation and on awkward ones."""

from __future__ import annotations

import heapq
import random
import re
from itertools import product

import pytest

from telescale.llm import repair
from tests.llm import plain

TURN = {0: 2, 1: 2, 2: 3, 3: 2}
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}


def cheapest(letters):
    """Least (cost, audit) by taking prefixes off a queue in that order."""
    queue, seen = [(0, "", 0, 0)], set()
    while True:
        cost, audit, i, place = heapq.heappop(queue)
        if i == len(letters) and place in (0, 3):
            return cost, audit
        if (i, place) in seen:
            continue
        seen.add((i, place))
        heapq.heappush(queue, (cost + 2, audit + "I", i, TURN[place]))
        if i < len(letters):
            x = letters[i]
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, place))
            if x != "d":
                if (x.lower(), place) in KEPT:
                    heapq.heappush(queue, (cost + x.isupper(), audit + "K", i + 1, KEPT[x.lower(), place]))
                heapq.heappush(queue, (cost + 2 + x.isupper(), audit + "R", i + 1, TURN[place]))


def plain_repair(rows, ids):
    """conv_id -> the row of the operator, from rows (conv_id, turn, role, text)."""
    out = {}
    for conv in ids:
        mine = [(t is not None, t or 0, r or " ", plain.sha(" " if x is None else x), t, " " if x is None else x)
                for c, t, r, x in rows if c == conv]
        mine = [(t, r, x) for _, _, r, _, t, x in sorted(mine, key=lambda m: m[:4])]
        faults, letters, seen = {"blank": 0, "duplicate": 0, "truncated": 0}, "", set()
        for _, role, text in mine:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            letters += initial if fault is None else initial.upper() if fault == "truncated" else "d"
            if fault:
                faults[fault] += 1
        initials = [r[:1] for _, r, _ in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = [t for t, _, _ in mine if t is not None]
        cost, audit = cheapest(letters)
        lines, place, left = [], 0, iter(mine)
        for edit in audit:
            role, text = (None, "") if edit == "I" else next(left)[1:]
            if edit == "K":
                place = KEPT[role[:1], place]
            elif edit in "IR":
                place = TURN[place]
                role = "user" if place == 2 else "assistant"
            if edit != "D":
                lines.append(f"{role}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *faults.values(), illegal, cost, audit, plain.sha("\n".join(lines)))
    return out


def test_every_short_conversation():
    for n in range(5):
        for letters in map("".join, product("dsuaxSUAX", repeat=n)):
            assert repair.solve(letters) == cheapest(letters), letters


@pytest.mark.parametrize("alphabet", ["dsuaxSUAX", "ua", "u", "a", "s", "d", "x", "uuuaaaasd", "uA"])
def test_long_conversations(alphabet):
    """Conversations of several pieces, and of several blocks."""
    rng = random.Random(alphabet)
    for n in (15, 16, 17, 33, 150):
        letters = "".join(rng.choices(alphabet, k=n))
        assert repair.solve(letters) == cheapest(letters), letters
    blocks = [letters[i:i + 40] for i in range(0, 150, 40)]
    tables = [repair.table_of(b, k == len(blocks) - 1) for k, b in enumerate(blocks)]
    assert repair.chain(tables, repair.START, repair.DONE) == cheapest(letters)


def test_bounds_never_exceed_the_cost():
    rng = random.Random(5)
    for _ in range(300):
        letters = "".join(rng.choices("dsuaxSUAX", k=rng.randint(0, 12)))
        assert repair.lower_bounds(letters)[0] <= cheapest(letters)[0]


def conversations(spark, rows):
    schema = "conv_id long, turn long, role string, text string, tree string, place string, said string, letter string"
    return spark.createDataFrame([(*r, *("x" * 4)) for r in rows], schema)


ODD = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes!"), (2, 0, "assistant", "Me?"), (3, 5, "user", None), (3, None, None, "x."),
    (4, 0, "system", "S."), (4, 0, "system", "S."), (4, 3, "user", "cut off"), (4, 3, "User", "Odd."), (None, 1, "user", "Q?"),
    (None, None, "assistant", "A."), (None, 2, "assistant", " \t\n\x0b"), (5, 1, "", "No role."), (5, 2, "user", "é ü."),
    (6, 0, "user", "long words. " * 100_000), (6, 1, "tool", "end"), (7, None, "user", "."), (7, None, "user", "."),
]


def hot(n):
    rng = random.Random(n)
    return [(9, rng.randint(0, n // 2), rng.choice(["user", "assistant", "system", "tool"]),
             rng.choice(["Same.", "cut", "", f"Text {rng.random()}."])) for _ in range(n)]


@pytest.mark.parametrize("block", [7, repair.BLOCK])
@pytest.mark.parametrize("damage", [False, True])
def test_repair(spark, block, damage):
    rows = ODD + hot(60)
    table = conversations(spark, rows)
    used = repair.damaged(table) if damage else table
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair(used, table, block).collect()}
    seen = [(r.conv_id, r.turn, r.role, r.text) for r in used.collect()]
    assert got == plain_repair(seen, {r[0] for r in rows})
    assert all(re.fullmatch("[DIKR]*", r[-2]) for r in got.values())


def test_turns_of_a_repair(spark):
    rows = repair.damaged(conversations(spark, [])).union(conversations(spark, ODD[:2] + [(2, 0, "assistant", "Me?")]).select(
        "conv_id", "turn", "role", "text"))
    marked = repair.lettered(rows)
    turns = repair.repaired_turns(rows, marked, repair.solved(marked)).collect()
    said = sorted((r.tree, r.n, r.edit, r.role, r.text) for r in turns)
    assert said == [("c1", 0, "K", "user", "Hi."), ("c1", 1, "K", "assistant", "Yes!"), ("c2", 0, "I", "user", ""),
                    ("c2", 1, "K", "assistant", "Me?")]


def test_empty_conversations(spark):
    empty = conversations(spark, [])
    assert repair.repair(repair.damaged(empty), empty).collect() == []
    table = conversations(spark, [(1, 0, "user", "Hi.")])
    lost = repair.repair(empty, table).collect()
    assert [tuple(r) for r in lost] == [(1, 0, 0, 0, 0, 0, 0, "", plain.sha(""))]
