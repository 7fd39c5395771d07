"""Conversation repair against a plain search through the grammar."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from couponlens.llm import queries, repair

STEPS = {"": {"u": "a", "s": "s"}, "s": {"u": "a"}, "u": {"u": "a"}, "a": {"a": "u"}}  # state, symbol, next state; u: a user is due
NAMES = {"u": "user", "a": "assistant"}


def plain(turns):
    """All counts, cost, audit and hash of one conversation (role, text) in order, without target strings."""
    seen, faults = set(), []
    for role, text in turns:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[:1] for r, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))

    def better(states, state, new):
        if state not in states or new[:2] < states[state][:2]:
            states[state] = new

    def inserted(states):
        for _ in range(4):
            for state, (cost, audit, out) in list(states.items()):
                for symbol, to in STEPS[state].items():
                    if symbol != "s":
                        better(states, to, (cost + 2, audit + "I", [*out, NAMES[symbol] + ":"]))
        return states

    states = inserted({"": (0, "", [])})
    for (role, text), fault in zip(turns, faults):
        new = {}
        for state, (cost, audit, out) in states.items():
            better(new, state, (cost + 3, audit + "D", out))
            for symbol, to in STEPS[state].items() if fault not in ("b", "d") else ():
                if symbol == role[:1]:
                    better(new, to, (cost + (fault == "t"), audit + "K", [*out, f"{role}:{text}"]))
                if symbol != "s":
                    better(new, to, (cost + 2 + (fault == "t"), audit + "R", [*out, f"{NAMES[symbol]}:{text}"]))
        states = inserted(new)
    cost, audit, out = min((states[s] for s in ("", "u") if s in states), key=lambda x: x[:2])
    return (faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def whole(rows, faulty):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv]
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if faulty else 9
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        held[conv] += [(turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    out = {}
    for conv, turns in held.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        known = [t for t, _, _ in turns if t is not None]
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, *plain([x[1:] for x in turns]))
    return out


def rows_of(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


@pytest.fixture(scope="module")
def odd():
    rnd = random.Random(9)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rnd.choice([1, 2, 5, 9, 40, 90])):
            turn = rnd.choice([turn, turn, turn, turn - 3, turn + 2, None])
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ubu"])
            rows.append((conv, turn, role, rnd.choice(["a.", "b!", "c", "d? ", "", " \n", None, f"t{rnd.random()}.", f"t{rnd.random()}", "é\x85", "x" * 5000 + "."])))
    return rows + [(77, 0, "user", "dropped"), *[(78, 1, "user", "again.")] * 70]


@pytest.mark.parametrize("piece", [32, 3])
@pytest.mark.parametrize("faulty", [True, False])
def test_repair(spark, odd, piece, faulty, monkeypatch):
    monkeypatch.setattr(repair, "PIECE", piece)
    pieces = repair._pieces

    def small(batches):  # the workers import the module anew
        repair.PIECE = piece
        yield from pieces(batches)

    monkeypatch.setattr(repair, "_pieces", small)
    table = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in odd], "conv_id long, turn long, role string, text string, part long, first string, copy long, audit string").repartition(5)
    got = repair.repair(repair.damage(table), table) if faulty else repair.repair(table)
    assert rows_of(got) == whole(odd, faulty)


def test_every_turn_gone_and_empty_table(spark):
    table = spark.createDataFrame([(k, 0, "user", "x.") for k in range(200)], "conv_id long, turn long, role string, text string")
    gone = [r for r in repair.repair(repair.damage(table), table).collect() if r.conv_id in {k for k in range(200) if zlib.crc32(f"{k}:0".encode()) % 20 == 0}]
    assert gone and {tuple(r)[1:] for r in gone} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert repair.repair(repair.damage(table.limit(0)), table.limit(0)).count() == 0


def test_alignment_keeps_to_its_limit():
    turns = repair.Turns("uuaa", [False] * 4, [False] * 4)
    cost, audit = turns.align("ua", 100)
    assert (cost, audit) == (6, "DKDK") and turns.align("ua", 6) == (6, "DKDK") and turns.align("ua", 5)[0] > 5
    assert turns.best(repair.START)[repair.USER] == min((turns.align(g, 100) for g in ("ua", "uaua", "uauaua")))


def test_registered_query(spark, data):
    found = spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert rows_of(queries.QUERIES["op11_repair"](spark, data)) == whole([tuple(r) for r in found], True)
