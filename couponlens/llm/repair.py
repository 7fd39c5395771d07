"""Repair of conversations to the grammar ``(s?(ua)+)?`` by Wagner-Fischer alignment with alternating target strings.

A conversation's turns in order are cut into pieces of ``PIECE`` turns. A piece is aligned with every feasible length of
the alternating string that may stand there, for each state of the grammar in which it may begin; Ukkonen bands keep to
the cells that can still reach the cost of the best alignment so far. Of all lengths that end in one state, the cheapest
stays, and of equally cheap ones the one whose backtraced audit is least. Pieces are then put together in order: states
carry their cost and the part of their audit in which they still differ, so a conversation of any length passes through
a task as a stream, and its alignment was spread over the cluster.
"""

from __future__ import annotations

import hashlib
import os.path

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from couponlens.llm.common import partitions, rows, stored

PIECE = 32
KEEP, REROLE, DELETE, INSERT, OPEN = 0, 2, 3, 2, 1  # OPEN: a turn that is cut short stays
_NAMES = {"u": "user", "a": "assistant"}
# states of the grammar: nothing yet, after a system turn, a user turn is due, an assistant turn is due
START, SYSTEM, USER, ASSISTANT = range(4)
_BLANKS = " \t\n\x0b\x0c\r"
_FAR = 1 << 60


def damage(rows_: DataFrame, keys: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text")) -> DataFrame:
    """Damaged conversations for trials: conv_id, turn, role, text after one of five faults, or none, chosen by the CRC-32 of
    ``conv_id:turn`` modulo 20, with nulls as one space. 0 drops the row, 1 empties its text, 2 takes out ``[.!?]``,
    3 repeats the row, 4 makes it a user's."""
    conv, turn, role, text = (F.col(k) for k in keys)
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(x.cast("string"), space) for x in (conv, turn)])
    fault = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce(text.cast("string"), space), F.coalesce(role.cast("string"), space)
    text = F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text)
    copies = F.when(fault == 3, 2).when(fault == 0, 0).otherwise(1)
    chosen = rows_.select(
        conv.cast("long").alias("conv_id"), turn.cast("long").alias("turn"), F.when(fault == 4, "user").otherwise(role).alias("role"),
        text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"))
    return chosen.drop("copy")


def target(state: int, first: str, length: int) -> str:
    """The alternating string of a length that begins with ``first`` in a state of the grammar."""
    if first == "s":
        return "s" + target(USER, "u", length - 1)
    return ("ua" if first == "u" else "au") * (length // 2) + first * (length % 2)


def after(state: int, goal: str) -> int:
    """The state of the grammar behind a string that began in ``state``."""
    if not goal:
        return state
    return SYSTEM if goal == "s" else ASSISTANT if goal[-1] == "u" else USER


class Turns:
    """Initials and costs of a run of turns. ``must`` marks those that have to go, ``open_`` those that end too soon."""

    def __init__(self, initials: str, must: list[bool], open_: list[bool]) -> None:
        self.initials, self.must, self.open = initials, must, open_
        #: least and cost of letting the turns from i on go, and of the least that they cost in any case
        self.least = [0]
        for gone, cut in zip(reversed(must), reversed(open_)):
            self.least.append(self.least[-1] + (DELETE if gone else OPEN * cut))
        self.least.reverse()

    def align(self, goal: str, limit: int) -> tuple[int, str]:
        """Cost and least audit of the cheapest edits that turn the run into ``goal``, if no dearer than ``limit``; else a cost
        beyond it. Cells of the table are left out when the cost to reach them, what the turns left cost in any case and the
        deletions or insertions due to reach the last corner are more than the limit."""
        n, m = len(self.initials), len(goal)
        table: list[dict[int, int]] = [{} for _ in range(n + 1)]
        # from the last turn back, so that the audit can then be read from the first turn on
        for i in range(n, -1, -1):
            here, below = table[i], table[i + 1] if i < n else {}
            low, high = max(0, m - (n - i) - limit // INSERT), min(m, m - (n - i) + limit // DELETE)
            for j in range(high, low - 1, -1):
                if i == n and j == m:
                    here[j] = 0
                    continue
                best = _FAR
                if i < n:
                    best = below.get(j, _FAR) + DELETE
                    if j < m and not self.must[i]:
                        best = min(best, below.get(j + 1, _FAR) + self._change(i, goal[j]))
                if j < m and goal[j] != "s":
                    best = min(best, here.get(j + 1, _FAR) + INSERT)
                # in front of the cell, i turns have become j symbols
                before = self.least[0] - self.least[i] + max((j - i) * INSERT, 0)
                if best + max(before, (i - j) * DELETE) <= limit:
                    here[j] = best
        cost = table[0].get(0, _FAR)
        if cost > limit:
            return cost, ""
        audit, i, j = [], 0, 0
        while i < n or j < m:
            left = table[i][j]
            if i < n and table[i + 1].get(j, _FAR) + DELETE == left:
                audit.append("D")
                i += 1
            elif j < m and goal[j] != "s" and table[i].get(j + 1, _FAR) + INSERT == left:
                audit.append("I")
                j += 1
            else:
                audit.append("K" if self.initials[i] == goal[j] else "R")
                i, j = i + 1, j + 1
        return cost, "".join(audit)

    def _change(self, i: int, symbol: str) -> int:
        if self.initials[i] == symbol:
            return KEEP + OPEN * self.open[i]
        return _FAR if symbol == "s" else REROLE + OPEN * self.open[i]

    def best(self, state: int) -> dict[int, tuple[int, str]]:
        """By the state reached: cost and audit of the cheapest repair that begins in ``state``, the least audit of equals."""
        n, found = len(self.initials), {}
        firsts = {START: "us", SYSTEM: "u", USER: "u", ASSISTANT: "a"}[state]
        middle = n - sum(self.must)
        for length in sorted(range(2 * n + 3), key=lambda m: abs(m - middle)):
            for first in firsts if length else firsts[0]:
                goal = target(state, first, length)
                end = after(state, goal)
                limit = found[end][0] if end in found else n * (DELETE + OPEN) + INSERT * length
                # turns that have to go beyond the surplus leave room that insertions fill
                if self.least[0] + INSERT * max(0, length - middle) > limit or DELETE * (n - length) > limit:
                    continue
                got = self.align(goal, limit)
                if got[0] <= limit and (end not in found or got < found[end]):
                    found[end] = got
        return found


def _row_faults(role: str, text: str, seen: bool) -> str:
    """The first fault of a turn: b(lank), d(uplicate), t(runcated) or none."""
    body = text.rstrip(_BLANKS)
    return "b" if not body else "d" if seen else "t" if body[-1] not in ".!?" else "-"


_PIECE = "conv_id long, part int, nth long, roles array<string>, texts array<string>, faults string, best array<struct<start:int,stop:int,cost:long,audit:string>>"


def _pieces(batches):
    """Task: sorted turns (conv_id, turn, role, text, first) to pieces with their repairs. ``first`` tells that no turn of the
    same role and text has a smaller number; equal rows follow each other."""
    part, nth = TaskContext.get().partitionId(), 0
    last, held = None, []
    begins = False  # whether the piece is known to be its conversation's first; a task's first one may go on from another task

    def piece():
        roles, texts, faults = zip(*held)
        turns = Turns("".join(r[:1] or " " for r in roles), [f in "bd" for f in faults], [f == "t" for f in faults])
        best = [
            {"start": start, "stop": stop, "cost": cost, "audit": audit}
            for start in ((START,) if begins else (START, SYSTEM, USER, ASSISTANT)) for stop, (cost, audit) in turns.best(start).items()]
        return {"conv_id": last[0], "part": part, "nth": nth, "roles": list(roles), "texts": list(texts), "faults": "".join(faults), "best": best}

    schema = pa.schema([
        ("conv_id", pa.int64()), ("part", pa.int32()), ("nth", pa.int64()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("faults", pa.string()),
        ("best", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))])
    for batch in batches:
        out = []
        for conv, turn, role, text, first in zip(*(batch.column(i).to_pylist() for i in range(5))):
            now = (conv, turn, role, text)
            if held and (conv != last[0] or len(held) == PIECE):
                out.append(piece())
                nth, held, begins = nth + 1, [], conv != last[0]
            held.append((role, text, _row_faults(role, text, not first or now == last)))
            last = now
        yield pa.RecordBatch.from_pylist(out, schema)
    if held:
        yield pa.RecordBatch.from_pylist([piece()], schema)


class _Stream:
    """A conversation while its pieces pass: costs and audits of the grammar's states, and the text that is settled."""

    def __init__(self) -> None:
        self.states: dict[int, tuple[int, str]] = {START: (0, "")}
        self.audit: list[str] = []
        self.turns: list[tuple[str, str]] = []  # not settled yet
        self.faults = {f: 0 for f in "bdt-"}
        self.illegal, self.initial = 0, None
        self.sha, self.written, self.due = hashlib.sha256(), False, "u"

    def add(self, roles: list[str], texts: list[str], faults: str, best: list[dict]) -> None:
        reached: dict[int, tuple[int, str]] = {}
        for x in best:
            if x["start"] in self.states:
                cost, audit = self.states[x["start"]]
                now = cost + x["cost"], audit + x["audit"]
                if x["stop"] not in reached or now < reached[x["stop"]]:
                    reached[x["stop"]] = now
        self.states = reached
        for f in faults:
            self.faults[f] += 1
        for role in roles:
            self.illegal += self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au")
            self.initial = role[:1]
        self.turns += zip(roles, texts)
        self._settle(os.path.commonprefix([audit for _, audit in reached.values()]))

    def _settle(self, audit: str) -> None:
        """Applies edits that all states share to the first turns that are left."""
        self.audit.append(audit)
        self.states = {k: (cost, rest[len(audit) :]) for k, (cost, rest) in self.states.items()}
        at = 0
        for edit in audit:
            if edit == "I":
                role, text = _NAMES[self.due], ""
            else:
                role, text = self.turns[at]
                at += 1
                if edit == "D":
                    continue
                if edit == "R":
                    role = _NAMES[self.due]
            self.sha.update((("\n" if self.written else "") + f"{role}:{text}").encode("utf-8", "replace"))
            self.written, self.due = True, "a" if role[:1] == "u" else "u"
        del self.turns[:at]

    def result(self) -> dict:
        cost, audit = min(self.states[k] for k in (START, USER) if k in self.states)
        self._settle(audit)
        return {
            "blank": self.faults["b"], "duplicate": self.faults["d"], "truncated": self.faults["t"], "illegal": self.illegal, "cost": cost,
            "audit": "".join(self.audit), "repaired_sha256": self.sha.hexdigest()}


_RESULT = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _streamed(batches):
    """Task: pieces ordered by (conv_id, part, nth) to one row per conversation."""
    stream, conv = None, None
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if stream is None or row["conv_id"] != conv:
                if stream is not None:
                    out.append({"conv_id": conv, **stream.result()})
                stream, conv = _Stream(), row["conv_id"]
            stream.add(row["roles"], row["texts"], row["faults"], row["best"])
        yield pa.RecordBatch.from_pylist(out, schema)
    if stream is not None:
        yield pa.RecordBatch.from_pylist([{"conv_id": conv, **stream.result()}], schema)


def repair(turns: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """Repairs conversations (conv_id, turn, role, text) and returns for each: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256.

    Turns stand by number, nulls first, equal numbers by role and text; null roles and texts become one space, null ids are
    one conversation. Conversations of ``originals`` without a turn left get zeros, an empty audit and the hash of nothing.
    """
    space = F.lit(" ")
    turns = stored(turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), *[F.coalesce(F.col(c).cast("string"), space).alias(c) for c in ("role", "text")]), "turns")
    same = {"conv_id": "c", "role": "r", "text": "t"}
    firsts = turns.groupBy(*[F.col(c).alias(k) for c, k in same.items()]).agg(F.min("turn").alias("lowest"), F.max(F.col("turn").isNull()).alias("unnumbered"))
    meets = [F.col(c).eqNullSafe(F.col(k)) for c, k in same.items()]
    first = F.when(F.col("unnumbered"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("lowest"))
    marked = turns.join(firsts, meets).select("conv_id", "turn", "role", "text", first.alias("first"))
    order = ["conv_id", "turn", "role", "text"]
    dealt = stored(marked, "marked").repartitionByRange(partitions(turns.sparkSession), *order).sortWithinPartitions(*order)
    pieces = stored(dealt.mapInArrow(_pieces, _PIECE), "pieces")
    repaired = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "nth").mapInArrow(_streamed, _RESULT)

    gaps = turns.groupBy(F.col("conv_id").alias("of")).agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    named = (turns if originals is None else originals).select(F.col("conv_id").cast("long").alias("id")).distinct()
    out = named.join(gaps, F.col("id").eqNullSafe(F.col("of")), "left")
    out = out.join(repaired, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    texts = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")]
    return out.select(F.col("id").alias("conv_id"), *counts, *texts)
