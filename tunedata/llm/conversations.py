"""Conversation structure repair by secondary-sorted streaming.

The rows of a conversation are to follow the order ``(s?(ua)+)?`` of role initials.
Cheapest edits (keep, rerole, delete, insert) are found by a dynamic programme over
the four states of that order.

Plan: one shuffle, by conversation; everything after it is sorted inside the
partitions, by Spark's external sort, so a conversation of any length is a stream
that spills, never a group in memory:

1. rows by turn, last first: ``mapInPandas`` carries the four costs from here to the
   end over the Arrow batches and puts the best edit in each state, two bits a state,
   on the row. This byte is the row's backpointer; the next sort spills it.
2. rows by turn, first first: ``mapInPandas`` follows the backpointers from the first
   state and feeds counts, audit and hash, one result row a conversation.

Because costs are counted from the end, the smallest letter among the cheapest edits
can be taken row by row, which gives the ASCII-least audit of all cheapest ones.

Defined cases: null roles and texts are one space, as are null parts of the key that
is hashed for the damage; rows without a turn come first; of equal turns the order is
that of role, then text; equal rows are separate rows, the later ones duplicates; a
null ``conv_id`` is a conversation of its own; a role without an initial, or with one
that is not s, u or a, is never kept as it is; a conversation without rows gives
zeros, an empty audit and the hash of nothing; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunedata.llm.common import python_ready

INF = 1 << 60
DELETE, INSERT, KEEP, RETITLE = range(4)  # in ASCII order of the letters
LETTERS = "DIKR"
# States: nothing yet, after the system row, after a user row, after an assistant row.
AFTER_USER_OR_ASSISTANT = (2, 2, 3, 2)  # what the state accepts next is user, user, assistant, user
ACCEPTS = ("su", "u", "a", "u")
ENDS = (0, 4, 2, 0)  # cost of the insertions that still end the order
SPEAKER = {2: "user", 3: "assistant"}
LAWFUL = {("s", "u"), ("u", "a"), ("a", "u")}
SPACE = r"[\x20\x09-\x0D]"
ROW = "conv string, none boolean, dropped boolean, turn bigint, timed boolean, role string, text string, fault string"


def step(later: tuple, initial: str, fault: str) -> tuple[tuple, int]:
    """Costs to the end before a row, from those behind it, and the row's backpointer."""
    gone = fault in ("blank", "duplicate")
    stays = 1 if fault == "truncated" else 0
    cost, move = [], []
    for s in range(4):
        options = [(later[s] + 3, DELETE)]
        if not gone:
            if initial and initial in ACCEPTS[s]:
                options.append((later[1 if initial == "s" else AFTER_USER_OR_ASSISTANT[s]] + stays, KEEP))
            options.append((later[AFTER_USER_OR_ASSISTANT[s]] + stays + 2, RETITLE))
        c, m = min(options)
        cost.append(c)
        move.append(m)
    for _ in range(3):  # no more than three insertions in a row lead to another state
        for s in range(4):
            c = cost[AFTER_USER_OR_ASSISTANT[s]] + 2
            if (c, INSERT) < (cost[s], move[s]):
                cost[s], move[s] = c, INSERT
    return tuple(cost), sum(m << 2 * s for s, m in enumerate(move))


def backpointers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds ``move`` to rows sorted by conversation, the last turn first."""
    known: dict = {}
    conv, low, costs = None, 0, ENDS
    for f in frames:
        moves = []
        for key, none, dropped, role, fault in zip(f["conv"], f["none"], f["dropped"], f["role"], f["fault"], strict=True):
            if (key, none) != conv:
                conv, costs = (key, none), ENDS
            if dropped:
                moves.append(0)
                continue
            # Costs matter by their differences only, and these take few values.
            low = min(costs)
            at = (tuple(c - low for c in costs), role[:1], fault)
            if at not in known:
                if len(known) > 100_000:
                    known.clear()
                known[at] = step(*at)
            costs, move = known[at]
            moves.append(move)
        yield f.assign(move=moves)


class Conversation:
    """What is known of a conversation while its rows pass, the first turn first."""

    def __init__(self):
        self.state = self.cost = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.before = 0, None
        self.first = self.last = None
        self.turns = 0
        self.audit: list = []
        self.hash, self.empty = hashlib.sha256(), True

    def write(self, role: str, text: str) -> None:
        self.hash.update((("" if self.empty else "\n") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.empty = False

    def insert(self) -> None:
        self.state = AFTER_USER_OR_ASSISTANT[self.state]
        self.audit.append("I")
        self.cost += 2
        self.write(SPEAKER[self.state], "")

    def take(self, turn: int, timed: bool, role: str, text: str, fault: str, move: int) -> None:
        if timed:
            if self.first is None:
                self.first = turn
            self.turns += self.last is None or turn != self.last
            self.last = turn
        if fault:
            self.faults[fault] += 1
        if self.before is not None:
            self.illegal += (self.before, role[:1]) not in LAWFUL
        self.before = role[:1]
        while (m := move >> 2 * self.state & 3) == INSERT:
            self.insert()
        self.audit.append(LETTERS[m])
        if m == DELETE:
            self.cost += 3
            return
        self.cost += (fault == "truncated") + 2 * (m == RETITLE)
        self.state = 1 if m == KEEP and role[0] == "s" else AFTER_USER_OR_ASSISTANT[self.state]
        self.write(role if m == KEEP else SPEAKER[self.state], text)

    def row(self) -> dict:
        while ENDS[self.state]:
            self.insert()
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return {"gaps": min(gaps, (1 << 63) - 1), **self.faults, "illegal": self.illegal, "cost": self.cost,
                "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest()}


RESULT = ("conv string, none boolean, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "cost bigint, audit string, repaired_sha256 string")


def follow(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One result row a conversation, from rows with backpointers sorted by turn."""
    conv, now, out = None, None, []
    columns = ("conv", "none", "dropped", "turn", "timed", "role", "text", "fault", "move")
    names = [c.split()[0] for c in RESULT.split(", ")]
    for f in frames:
        for key, none, dropped, turn, timed, role, text, fault, move in zip(*(f[c] for c in columns), strict=True):
            if (key, none) != conv:
                if now is not None:
                    out.append({"conv": conv[0], "none": conv[1], **now.row()})
                conv, now = (key, none), Conversation()
            if not dropped:
                now.take(int(turn), timed, role, text, fault, int(move))
        if out:
            yield pd.DataFrame(out, columns=names)
            out = []
    if now is not None:
        yield pd.DataFrame([{"conv": conv[0], "none": conv[1], **now.row()}], columns=names)


def spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(rows: DataFrame, parts: int = 20) -> DataFrame:
    """``conv_id, turn, role, text, dropped``: by the key's checksum modulo ``parts``, a row is marked
    dropped (0), loses its text (1) or its sentence ends (2), is repeated (3) or becomes a user's (4)."""
    what = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % parts
    text = F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.regexp_replace(spaced("text"), "[.!?]", ""))
    return (rows.select("conv_id", "turn", "role", "text", what.alias("what"))
            .select("conv_id", "turn", F.when(F.col("what") == 4, "user").otherwise(spaced("role")).alias("role"),
                    text.otherwise(spaced("text")).alias("text"), (F.col("what") == 0).alias("dropped"),
                    F.explode(F.when(F.col("what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .drop("col"))


def repair(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every
    ``conv_id``. ``rows`` has ``conv_id, turn, role, text, dropped``; a dropped row only names its
    conversation."""
    python_ready(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    dropped = F.col("dropped")
    by_turn = [F.asc_nulls_first("at"), F.asc("role"), F.asc("text")]
    # The windows and sorts below need no other shuffle than this one.
    dealt = rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), F.col("conv_id").isNull().alias("none"),
        "dropped", F.when(~dropped, F.col("turn").cast("bigint")).alias("at"),
        F.when(dropped, "").otherwise(spaced("role")).alias("role"),
        F.when(dropped, "").otherwise(spaced("text")).alias("text")).repartition("conv", "none")
    same = Window.partitionBy("conv", "none", "dropped", "role", F.sha2("text", 256)).orderBy(*by_turn)
    ends = F.regexp_extract("text", rf"(?s)([^\x20\x09-\x0D]){SPACE}*\z", 1)
    judged = dealt.withColumn("copy", F.row_number().over(same)).withColumn("end", ends).select(
        "conv", "none", "dropped", F.coalesce("at", F.lit(0)).alias("turn"), F.col("at").isNotNull().alias("timed"),
        "role", "text", F.when(dropped, "").when(F.col("end") == "", "blank").when(F.col("copy") > 1, "duplicate")
        .when(~F.col("end").isin(".", "!", "?"), "truncated").otherwise("").alias("fault"))
    # Of equal rows the first one is no duplicate: it has the smallest fault text or an equal one.
    forward = ["conv", "none", "timed", "turn", "role", "text", F.asc(F.col("fault") == "duplicate")]
    backward = ["conv", "none", F.desc("timed"), F.desc("turn"), F.desc("role"), F.desc("text"),
                F.desc(F.col("fault") == "duplicate")]
    marked = judged.sortWithinPartitions(*backward).mapInPandas(backpointers, ROW + ", move int")
    found = marked.sortWithinPartitions(*forward).mapInPandas(follow, RESULT)
    return found.select(F.when(~F.col("none"), F.col("conv")).cast(kind).alias("conv_id"), "gaps", "blank", "duplicate",
                        "truncated", "illegal", "cost", "audit", "repaired_sha256")
