import hashlib
import itertools
import random
import re
import zlib

import pytest

from tests.llm.conftest import SF, needs_tables
from tunedata.llm import conversations

WS = " \t\n\v\f\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        k = zlib.crc32(key.encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        end = text.rstrip(WS)[-1:]
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else "")
        seen.add((role, text))
    return out


def all_edits(rows, found):
    """Every way to edit a few rows, with up to two insertions in each place."""
    gaps = ["", "u", "a", "ua", "au"]
    speaker = {"u": "user", "a": "assistant"}
    for moves in itertools.product(*[["D"] if f in ("blank", "duplicate") else ["D", "K", "u", "a"] for f in found]):
        for ins in itertools.product(gaps, repeat=len(rows) + 1):
            audit, order, lines, cost = "", [], [], 0
            for n in range(len(rows) + 1):
                for x in ins[n]:
                    audit, cost = audit + "I", cost + 2
                    order.append(x)
                    lines.append(speaker[x] + ":")
                if n < len(rows):
                    m, (_, role, text) = moves[n], rows[n]
                    audit += m if m in "DK" else "R"
                    if m == "D":
                        cost += 3
                        continue
                    cost += (found[n] == "truncated") + 2 * (m != "K")
                    role = role if m == "K" else speaker[m]
                    order.append(role[:1] or "?")
                    lines.append(f"{role}:{text}")
            if re.fullmatch("(s?(ua)+)?", "".join(order)):
                yield cost, audit, "\n".join(lines)


def brute(rows):
    rows = damage(rows)
    found = faults(rows)
    cost, audit, text = min(all_edits(rows, found))
    turns = {r[0] for r in rows if r[0] is not None}
    initials = [r[1][:1] for r in rows]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, found.count("blank"), found.count("duplicate"),
            found.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
            cost, audit, hashlib.sha256(text.encode()).hexdigest())


@pytest.fixture(scope="module")
def small(spark):
    rng = random.Random(5)
    rows = []
    for conv in [None, *range(60)]:
        for _ in range(rng.randint(1, 3)):
            rows.append((conv, rng.choice([None, 0, 1, 1, 2, 5]),
                         rng.choice(["user", "assistant", "system", "tool", None, "", "User"]),
                         rng.choice(["Hello.", "Hello.", "no end", " \n", "", None, "end!\n ", "Mid. word", " "])))
    frame = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)],
                                  "conv_id bigint, turn bigint, role string, text string, fault int, move string")
    return rows, {r["conv_id"]: tuple(r)[1:] for r in conversations.repair(conversations.damaged(frame)).collect()}


def test_every_edit_of_small_conversations(small):
    rows, found = small
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    assert set(by) == set(found)
    for conv, own in by.items():
        if len(damage(own)) <= 3:
            assert found[conv] == brute(own), conv


def test_conversation_without_rows_and_empty_table(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id bigint, turn bigint, role string, text string")
    row = conversations.repair(conversations.damaged(frame)).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert conversations.repair(conversations.damaged(frame.limit(0))).count() == 0


def test_giant_conversation_over_many_batches(spark):
    """Edits over thousands of rows, in any order of input, give a lawful order at the cheapest cost."""
    rng = random.Random(1)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant", "tool"]), f"Turn {t % 3000}" + rng.choice(".?  ,"))
            for t in range(6000)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    frame = spark.createDataFrame(shuffled, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    got = conversations.repair(conversations.damaged(frame)).first()
    hurt = damage(rows)
    found = faults(hurt)
    best = [0, conversations.INF, conversations.INF, conversations.INF]  # forwards, unlike the operator
    nxt = (2, 2, 3, 2)

    def insert(v):
        for _ in range(3):
            for s in range(4):
                v[nxt[s]] = min(v[nxt[s]], v[s] + 2)
        return v

    best = insert(best)
    for (_, role, _), f in zip(hurt, found, strict=True):
        new = [v + 3 for v in best]
        if f not in ("blank", "duplicate"):
            for s, v in enumerate(best):
                extra = f == "truncated"
                new[nxt[s]] = min(new[nxt[s]], v + 2 + extra)
                if role[:1] and role[0] in ("su", "u", "a", "u")[s]:
                    to = 1 if role[0] == "s" else nxt[s]
                    new[to] = min(new[to], v + extra)
        best = insert(new)
    assert got["cost"] == min(best[0], best[3])
    state, at, cost, digest = 0, 0, 0, []
    for m in got["audit"]:
        if m == "I":
            state, cost = nxt[state], cost + 2
            digest.append("user:" if state == 2 else "assistant:")
            continue
        (_, role, text), f = hurt[at], found[at]
        at += 1
        if m == "D":
            cost += 3
            continue
        assert f not in ("blank", "duplicate")
        if m == "K":
            assert role[0] in ("su", "u", "a", "u")[state]
        state = 1 if m == "K" and role[0] == "s" else nxt[state]
        cost += (f == "truncated") + 2 * (m == "R")
        digest.append(f"{role if m == 'K' else {2: 'user', 3: 'assistant'}[state]}:{text}")
    assert at == len(hurt) and state in (0, 3) and cost == got["cost"]
    assert hashlib.sha256("\n".join(digest).encode()).hexdigest() == got["repaired_sha256"]


@needs_tables
def test_one_shuffle(spark):
    rows = conversations.damaged(spark.read.parquet(f"{SF}/conversations.parquet"))
    plan = conversations.repair(rows)._jdf.queryExecution().optimizedPlan().toString()
    physical = conversations.repair(rows)._jdf.queryExecution().sparkPlan().toString()
    assert "MapInPandas" in plan and physical.count("Exchange") <= 1
    executed = conversations.repair(rows)._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 1
