"""Repairs against all edits of short conversations, and against a plain dynamic program."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluicework.llm import conversations as cv
from sluicework.llm.queries import QUERIES

LEGAL = re.compile("(s?(ua)+)?")


def every_edit(rows):
    """(cost, audit, repaired turns) of the cheapest repair, among all edits with at most two turns made up at once."""
    best = None
    for letters in itertools.product("KRD", repeat=len(rows)):
        if any(r[2] and e != "D" for r, e in zip(rows, letters)):
            continue
        for inserts in itertools.product(range(3), repeat=len(rows) + 1):
            cost = sum({"K": 0, "R": 1, "D": 2}[e] + 5 * (r[3] and e != "D") for r, e in zip(rows, letters)) + 5 * sum(inserts)
            audit = "".join("I" * n + e for n, e in zip(inserts, [*letters, ""]))
            if best and (cost, audit) >= best[:2]:
                continue
            out, free = [], []
            for n, row, e in zip(inserts, [*rows, None], [*letters, ""]):
                out += [("?", "")] * n
                if e in ("K", "R"):
                    out.append((row[0] if e == "K" else "?", row[1]))
            free = [i for i, (role, _) in enumerate(out) if role == "?"]
            for roles in itertools.product(("user", "assistant"), repeat=len(free)):
                full = list(out)
                for i, role in zip(free, roles):
                    full[i] = (role, full[i][1])
                if LEGAL.fullmatch("".join(r[0] for r, _ in full)):
                    best = (cost, audit, full)
                    break
    return best


def chart(rows):
    c = cv.Chart()
    out = [x for r in rows for x in c.add(*r)] + list(c.end())
    return c.cost, "".join(c.audit), [(role, text) for role, text, edit in out if edit != "D"]


ROWS = st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "s", "u2"]), st.just("t"), st.booleans(), st.booleans()).map(lambda r: (*r[:2], r[2], r[3] and not r[2]))


@settings(max_examples=250, deadline=None)
@given(st.lists(ROWS, max_size=4))
def test_short_conversations(rows):
    assert chart(rows) == every_edit(rows)


def plain(rows):
    """The same by whole audits: a table of the least (cost, audit, repaired) for each role that stands last."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    def least(items):
        out = {}
        for head, cost, audit, done in items:
            if head not in out or (cost, audit) < out[head][:2]:
                out[head] = (cost, audit, done)
        return out

    def inserted(table):
        items = [(h, *x) for h, x in table.items()]
        for h, c, a, d in items:  # grows as it is read
            new = "a" if h == "u" else "u"
            if len(d) < 400 and a.count("I") - table.get("", (0, "", ()))[1].count("I") < 6 and not a.endswith("III"):
                items.append((new, c + 5, a + "I", (*d, (cv.ROLES[new], ""))))
        return items

    table = {"": (0, "", ())}
    for role, text, gone, cut in rows:
        items = []
        for h, c, a, d in inserted(table):
            items.append((h, c + 2, a + "D", d))
            if not gone:
                if role[:1] in follow[h] and role:
                    items.append((role[:1], c + 5 * cut, a + "K", (*d, (role, text))))
                new = "a" if h == "u" else "u"
                items.append((new, c + 1 + 5 * cut, a + "R", (*d, (cv.ROLES[new], text))))
        table = least(items)
    ends = least([x for x in inserted(table) if x[0] in ("", "a")])
    cost, audit, done = min(ends.values(), key=lambda x: x[:2])
    return cost, audit, list(done)


@pytest.mark.parametrize("seed", range(12))
def test_long_conversations_settle_early(seed):
    rng = random.Random(seed)
    roles = ["user", "assistant"] * 40 if seed % 3 else ["system", "user", "assistant", "tool"]
    rows = []
    for i in range(90):
        gone = rng.random() < 0.15
        rows.append((roles[i % len(roles)] if rng.random() < 0.8 else rng.choice(["system", "user", "assistant", "x"]), str(i), gone, not gone and rng.random() < 0.2))
    assert chart(rows) == plain(rows)


def test_columns_are_few():
    cv.step.cache_clear()
    rng = random.Random(1)
    c = cv.Chart()
    for i in range(200_000):
        gone = rng.random() < 0.2
        list(c.add(rng.choice(["system", "user", "assistant", "tool"]), "", gone, not gone and rng.random() < 0.3))
        assert len(c.backs) < 10 * cv.HELD
    assert cv.step.cache_info().currsize < 5000


def by_hand(turns):
    """The contract's row of each conversation, one conversation after another."""
    out, damaged = {}, {}
    for conv, turn, role, text in turns:
        role, text = role if role is not None else " ", text if text is not None else " "
        damaged.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        damaged[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, rows in damaged.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        known = [r[0] for r in rows if r[0] is not None]
        seen, faults, given = set(), [0, 0, 0], []
        for _, role, text in rows:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else 3
            if fault < 3:
                faults[fault] += 1
            seen.add((role, text))
            given.append((role, text, fault < 2, fault == 2))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit, done = plain(given)
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, *faults, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest())
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_query(spark, sf_dir):
    turns = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows = QUERIES["op12_conversation_repair"](spark, sf_dir).collect()
    assert len(rows) == len({t[0] for t in turns})
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows} == by_hand(turns)


def test_odd_turns(spark):
    rng = random.Random(3)
    turns = [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (1, None, "user", "x."), (1, None, None, None), (2, None, "s", "t"), (3, 0, "", ""), (3, 0, "", ""), (4, 1, "user", "same."), (4, 5, "user", "same."), (4, 9, "assistant", "é…")]
    turns += [(5, rng.randrange(200), rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["same.", "same", f"text {i}!", " \t", "ü?" * rng.randrange(3)])) for i in range(150)]
    turns += [(6 + i, t, "user", "gone.") for i in range(30) for t in range(1)]
    table = spark.createDataFrame([(*t, 7, "z") for t in turns], "conv_id long, turn long, role string, text string, cost long, _conv string")
    want = by_hand(turns)
    got = cv.repair(cv.damaged(table), table.select("conv_id", "cost")).collect()
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == want and len(got) == len(want)
    assert any(w[-2] == "" for w in want.values())
    shown = cv.repaired_turns(cv.damaged(table)).collect()
    for conv, w in want.items():
        lines = [f"{r.role}:{r.text}" for r in sorted((r for r in shown if r.conv_id == conv), key=lambda r: r.place)]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == w[-1]
    empty = table.filter("turn > 1000")
    assert not cv.repair(cv.damaged(empty), empty).collect()
    named = spark.createDataFrame([("x", 1, "user", "a"), ("x", 2, "assistant", "b.")], "conv_id string, turn long, role string, text string")
    assert [(r.conv_id, r.cost, r.audit) for r in cv.repair(named, named).collect()] == [("x", 4, "DD")]
