"""Conversation repair against trying all cheapest edits one by one."""

import hashlib
import heapq
import os
import random
import zlib
from collections import Counter

import pytest

from faultsift.llm import repair
from faultsift.llm.repair import damaged, op13_repair, ordered_turns, repair_report, repaired

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ROWS = "conv_id LONG, turn LONG, role STRING, text STRING"
SPACES = " \t\n\x0b\x0c\r"


def hurt(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (2 if kind == 3 else 1)


def faults(rows):
    """(role, text, fault) of ordered rows."""
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(SPACES)
        if not body:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def cheapest(rows):
    """(cost, audit, lines): paths by (cost, audit), so the first to arrive is the least."""
    start = (0, "", 0, "", ())
    queue, done = [start], set()
    while queue:
        cost, audit, k, roles, lines = heapq.heappop(queue)
        if k == len(rows) and (roles == "" or roles[-1] == "a"):
            return cost, audit, lines
        state = (k, roles[-1:])
        if state in done:
            continue
        done.add(state)

        def go(more, letter, at, role=None, text="", initial=""):
            initial = initial or (role or "")[:1]
            if role is not None:
                fits = {"": "su", "s": "u", "u": "a", "a": "u"}[roles[-1:]]
                if not initial or initial not in fits:
                    return
            line = () if role is None else (f"{role}:{text}",)
            heapq.heappush(queue, (cost + more, audit + letter, at, roles + (initial if role is not None else ""), lines + line))

        for role in ("user", "assistant"):
            go(2, "I", k, role)
        if k < len(rows):
            role, text, fault = rows[k]
            go(3, "D", k + 1)
            if fault in ("", "truncated"):
                more = fault == "truncated"
                go(more, "K", k + 1, role, text)
                for other in ("user", "assistant"):
                    go(2 + more, "R", k + 1, other, text)
    raise AssertionError("no repair")


def expected(rows, damage=True):
    """Result rows of the plain loop."""
    convs = {row[0] for row in rows}
    filled = [(c, t, *(" " if x is None else x for x in rest)) for c, t, *rest in rows]
    held = list(hurt(rows)) if damage else filled
    for conv in convs:
        own = [row[1:] for row in held if row[0] == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in own if t is not None]
        found = faults([(r, x) for _, r, x in own])
        cost, audit, lines = cheapest(found)
        initials = [r[:1] for r, _, _ in found]
        kinds = Counter(f for _, _, f in found)
        yield (
            conv,
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            kinds["blank"], kinds["duplicate"], kinds["truncated"],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def report(frame, damage=True):
    turns = damaged(frame) if damage else frame.selectExpr(
        "conv_id", "turn", "coalesce(role, ' ') AS role", "coalesce(text, ' ') AS text", "1 AS copies"
    )
    return [tuple(r) for r in repair_report(frame, ordered_turns(turns, turns["copies"])).select(*NAMES).collect()]


def some_rows(rng, conv, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "s", "", None]
    texts = ["Yes.", "No", "What?", " \n", "", None, "More text", "Fine! ", "Wait.\t"]
    turn = 0
    for _ in range(n):
        turn += rng.choice([0, 1, 1, 1, 3])
        yield conv, rng.choice([turn, turn, turn, None]), rng.choice(roles), rng.choice(texts)


@pytest.mark.parametrize("piece_rows", [20_000, 3])
def test_equals_the_plain_loop(spark, monkeypatch, piece_rows):
    """With pieces of three rows nearly every conversation is in several."""
    monkeypatch.setattr(repair, "PIECE_ROWS", piece_rows)
    rng = random.Random(piece_rows)
    rows = [row for conv in range(150) for row in some_rows(rng, conv, rng.randrange(1, 12))]
    rows += list(some_rows(rng, None, 9)) + list(some_rows(rng, 7000, 120))
    frame = spark.createDataFrame(rows, ROWS).repartition(5)
    for damage in (False, True):
        assert sorted(report(frame, damage), key=repr) == sorted(expected(rows, damage), key=repr)


def test_repeated_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")] * 3 + [(2, 5, "user", "Go!")] * 2
    got = report(spark.createDataFrame(rows, ROWS), damage=False)
    assert sorted(got) == sorted(expected(rows, damage=False))


def test_all_rows_dropped_and_no_rows(spark):
    gone = [n for n in range(500) if zlib.crc32(f"{n}:0".encode()) % 20 == 0][:3]
    rows = [(n, 0, "user", "Hello.") for n in gone]
    empty = hashlib.sha256(b"").hexdigest()
    got = report(spark.createDataFrame(rows, ROWS))
    assert sorted(got) == [(n, 0, 0, 0, 0, 0, 0, "", empty) for n in gone]
    assert report(spark.createDataFrame([], ROWS)) == []


def test_lines_of_a_repaired_conversation(spark):
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "tool", "42."),
        (1, 3, "assistant", "It is 42."), (1, 4, "assistant", " "), (1, 5, "user", "Thanks"),
    ]
    frame = spark.createDataFrame([(*r, 0.5, "x") for r in rows], f"{ROWS}, piece DOUBLE, fault STRING")
    (row,) = repaired(frame).collect()
    # The last turn has no answer: deleting it costs as much as answering it, and D comes before K.
    assert row.audit == "KIKRKDD"
    assert row.lines.split("\n")[1:3] == ["user:", "assistant:Hello."]


def test_query_equals_the_plain_loop(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = [tuple(r) for r in op13_repair(spark, SF_DIR).collect()]
    assert sorted(got) == sorted(expected(rows))
