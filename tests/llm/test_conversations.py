import hashlib
import os
import random
import re
import zlib
from collections import defaultdict
from functools import cache

import pytest
from changeflow.llm import conversations
from changeflow.llm.conversations import Conversation, Steps, damaged, repaired
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string"
NOT_BLANK = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """(cost, audit) by trying all edits from each row and state on; ``rows``: (initial, fault)."""

    @cache
    def best(i, state):
        # State: the initials so far, as far as they matter.
        ends = [(0, "")] if i == len(rows) and state in ("", "a") else []
        want = "a" if state == "u" else "u"
        if i < len(rows):
            letter, fault = rows[i]
            more = 5 if fault == "truncated" else 0
            ways = [("D", 2, state)]
            if fault not in ("blank", "duplicate"):
                ways.append(("R", 1 + more, want))
                if letter == want or (letter == "s" and state == ""):
                    ways.append(("K", more, letter))
            for edit, cost, to in ways:
                rest = best(i + 1, to)
                ends.append((cost + rest[0], edit + rest[1]))
        # An inserted row leads on; more than two in a row never pay.
        for k in (1, 2):
            to = state
            for _ in range(k):
                to = "a" if to == "u" else "u"
            rest = no_insert(i, to)
            if rest:
                ends.append((5 * k + rest[0], "I" * k + rest[1]))
        return min(ends)

    @cache
    def no_insert(i, state):
        if i == len(rows):
            return (0, "") if state in ("", "a") else None
        letter, fault = rows[i]
        more = 5 if fault == "truncated" else 0
        want = "a" if state == "u" else "u"
        ways = [("D", 2, state)]
        if fault not in ("blank", "duplicate"):
            ways.append(("R", 1 + more, want))
            if letter == want or (letter == "s" and state == ""):
                ways.append(("K", more, letter))
        return min((cost + best(i + 1, to)[0], edit + best(i + 1, to)[1]) for edit, cost, to in ways)

    return best(0, "")


def brute(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        how = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        role = "user" if how == 4 else role
        by[conv] += [(turn is not None, turn or 0, role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    out = []
    for conv, given in by.items():
        given.sort()
        seen, faults = set(), []
        for _, _, role, text in given:
            solid = NOT_BLANK.findall(text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
        turns = {t for there, t, _, _ in given if there}
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(given, given[1:], strict=False)]
        cost, audit = cheapest(tuple((r[2][:1], f) for r, f in zip(given, faults, strict=True)))
        lines, state, at = [], "", 0
        for edit in audit:
            want = "assistant" if state == "u" else "user"
            if edit == "I":
                lines.append(f"{want}:")
                state = want[0]
                continue
            _, _, role, text = given[at]
            at += 1
            if edit != "D":
                role = want if edit == "R" else role
                lines.append(f"{role}:{text}")
                state = role[0]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=str)


def corpus(seed, n=120):
    rng, rows = random.Random(seed), []
    texts = ["Fine.", "Fine.", "Yes!", "cut off", "Ä?", " \t\n", "", "no end 　", "ok. \r\n", "A.\x0bB", None]
    for conv in range(n):
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "student"]) if rng.random() < 0.4 else ("user", "assistant")[turn % 2]
            rows.append((conv if rng.random() < 0.98 else None, turn if rng.random() < 0.95 else None, role, rng.choice(texts)))
            if rng.random() < 0.1:
                rows.append(rows[-1])
            if rng.random() < 0.05:
                rows.append((*rows[-1][:2], "user", "another of the turn."))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    assert order(repaired(damaged(spark.createDataFrame(rows, SCHEMA))).collect()) == order(brute(rows))


def test_program_equals_all_edits():
    """Short random conversations, with every kind of role and fault."""
    rng, program = random.Random(5), Steps()
    for _ in range(3000):
        rows = [(rng.choice("suaut"), rng.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randrange(9))]
        c = Conversation(1, program)
        for letter, fault in rows:
            c.add(None, letter, "x", {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}[fault])
        assert c.result()[6:8] == cheapest(tuple(rows)), rows


def test_giant_conversation_spills(spark, monkeypatch):
    """A conversation over many batches and files gives what it gives in memory."""
    rng = random.Random(9)
    rows = [(rng.choice("suaut"), f"text {k}.", rng.choice([0, 0, 0, 1, 2, 3])) for k in range(50_000)]
    results = []
    for held in (1 << 30, 5_000):
        c = Conversation(7, Steps(), held)
        for k, (role, text, fault) in enumerate(rows):
            c.add(k, role, text, fault)
        assert (c.files is not None) == (held == 5_000)
        results.append(c.result())
    assert results[0] == results[1] and len(results[0][7]) >= len(rows)
    monkeypatch.setattr(conversations, "HELD", 1 << 20)
    given = [(1, k, ("user", "assistant")[k % 2], "Some words of a turn." * 20 + f"{k}.") for k in range(6_000)] + [(2, 0, "user", "x."), (2, 1, "assistant", "y " * 200_000 + ".")]
    got = order(repaired(damaged(spark.createDataFrame(given, SCHEMA))).collect())
    assert [r[:6] for r in got] == [r[:6] for r in order(brute(given[-2:]) + [counted(given[:-2])])]


def counted(rows):
    """Counts of a conversation that is too long for trying all edits: all texts differ and end with a stop."""
    after = []
    for conv, turn, role, _ in rows:
        how = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        after += [(turn, "user" if how == 4 else role, how)] * (0 if how == 0 else 2 if how == 3 else 1)
    turns = {t for t, _, _ in after}
    illegal = sum(a[1][0] + b[1][0] not in ("su", "ua", "au") for a, b in zip(after, after[1:], strict=False))
    return (rows[0][0], max(turns) - min(turns) + 1 - len(turns), sum(h == 1 for _, _, h in after), sum(h == 3 for _, _, h in after) // 2, sum(h == 2 for _, _, h in after), illegal, 0, "", "")


def test_empty_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repaired(damaged(empty)).collect() == []
    rows = corpus(4, 20)
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("gone", "fault", "_again", "_how", "_copy", "audit"):
        df = df.withColumn(c, F.lit("x"))
    assert order(repaired(damaged(df)).collect()) == order(brute(rows))


def test_large_ids_beside_nulls(spark):
    rows = [(2**62 + 1, 2**60 + 1, "user", "a."), (2**62, 5, "user", "a."), (None, None, "user", "b.")]
    assert order(repaired(damaged(spark.createDataFrame(rows, SCHEMA))).collect()) == order(brute(rows))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_query(spark):
    from changeflow.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert order(QUERIES["op12_conversation_repair"](spark, "/root/testdata/sf0.01").collect()) == order(brute(rows))
