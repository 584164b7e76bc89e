import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from scorelake.llm import conversations
from scorelake.llm.conversations import GONE, Automaton

SCHEMA = "conv_id long, turn long, role string, text string, lost boolean, cost string, place string"


def cheapest(rows):
    """Cost and audit by a search over all edits, in the order of cost and letters. rows: (initial, must go, truncated)."""
    nexts = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, at = heapq.heappop(heap)
        if i == len(rows) and at in ("", "a"):
            return cost, audit
        if (i, at) in seen:
            continue
        seen.add((i, at))
        for x in "ua":
            if (at, x) in nexts:
                heapq.heappush(heap, (cost + 2, audit + "I", i, nexts[at, x]))
        if i < len(rows):
            initial, gone, cut = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, at))
            if not gone:
                if (at, initial) in nexts:
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, nexts[at, initial]))
                for x in "ua":
                    if (at, x) in nexts:
                        heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, nexts[at, x]))


def plain_version(rows):
    """The result for one conversation, rows (turn, role, text) after damage."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda y: (y[0] is not None, y[0] or 0, y[1].encode(), y[2].encode()))
    turns, seen, told = [t for t, _, _ in rows if t is not None], set(), []
    counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        told.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(told))
    cost, audit = cheapest(told)
    lines, rest, turn = [], list(rows), 0
    for x in audit:
        _, role, text = rest.pop(0) if x != "I" else (None, None, "")
        if x == "D":
            continue
        if not (x == "K" and role[:1] == "s"):
            turn += 1
        lines.append(f"{role if x == 'K' else 'user' if turn % 2 else 'assistant'}:{text}")
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def random_rows(seed=3, conversations=60, most=14):
    rng, rows = random.Random(seed), []
    for c in [*range(conversations), None]:
        for k in range(rng.randrange(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "s", None])
            text = rng.choice(["Yes.", "No!", "so and so", "Why?\n ", " \t", "", None, "é…", "a" * 50 + ".", "x\x0b"])
            rows.append((c, rng.choice([k, k, k, None, 2 * k]), role, text, rng.random() < 0.1, "c", "p"))
    return rows


def by_conversation(rows):
    out = {}
    for c, turn, role, text, lost, *_ in rows:
        out.setdefault(c, [])
        if not lost:
            out[c].append((turn, role, text))
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(random_rows(), SCHEMA).repartition(3).cache()


@pytest.mark.parametrize("held", [1 << 20, 150])
def test_equals_a_plain_version(table, held):
    got = {r.conv_id: tuple(r)[1:] for r in conversations.plans(table, held=held).collect()}
    assert got == {c: plain_version(rows) for c, rows in by_conversation(random_rows()).items()}


def test_automaton_finds_the_least_audit_of_all_short_conversations():
    automaton, kinds = Automaton(), [0, 2, 3, 4, 6, GONE]
    for n in range(6):
        for rows in itertools.product(kinds, repeat=n):
            told = [("suax"[r // 2] if r != GONE else "u", r == GONE, bool(r % 2) and r != GONE) for r in rows]
            assert automaton.repair(bytes(rows)) == cheapest(told), rows
    rng = random.Random(1)
    for _ in range(300):
        rows = bytes(rng.randrange(9) for _ in range(rng.randrange(60)))
        assert automaton.repair(rows) == cheapest([("suax"[r // 2] if r != GONE else "u", r == GONE, bool(r % 2) and r != GONE) for r in rows])
    assert len(automaton.vectors) < 100 and len(automaton.back) < 2000 and len(automaton.ahead) < 4000


def test_repaired_rows_are_well_formed(table):
    found = conversations.plans(table)
    lines = {}
    for r in conversations.repaired(table, found).collect():
        lines.setdefault(r.conv_id, []).append((r.position, r.edit, r.role, r.text))
    for r in found.collect():
        mine = sorted(lines.get(r.conv_id, []))
        assert [x[0] for x in mine] == list(range(len(mine)))
        assert re.fullmatch("(s?(ua)+)?", "".join(x[2][0] for x in mine))
        assert hashlib.sha256("\n".join(f"{x[2]}:{x[3]}" for x in mine).encode()).hexdigest() == r.repaired_sha256
        assert [x[1][0].upper() for x in mine] == [x for x in r.audit if x != "D"]


def test_damage(spark):
    rows = [(c, t, random.choice(["user", "system", None]), random.choice(["A. b! c?", None])) for c in [*range(9), None] for t in [*range(12), None]]
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text, kind == 0)
        want += [row] * (2 if kind == 3 else 1)
    got = conversations.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert {str(r.conv_id) for r in conversations.plans(got).collect()} == {str(r[0]) for r in rows}


def test_a_conversation_with_most_rows_and_empty_tables(spark, table):
    n = 20_000
    long = spark.range(n).select(
        F.lit(7).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.concat("id", F.when(F.col("id") % 5 > 0, ".").otherwise("")).alias("text")
    )
    (whole,), (parts,) = (conversations.plans(long, held=h).collect() for h in (1 << 30, 1000))
    assert whole == parts and len(whole.audit) >= n and (whole.gaps, whole.truncated) == (0, n // 5)
    first = conversations.plans(long.filter("turn < 40")).collect()[0]
    assert first[1:] == plain_version([(r.turn, r.role, r.text) for r in long.filter("turn < 40").collect()])
    assert conversations.plans(table.filter("false")).count() == 0
    (none,) = conversations.plans(table.limit(1).withColumn("lost", F.lit(True))).collect()
    assert tuple(none)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
