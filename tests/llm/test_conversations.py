"""Conversation repair: against a search over all edits, and the long way against the whole."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tierhouse.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, blank string, cost string, audit string, __conv string"


def plain_audit(turns):
    """(cost, audit) by trying every edit for each (turn, number of repaired turns, system first)."""
    best = {}

    def go(i, out, head):
        if (i, out, head) in best:
            return best[i, out, head]
        made = []
        if i == len(turns) and (out == 0 or out > head and (out - head) % 2 == 0):
            made.append((0, ""))
        wants = "a" if (out - head) % 2 else "u"
        if out <= 2 * len(turns) + 4:
            steps = [(2, "I", i, out + 1, head)]
            if i < len(turns):
                initial, must, cut = turns[i]
                steps.append((3, "D", i + 1, out, head))
                if not must:
                    if initial == wants:
                        steps.append((cut, "K", i + 1, out + 1, head))
                    if initial == "s" and out == 0:
                        steps.append((cut, "K", i + 1, 1, 1))
                    steps.append((2 + cut, "R", i + 1, out + 1, head))
            for cost, op, *to in steps:
                rest = go(*to)
                if rest:
                    made.append((cost + rest[0], op + rest[1]))
        best[i, out, head] = min(made, default=None)
        return best[i, out, head]

    return go(0, 0, 0)


def plain(rows):
    """The contract, row by row."""
    kept, out = defaultdict(list), {}
    for conv, turn, role, text, *_ in rows:
        kept[conv]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        role = "user" if kind == 4 else role
        kept[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    for conv, turns in kept.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in turns:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("b" if not body else "d" if (role, text) in seen else "" if body[-1] in ".!?" else "t")
            seen.add((role, text))
        cost, audit = plain_audit([(r[1][:1], f in ("b", "d"), f == "t") for r, f in zip(turns, faults)])
        lines, rest, head = [], iter(turns), 0
        for op in audit:
            _, role, text = ("", "", "") if op == "I" else next(rest)
            wanted = "assistant" if (len(lines) - head) % 2 else "user"
            head = 1 if op == "K" and role[:1] == "s" else head
            if op != "D":
                lines.append(f"{role if op == 'K' else wanted}:{text}")
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest)
    return Counter(out.values())


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def digest(df):
    return Counter(tuple(r[n] for n in NAMES) for r in df.collect())


def odd_turns():
    rng = random.Random(3)
    rows = []
    for conv in [None, *range(60)]:
        for k in range(rng.randint(1, 14)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "no", "é?  \n", " \t", "", None, f"{conv} {k}!", "x" * 3000, " "])
            rows.append((conv, rng.choice([k, k, k, None, 3, 2**40]), role, text, "x", "x", "x", "x"))
    return rows + rows[:40]


def test_contract_on_odd_rows(spark):
    rows = odd_turns()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert digest(C.structure_audit(C.damaged(df), ids=df)) == plain(rows)


def test_long_way_gives_the_same(spark):
    rng = random.Random(8)
    rows = odd_turns()
    for conv in (None, 7, 500):  # long ones: in many segments, with equal rows, over several ranges
        for k in range(220):
            rows.append((conv, rng.choice([k, k, 5, None]), rng.choice(["user", "assistant", "system"]), rng.choice(["Hm.", f"{k}.", f"{k}"]), "x", "x", "x", "x"))
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    wanted = digest(C.structure_audit(C.damaged(df), ids=df))
    assert digest(C.structure_audit(C.damaged(df), ids=df, segment=16)) == wanted
    assert digest(C.structure_audit(C.damaged(df), ids=df, segment=3)) == wanted
    turns = lambda n: Counter(map(tuple, C.repaired_turns(df.select("conv_id", "turn", "role", "text"), segment=n).collect()))
    assert turns(9) == turns(10_000)


def test_repaired_turns_follow_the_grammar(spark):
    import re

    df = spark.createDataFrame(odd_turns(), SCHEMA)
    by_conv = defaultdict(dict)
    for r in C.repaired_turns(df).collect():
        by_conv[r.conv_id][r.place] = (r.role, r.text, r.edit)
    audits = {r.conv_id: r.audit for r in C.structure_audit(df).collect()}
    for conv, audit in audits.items():
        places = by_conv[conv]
        assert sorted(places) == list(range(1, len(places) + 1))
        assert re.fullmatch("(s?(ua)+)?", "".join(places[k][0][0] for k in sorted(places)))
        assert "".join(places[k][2] for k in sorted(places)) == audit.replace("D", "")


def test_empty_and_all_dropped(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.structure_audit(C.damaged(empty), ids=empty).isEmpty() and C.repaired_turns(empty).isEmpty()
    gone = next(k for k in range(1000) if zlib.crc32(f"9:{k}".encode()) % 20 == 0)
    one = spark.createDataFrame([(9, gone, "user", "Hi.", "x", "x", "x", "x")], SCHEMA)
    assert digest(C.structure_audit(C.damaged(one), ids=one)) == Counter([(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())])


@pytest.mark.parametrize("share", [0.1, 0.4])
def test_alignment_is_the_cheapest(share):
    rng = random.Random(share)
    for n in range(0, 26):
        for _ in range(12):
            turns = [(rng.choice("suaxua"), rng.random() < share / 2, rng.random() < share) for _ in range(n)]
            turns = [(i, must, cut and not must) for i, must, cut in turns]
            codes = tuple(C.code_of(*t) for t in turns)
            assert C.cheapest(codes) == plain_audit(turns)
