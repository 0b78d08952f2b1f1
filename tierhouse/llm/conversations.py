"""Conversation structure repair: turns aligned to the alternating grammar, cheapest edits first.

A repaired conversation is empty, or user and assistant by turns, after at most
one system turn: the role initials read `(s?(ua)+)?`. A length fixes the whole
string, so a conversation is aligned, by Wagner and Fischer, to two strings,
`uaua...` and `suaua...`, whose columns are all feasible lengths at once. A
plain pass over the turns gives the incumbent cost, and Ukkonen's band keeps
only cells that some alignment of that cost can pass. The matrix holds costs to
go, so the audit (K keep, R rerole, D delete, I insert) is traced from the
front, the ASCII-least edit first; the two strings' audits are then compared.

Ordinary conversations are gathered by id and aligned whole. Of longer ones no
task gathers the turns: they are range-partitioned in order and cut into
segments, each aligned from every grammar state to every other; a chain of the
segments' 16 costs (and of the order of their audits) picks the states between
them, and with these the edits: the same result as for the whole. Repeated
turns are found by grouping. Only the hash of a long conversation is made in
one task, since SHA-256 has to read it in order; it streams, a batch at a time.

Defined cases: a null id is an id like any other; null roles and texts count as
one space, null turns come first; turns with equal numbers are taken by role,
then text; repeated rows are duplicates; an empty table gives an empty result.
Other columns are not read. An audit is one cell, so a conversation may have
about two billion turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierhouse.llm.common import in_tasks, ship_package, written
from tierhouse.operators.ordered import SEQ, range_sequence

#: Turns that one task aligns at a time.
SEGMENT = 512
#: Alignments of so short conversations are kept for the next one that looks the same.
KNOWN_TURNS = 32

INSERT, DELETE, REROLE = 2, 3, 2
_NEVER = 1 << 28
_SPACES = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}
_NAMES = {"u": "user", "a": "assistant"}

#: Grammar states (nothing yet, after system, after user, after assistant) and the strings that may follow.
STATES = "-sua"
_FOLLOWS = {"-": ("ua", "sua"), "s": ("ua",), "u": ("au",), "a": ("ua",)}
#: Inserts that end a conversation in each state.
_TAILS = {"-": "", "s": "II", "u": "I", "a": ""}
#: Between any two states the costs to go differ by no more than this (a system turn to delete, one to insert).
_APART = 5

_OTHER, _FORCED, _TRUNCATED = 3, 4, 8


def code_of(initial: str, forced: bool, truncated: bool) -> int:
    """A turn as far as costs go: its role's place in `sua` (else 3), whether it must go, whether it is cut off."""
    return ("sua".find(initial) if initial in ("s", "u", "a") else _OTHER) + _FORCED * forced + _TRUNCATED * (truncated and not forced)


def _string(pattern: str, length: int) -> str:
    """The first characters of the grammar string that begins with the pattern."""
    return (pattern[:-2] + pattern[-2:] * (length // 2 + 1))[:length]


def _incumbent(codes: tuple[int, ...], pattern: str, closed: bool) -> int:
    """What a plain pass costs: keep what fits, insert one turn before what fits next, else rerole."""
    cost, at = 0, 0
    head = len(pattern) - 2
    expected = lambda k: pattern[k] if k < head else pattern[head + (k - head) % 2]
    if head and not any(c == 0 or c == _TRUNCATED for c in codes):
        return _NEVER  # no system turn to keep
    for c in codes:
        sign = "sua?"[c & 3]
        if c & _FORCED:
            cost += DELETE
        elif at < head:  # waits for its system turn
            if sign == "s":
                at += 1
                cost += bool(c & _TRUNCATED)
            else:
                cost += DELETE
        elif sign == expected(at):
            at += 1
            cost += bool(c & _TRUNCATED)
        elif sign == expected(at + 1):
            at += 2
            cost += INSERT + bool(c & _TRUNCATED)
        else:
            at += 1
            cost += REROLE + bool(c & _TRUNCATED)
    if closed and at and (at - head) % 2 or closed and head and at == head:
        cost += INSERT * (2 if at == head else 1)
    return cost


def aligned(codes: tuple[int, ...], pattern: str, ends: Callable[[str, int], bool], bound: int, closed: bool) -> tuple[int, str]:
    """(cost, ASCII-least audit) of the cheapest edits to a prefix of the pattern's string for whose length `ends` holds.

    Alignments that cost more than `bound` are not looked at. `closed`: turns may be inserted after the last one.
    """
    n = len(codes)
    forced = [bool(c & _FORCED) for c in codes]
    before = np.concatenate([[0], np.cumsum([not f for f in forced])]).astype(int).tolist()  # live turns
    spare = bound - DELETE * sum(forced)
    if spare < 0:
        return _NEVER, ""
    width = before[-1] + spare // INSERT + 1
    string = _string(pattern, width + 1)
    low = [max(0, b - spare // DELETE) for b in before]
    high = [min(width, b + spare // INSERT) for b in before]
    letters = np.frombuffer(string.encode(), np.uint8)
    first = int(pattern[0] == "s")  # a system turn is never inserted
    rising = INSERT * np.arange(width + 2)

    def insert(row: np.ndarray, lo: int, hi: int) -> None:
        start = max(lo, first)
        if start <= hi:
            part = row[start : hi + 1] + rising[start : hi + 1]
            row[start : hi + 1] = np.minimum.accumulate(part[::-1])[::-1] - rising[start : hi + 1]

    togo = np.full((n + 1, width + 2), _NEVER, np.int64)
    for j in range(low[n], high[n] + 1):
        if ends(string, j):
            togo[n, j] = 0
    if closed:
        insert(togo[n], low[n], high[n])
    for i in range(n - 1, -1, -1):
        lo, hi = low[i], high[i]
        best = togo[i + 1, lo : hi + 1] + DELETE
        if not forced[i]:
            cut = bool(codes[i] & _TRUNCATED)
            here = letters[lo : hi + 1]
            change = np.where(here == ord("sua?"[codes[i] & 3]), cut, np.where(here == ord("s"), _NEVER, REROLE + cut))
            best = np.minimum(best, togo[i + 1, lo + 1 : hi + 2] + change)
        togo[i, lo : hi + 1] = best
        insert(togo[i], lo, hi)
    if togo[0, 0] >= _NEVER:
        return _NEVER, ""
    i = j = 0
    audit = []
    while i < n or togo[i, j]:
        left = togo[i, j]
        cut = i < n and bool(codes[i] & _TRUNCATED)
        if i < n and togo[i + 1, j] + DELETE == left:
            audit.append("D")
            i += 1
        elif j >= first and (i < n or closed) and togo[i, j + 1] + INSERT == left:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if string[j] == "sua?"[codes[i] & 3] and togo[i + 1, j + 1] + cut == left else "R")
            i, j = i + 1, j + 1
    return int(togo[0, 0]), "".join(audit)


def _whole(string: str, j: int) -> bool:
    return j == 0 or string[j - 1] == "a" and j > 1


def cheapest(codes: tuple[int, ...]) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    bound = min(_incumbent(codes, p, True) for p in _FOLLOWS["-"])
    return min(aligned(codes, p, _whole, bound, True) for p in _FOLLOWS["-"])


@lru_cache(maxsize=1 << 16)
def known(codes: tuple[int, ...]) -> tuple[int, str]:
    """cheapest(), remembered."""
    return cheapest(codes)


def between(codes: tuple[int, ...]) -> list[tuple[int, str]]:
    """(cost, audit) of a segment from each state to each state, 16 in all; _NEVER if there is none worth taking.

    Dearer than the incumbent by more than _APART is never part of a cheapest whole.
    """
    out = []
    for entry in STATES:
        bound = min(_incumbent(codes, p, False) for p in _FOLLOWS[entry]) + _APART
        for leave in STATES:
            ends = lambda string, j, e=entry, t=leave: (string[j - 1] if j else e) == t
            out.append(min(aligned(codes, p, ends, bound, False) for p in _FOLLOWS[entry]))
    return out


def chained(costs: np.ndarray, ranks: np.ndarray) -> list[tuple[int, int]]:
    """The states (entry, leave) of each segment on the cheapest, then ASCII-least way through all.

    Of audits to different states none begins another, so their order is the order of the first segment that differs.
    """
    n = len(costs)
    cost, order = [0, _NEVER, _NEVER, _NEVER], [0, 0, 0, 0]
    came = np.zeros((n, 4), np.int8)
    for k in range(n):
        best = []
        for t in range(4):
            best.append(min((cost[s] + int(costs[k, 4 * s + t]), order[s], int(ranks[k, 4 * s + t]), s) for s in range(4)))
            came[k, t] = best[t][3]
        cost = [min(b[0], _NEVER) for b in best]
        place = {x: i for i, x in enumerate(sorted({b[1:3] for b in best}))}
        order = [place[b[1:3]] for b in best]
    state = min(range(4), key=lambda t: (cost[t] + INSERT * len(_TAILS[STATES[t]]), order[t]))
    path = []
    for k in range(n - 1, -1, -1):
        path.append((int(came[k, state]), state))
        state = int(came[k, state])
    return path[::-1]


_DIGEST = [
    ("gaps", T.LongType()), ("blank", T.LongType()), ("duplicate", T.LongType()), ("truncated", T.LongType()), ("illegal", T.LongType()),
    ("cost", T.LongType()), ("audit", T.StringType()), ("repaired_sha256", T.StringType()), ("turns", T.LongType()),
]


class _Conversation:
    """Counts, edits and the repaired turns of one conversation, turn by turn."""

    def __init__(self, conv):
        self.conv, self.blank, self.duplicate, self.truncated, self.illegal, self.cost = conv, 0, 0, 0, 0, 0
        self.first, self.turn, self.distinct = None, None, 0
        self.initial, self.audit, self.lines, self.expected = None, [], 0, "u"
        self.hash = hashlib.sha256()

    def turn_of(self, turn, role: str, text: str, fault: str, ops: str) -> Iterator[tuple[str, str, str]]:
        """One turn with the edits that end at it; gives (edit, role, text) of the repaired turns."""
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in _LEGAL
        self.initial = initial
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.distinct += turn != self.turn
            self.turn = turn
        self.blank += fault == "b"
        self.duplicate += fault == "d"
        self.truncated += fault == "t"
        yield from self.edits(ops, role, text, fault)

    def edits(self, ops: str, role: str = "", text: str = "", fault: str = "") -> Iterator[tuple[str, str, str]]:
        self.audit.append(ops)
        for op in ops:
            self.cost += {"I": INSERT, "D": DELETE, "R": REROLE, "K": 0}[op] + (op in "KR" and fault == "t")
            if op == "D":
                continue
            line = (role if op == "K" else _NAMES[self.expected], "" if op == "I" else text)
            self.expected = "a" if line[0][:1] == "u" else "u"
            self.hash.update((b"\n" if self.lines else b"") + f"{line[0]}:{line[1]}".encode())
            self.lines += 1
            yield op, *line

    def digest(self) -> tuple:
        gaps = self.turn - self.first + 1 - self.distinct if self.turn is not None else 0
        audit = "".join(self.audit)
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, audit, self.hash.hexdigest(), self.lines)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _streamed(rows: DataFrame, conv_type: T.DataType, turns: bool, edited: bool) -> DataFrame:
    """Rows sorted by conversation and turn into one row for each conversation, or for each repaired turn.

    `edited`: a column __ops has the edits of each turn; else a conversation's are found here, from all of its turns.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = [("edit", T.StringType()), ("place", T.LongType()), ("role", T.StringType()), ("text", T.StringType())] if turns else _DIGEST
    made = T.StructType([T.StructField("__conv", conv_type), *(T.StructField(n, t) for n, t in fields)])
    schema = to_arrow_schema(made)

    def whole(conv, held: list[tuple]) -> Iterator[tuple]:
        seen, faults = set(), []
        for _, role, text, fault in held:
            told = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
            faults.append("d" if fault != "b" and told in seen else fault)
            seen.add(told)
        codes = tuple(code_of(r[1][:1], f in ("b", "d"), f == "t") for r, f in zip(held, faults))
        audit = (known if len(codes) <= KNOWN_TURNS else cheapest)(codes)[1]
        out = _Conversation(conv)
        ops = re.findall("I*[DKR]", audit)
        for (turn, role, text, _), fault, op in zip(held, faults, ops):
            yield from ((out, line) for line in out.turn_of(turn, role, text, fault, op))
        yield from ((out, line) for line in out.edits(audit[len("".join(ops)) :]))
        yield out, None

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(conversation, repaired turn), and (conversation, None) at the end of each."""
        held, conv, out = None, None, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if edited:
                    if out is None or out.conv != row[0]:
                        if out is not None:
                            yield out, None
                        out = _Conversation(row[0])
                    yield from ((out, line) for line in out.turn_of(*row[1:]))
                else:
                    if held is None or conv != row[0]:
                        if held is not None:
                            yield from whole(conv, held)
                        held, conv = [], row[0]
                    if row[1]:
                        held.append(row[2:])
        if out is not None:
            yield out, None
        if held is not None:
            yield from whole(conv, held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, size = [], 0
        for out, line in streams(batches):
            if turns and line is not None:
                ready.append((out.conv, line[0], out.lines, *line[1:]))
                size += len(line[2]) + 64
            elif not turns and line is None:
                ready.append((out.conv, *out.digest()))
                size += len(ready[-1][7]) + 256
            if size > 1 << 22:
                yield _batch(ready, schema)
                ready, size = [], 0
        if ready:
            yield _batch(ready, schema)

    return in_tasks(rows, run, made)


def _fault(text: Column) -> Column:
    """b (blank), t (last character but white space is not one of .!?), or empty."""
    trimmed = F.rtrim(text, F.lit(_SPACES))
    return F.when(trimmed == "", "b").when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "t").otherwise("")


def _long_edits(long: DataFrame, segment_turns: int) -> DataFrame:
    """Turns of long conversations in order, each with its fault and edits."""
    # Equal rows differ by their number, so that even they go to several ranges.
    told = written(long.withColumn("__row", F.monotonically_increasing_id()), "turns")
    rows = range_sequence(told, [F.asc_nulls_first("__conv"), F.asc_nulls_first("__turn"), "__role", "__text", "__row"])
    # A turn's first place; later ones are duplicates. Keys of this join are unique.
    firsts = rows.groupBy("__conv", "__role", F.md5("__text")).agg(F.min(SEQ).alias(SEQ)).select(SEQ, F.lit(True).alias("__first"))
    fault = F.when((F.col("__fault") != "b") & F.col("__first").isNull(), "d").otherwise(F.col("__fault"))
    faults = written(
        rows.select(SEQ, "__conv", F.substring("__role", 1, 1).alias("__initial"), "__fault")
        .join(firsts, SEQ, "left")
        .select(SEQ, "__conv", "__initial", fault.alias("__fault")),
        "turn-faults",
    )

    def segment(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by(SEQ)
        marks = zip(table.column("__initial").to_pylist(), table.column("__fault").to_pylist())
        found = between(tuple(code_of(i, f in ("b", "d"), f == "t") for i, f in marks))
        ranks = []
        for entry in range(4):
            audits = [a for _, a in found[4 * entry : 4 * entry + 4]]
            ranks += [sorted(audits).index(a) for a in audits]
        pieces = [re.findall("I*[DKR]", a) for _, a in found]
        made = {
            "first": [table.column(SEQ)[0].as_py()], "costs": [[c for c, _ in found]], "ranks": [ranks],
            "seqs": [table.column(SEQ).to_pylist()], "pieces": [pieces],
        }
        arrays = [table.column("__conv").slice(0, 1).combine_chunks(), *(pa.array(v, t) for v, t in zip(made.values(), types))]
        return pa.Table.from_arrays(arrays, names=["__conv", *made])

    types = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.list_(pa.string()))]
    conv = faults.schema["__conv"]
    made = T.StructType([conv, *T.StructType.fromDDL("first long, costs array<int>, ranks array<int>, seqs array<long>, pieces array<array<string>>").fields])
    ship_package(long.sparkSession)
    by_segment = faults.withColumn("__segment", F.call_function("div", F.col(SEQ), F.lit(segment_turns))).groupBy("__conv", "__segment")
    segments = written(by_segment.applyInArrow(segment, made), "turn-segments")

    def chain(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("first")
        costs, ranks = (np.array(table.column(c).to_pylist(), np.int64) for c in ("costs", "ranks"))
        path = chained(costs, ranks)
        tails = [""] * (len(path) - 1) + [_TAILS[STATES[path[-1][1]]]]
        return pa.table({"first": table.column("first"), "choice": pa.array([4 * s + t for s, t in path], pa.int32()), "tail": tails})

    # Numbers of one long conversation's segments: at most a few million short rows, as an audit fits in one cell.
    chosen = segments.select("__conv", "first", "costs", "ranks").groupBy("__conv").applyInArrow(chain, "first long, choice int, tail string")
    picked = segments.join(chosen, "first").select("tail", F.size("seqs").alias("n"), F.posexplode(F.arrays_zip("seqs", F.element_at("pieces", F.col("choice") + 1).alias("ops"))).alias("k", "x"))
    ops = picked.select(F.col("x.seqs").alias(SEQ), F.concat("x.ops", F.when(F.col("k") == F.col("n") - 1, F.col("tail")).otherwise("")).alias("__ops"))
    return rows.select(SEQ, "__conv", "__turn", "__role", "__text").join(faults.select(SEQ, "__fault"), SEQ).join(ops, SEQ)


def _repaired(conversations: DataFrame, conv_id, turn, role, text, ids, segment, turns) -> DataFrame:
    rows = conversations.select(
        F.col(conv_id).alias("__conv"),
        F.lit(True).alias("__there"),
        F.col(turn).alias("__turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("__role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("__text"),
    ).withColumn("__fault", _fault(F.col("__text")))
    known = (conversations if ids is None else ids).select(F.col(conv_id).alias("__conv")).distinct()
    absent = {c: F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns[2:]}
    marked = rows.unionByName(known.select("__conv", F.lit(False).alias("__there"), *absent.values()))
    long_ids = written(rows.groupBy("__conv").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > segment).select(F.col("__conv").alias("__long")), "long-ids")
    order = [F.asc_nulls_first("__conv"), "__there", F.asc_nulls_first("__turn"), "__role", "__text"]
    kind = rows.schema["__conv"].dataType
    if long_ids.isEmpty():
        return _streamed(marked.repartition("__conv").sortWithinPartitions(*order), kind, turns, edited=False)
    of_long = F.col("__conv").eqNullSafe(F.col("__long"))
    ordinary = marked.join(long_ids, of_long, "left_anti").repartition("__conv").sortWithinPartitions(*order)
    long = _long_edits(rows.join(long_ids, of_long, "left_semi").drop("__there"), segment)
    ordered = long.repartition("__conv").sortWithinPartitions(F.asc_nulls_first("__conv"), SEQ)
    edited = ordered.select("__conv", "__turn", "__role", "__text", "__fault", "__ops")
    return _streamed(ordinary, kind, turns, edited=False).unionByName(_streamed(edited, kind, turns, edited=True))


def structure_audit(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    ids: DataFrame | None = None,
    segment: int = SEGMENT,
) -> DataFrame:
    """Per conversation: conv_id, faults found, cost and audit of the cheapest repair, hash and number of the repaired turns.

    `ids` names conversations (column `conv_id`) that are to have a row even without any turn.
    """
    return _repaired(conversations, conv_id, turn, role, text, ids, segment, turns=False).withColumnRenamed("__conv", "conv_id")


def repaired_turns(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT
) -> DataFrame:
    """The repaired conversations: conv_id, edit (K, R or I), place (from 1), role, text."""
    return _repaired(conversations, conv_id, turn, role, text, None, segment, turns=True).withColumnRenamed("__conv", "conv_id")


def damaged(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Known faults in a fifth of the turns, by CRC-32 of id and turn: dropped, emptied, cut off, repeated, given to the user."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_id).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    rows = conversations.select(
        F.col(conv_id), F.col(turn), F.coalesce(F.col(role), space).alias(role), F.coalesce(F.col(text), space).alias(text), (F.crc32(key.cast("binary")) % 20).alias("__kind")
    )
    kind = F.col("__kind")
    shown = F.when(kind == 1, "").when(kind == 2, F.translate(F.col(text), ".!?", "")).otherwise(F.col(text))
    times = F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    changed = rows.where(kind != 0).select(conv_id, turn, F.when(kind == 4, "user").otherwise(F.col(role)).alias(role), shown.alias(text), times.alias("__time"))
    return changed.drop("__time")
