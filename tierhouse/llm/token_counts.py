"""Token counts of a byte-level BPE vocabulary, by rank-synchronous array merging.

Texts are split at special strings and into pre-tokens. The pre-tokens that a
task has not met before are laid out as one ragged array of symbols. In each
round every sequence finds its own lowest-ranked pair and applies all its
occurrences at once, left to right; what is left when no sequence has a pair
is counted. A merge's result can only be part of later-ranked merges, so the
rounds give what merging one pair at a time gives. Counts of pre-tokens are
remembered in a dictionary of bounded size; the bound changes the time only.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); repeated rows
are counted each; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import json
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierhouse.llm.common import mapped

#: Pre-tokens remembered in a task.
REMEMBERED = 300_000
#: Fixed value: the byte-level pre-token pattern, white space as Unicode defines it.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
_NO_PAIR = np.int64(1 << 40)


def byte_symbols() -> dict[str, int]:
    """Byte-level vocabularies write bytes as characters: printable ones as themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class RankedMerges:
    """A vocabulary's merges as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, self.special = spec["model"], [t["content"] for t in spec["added_tokens"]]
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        if spec["pre_tokenizer"]["add_prefix_space"] or any(t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} adds or strips spaces")
        ids, symbols = model["vocab"], byte_symbols()
        self.of_byte = np.zeros(256, np.int64)
        for character, byte in symbols.items():
            self.of_byte[byte] = ids[character]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right, made = (np.array(x, np.int64) for x in zip(*((ids[a], ids[b], ids[a + b]) for a, b in pairs)))
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.split = regex.compile(PATTERN).findall
        self.at_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.known: dict[str, int] = {}

    def count_symbols(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each (non-empty) pre-token after all merges."""
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        counts = lengths.copy()
        symbols = self.of_byte[np.frombuffer(b"".join(tokens), np.uint8)]
        names = np.arange(len(tokens))
        while len(names):
            first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            owner = np.repeat(np.arange(len(names)), lengths)
            keys = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            found = (self.keys[at] == keys) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(found, self.ranks[at], _NO_PAIR), _NO_PAIR)
            lowest = np.minimum.reduceat(rank, first)
            apply = (rank == lowest[owner]) & (rank != _NO_PAIR)
            # Neighbours that both qualify are a run of one symbol: every second one merges.
            where = np.flatnonzero(apply)
            starts = np.diff(where, prepend=-2) != 1
            run = np.maximum.accumulate(np.where(starts, where, 0)) if len(where) else where
            where = where[(where - run) % 2 == 0]
            symbols[where] = self.made[at[where]]
            stay = np.ones(len(symbols), bool)
            stay[where + 1] = False
            lengths = np.add.reduceat(stay, first, dtype=np.int64)
            counts[names] = lengths
            active = (lowest != _NO_PAIR) & (lengths > 1)
            stay &= active[owner]
            symbols, lengths, names = symbols[stay], lengths[active], names[active]
        return counts

    def counts(self, texts: list[str]) -> list[int]:
        out, pieces = [0] * len(texts), []
        for i, text in enumerate(texts):
            parts = self.at_special.split(text) if self.at_special else [text]
            out[i] = len(parts) - 1
            pieces += [(i, self.split(p)) for p in parts if p]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = [t for t in set().union(*(p for _, p in pieces)) if t not in known] if pieces else []
        if new:
            known.update(zip(new, self.count_symbols([t.encode() for t in new]).tolist()))
        for i, tokens in pieces:
            out[i] += sum(map(known.__getitem__, tokens))
        return out


@cache
def merges_of(path: str) -> RankedMerges:
    return RankedMerges(path)


def token_counts(docs: DataFrame, path: str, limit: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit. `path` is readable on every executor."""

    def measure(texts: pa.Array) -> list:
        plain = [t or "" for t in texts.to_pylist()]
        counts = merges_of(path).counts(plain)
        return [pa.array([len(t.encode()) for t in plain], pa.int64()), pa.array(counts, pa.int64())]

    rows = mapped(docs, text, [doc_id], [("n_bytes", T.LongType()), ("n_tokens", T.LongType())], measure)
    return rows.select(F.col(doc_id).alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
