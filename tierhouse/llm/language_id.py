"""Language identification with error-correcting output codes.

Each language gets a codeword of bits. For each bit a binary classifier over
hashed byte n-grams of the whole text separates the languages whose bit is 1
from the others. A text's margins are decoded to the language of least
weighted loss: a bit counts for a language as much as its classifier is sure
of that language. If the runner-up's loss is close, the row is flagged.

The classifiers are log ratios of n-gram frequencies, so training is one pass
over all labelled rows: every task adds up frequencies per language, Spark
adds the vectors, and the driver sees one vector of `DIMENSIONS` numbers for
each language, however many documents there are.

Defined cases: null text or text without a letter is `und` with score 0, as is
every text if nothing was learned; rows without a language are not learned
from; repeated rows are counted each; an empty table gives an empty result;
with a single language every text with a letter is given that language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierhouse.llm.common import in_tasks, mapped, shards_of

DIMENSIONS = 4096
ORDERS = (1, 2, 3)
#: Rows that a task holds as dense vectors at a time, and languages it sums before it passes them on.
ROWS, HELD = 128, 64
UNKNOWN = "und"
#: Two languages whose scores are closer than this are ambiguous.
MARGIN = 0.1
_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def frequencies(texts: list[str]) -> np.ndarray:
    """One row for each text: shares of its hashed byte n-grams, lower-cased, over all orders."""
    parts = [b" " + t.lower().encode() + b" " for t in texts]
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(parts), dtype=np.int64), lengths)
    counts = np.zeros(len(parts) * DIMENSIONS)
    code = np.zeros(len(data), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        code = (code[: len(data) - n + 1] << np.uint32(8)) | data[n - 1 :]
        if n in ORDERS and len(code):
            slot = ((code + np.uint32(n << 26)) * np.uint32(2654435761)) >> np.uint32(32 - 12)
            inside = owner[: len(code)] == owner[n - 1 :]
            counts += np.bincount((owner[: len(code)] * DIMENSIONS + slot)[inside], minlength=len(counts))
    counts = counts.reshape(len(parts), DIMENSIONS)
    return counts / np.maximum(counts.sum(1, keepdims=True), 1)


def language_sums(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """lang, n, and the sum of its documents' frequency vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[int, np.ndarray]] = {}

        def out() -> pa.RecordBatch:
            names = list(held)
            made = pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.string()),
                    pa.array([held[k][0] for k in names], pa.int64()),
                    pa.array([held[k][1] for k in names], pa.list_(pa.float64())),
                ],
                names=["lang", "n", "sums"],
            )
            held.clear()
            return made

        for batch in batches:
            for part in shards_of(batch, 1, rows=ROWS):
                pairs = [(k, t) for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) if has_letter(t)]
                shares = frequencies([t for _, t in pairs])
                keys = np.array([k for k, _ in pairs], object)
                for k in dict.fromkeys(keys):
                    mine = keys == k
                    n, sums = held.get(k, (0, 0.0))
                    held[k] = n + int(mine.sum()), sums + shares[mine].sum(0)
                if len(held) > HELD:
                    yield out()
        yield out()

    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string"), F.col(text))
    tasks = in_tasks(rows, run, "lang string, n bigint, sums array<double>")
    return (
        tasks.withColumn("v", array_to_vector("sums"))
        .groupBy("lang")
        .agg(F.sum("n").alias("n"), Summarizer.sum(F.col("v")).alias("v"))
        .select("lang", "n", vector_to_array("v").alias("sums"))
    )


@dataclass
class Codebook:
    languages: list[str]
    codes: np.ndarray  # languages x bits, of -1 and 1
    weights: np.ndarray  # n-grams x bits
    trust: np.ndarray  # languages x bits: what a bit counts for a language


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n codewords of -1 and 1: all ways to part them if those are few, else the best of random codes."""
    if n == 1:
        return np.ones((1, 1))
    if n <= 5:
        bits = np.arange(1, 2 ** (n - 1))
        return np.where((bits[None, :] >> np.arange(n)[:, None]) & 1, 1.0, -1.0)
    random, best, far = np.random.default_rng(seed), None, -1
    for _ in range(50):
        code = random.choice([-1.0, 1.0], (n, int(np.ceil(10 * np.log2(n)))))
        code = code[:, np.abs(code.sum(0)) < n]
        gram = code @ code.T
        np.fill_diagonal(gram, -np.inf)
        distance = (code.shape[1] - gram.max()) / 2
        if distance > far:
            best, far = code, distance
    return best


def fitted(sums: list[tuple[str, int, list[float]]]) -> Codebook | None:
    sums = sorted((s for s in sums if s[1]), key=lambda s: s[0])
    if not sums:
        return None
    shares = np.array([np.asarray(s[2]) / s[1] for s in sums])
    shares = (shares + 1e-6) / (1 + 1e-6 * DIMENSIONS)
    codes = codewords(len(sums))
    plus, minus = codes.T > 0, codes.T < 0
    log_mean = lambda side: np.log((side @ shares) / np.maximum(side.sum(1, keepdims=True), 1) + 1e-12)
    weights = (log_mean(plus) - log_mean(minus)).T if len(sums) > 1 else np.zeros((DIMENSIONS, 1))
    margins = shares @ weights
    scale = np.maximum(np.abs(margins).mean(0), 1e-9)
    weights, margins = weights / scale, margins / scale
    trust = np.maximum(codes * margins, 1e-3)
    return Codebook([s[0] for s in sums], codes, weights, trust / trust.sum(1, keepdims=True))


def decode(book: Codebook, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language number, score and closeness of the runner-up, for each row of frequencies."""
    margins = np.clip(shares @ book.weights, -8, 8)
    losses = (np.exp(-margins[:, None, :] * book.codes[None]) * book.trust[None]).sum(2)
    odds = np.exp(-2 * (losses - losses.min(1, keepdims=True)))
    scores = odds / odds.sum(1, keepdims=True)
    best = losses.argmin(1)
    top = np.sort(scores, 1)[:, ::-1]
    return best, top[:, 0], (top[:, 0] - top[:, 1]) if scores.shape[1] > 1 else top[:, 0]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def identify(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row: doc_id, lang_pred, score, ambiguous; learned from the rows where `learn` holds."""
    # One row per language: bounded by the number of languages, not of documents.
    book = fitted([(r.lang, r.n, r.sums) for r in language_sums(docs.where(learn), text, lang).collect()])

    def measure(texts: pa.Array) -> list:
        plain = texts.to_pylist()
        some = [i for i, t in enumerate(plain) if has_letter(t)] if book else []
        names, scores, close = [UNKNOWN] * len(plain), [0.0] * len(plain), [False] * len(plain)
        if some:
            for i, b, s, gap in zip(some, *decode(book, frequencies([plain[i] for i in some]))):
                names[i], scores[i], close[i] = book.languages[b], float(s), bool(gap < MARGIN)
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(close, pa.bool_())]

    fields = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("ambiguous", T.BooleanType())]
    return mapped(docs, text, [doc_id], fields, measure, rows=ROWS).withColumnRenamed(doc_id, "doc_id")
