"""Personal data: regular expressions propose, checksums confirm, context adjusts.

Four base kinds are fixed: email, ip, card (Luhn) and phone. The method adds
two more: iban (mod-97) and ssn. A proposal of those starts with the score of
its pattern; a checksum that holds raises it, one that fails drops it; a
context word within `CONTEXT` characters raises it, a word that speaks of
something else lowers it, but not against a checksum that holds. Proposals of
`ACCEPT` and more are spans. An iban may end at any border of a token: its
country's registered length is tried first, then the other ends, longest first.

Every pattern runs in time linear in the text: a run of digits or address
characters is entered at its start only, which changes no leftmost match.

Defined cases: a null text counts as empty; spans are counted in code points,
end exclusive; repeated rows are judged each; an empty table gives an empty
result; other columns are not read (or, in `redacted`, kept as they are).
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierhouse.llm.common import mapped

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
#: Characters on either side in which context words count.
CONTEXT = 40
ACCEPT = 0.6

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
#: Each start, with the longest text that could belong to it.
_IBAN = re.compile(r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])))")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

#: Registered lengths of ibans by country.
_IBAN_LENGTHS = {
    c: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for c in countries.split()
}

#: kind: (score of the pattern, words that raise it by 0.3, words that lower it by 0.4)
_SCORES = {
    "iban": (0.4, re.compile(r"\b(iban|account|konto|cuenta|compte|bank|bic)\b", re.I), None),
    "ssn": (0.4, re.compile(r"\b(ssn|social|security|taxpayer)\b", re.I), re.compile(r"\b(isbn|serial|part|phone|tel)\b", re.I)),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def mod97(text: str) -> bool:
    turned = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _ibans(text: str) -> list[tuple[int, int]]:
    """Spans of a registered country and its length, whose checksum holds."""
    found, end = [], 0
    for m in _IBAN.finditer(text):
        if m.start() < end:
            continue
        run = m[1]
        due = _IBAN_LENGTHS.get(run[:2])
        for e in (len(run), *(i for i in range(len(run) - 1, 0, -1) if run[i] == " ")):
            bare = run[:e].replace(" ", "")
            if len(bare) == due and mod97(bare):
                end = m.start() + e
                found.append((m.start(), end))
                break
    return found


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def _emails(text: str) -> list[tuple[int, int]]:
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            found.append((start, m.end()))
            end = m.end()
            at = text.find("@", end)
        else:
            at = text.find("@", at + 1)
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the four base kinds, by kind as listed, then start."""
    found = [("email", *span) for span in _emails(text)]
    for m in _IP.finditer(text):
        if all(_octet(p) for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _DIGITS.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def added_spans(text: str) -> list[tuple[str, int, int, float]]:
    """Spans of the other kinds with their scores."""
    found = []
    for kind, spans in (("iban", _ibans(text)), ("ssn", [m.span() for m in _SSN.finditer(text)])):
        base, good, bad = _SCORES[kind]
        confirmed = kind == "iban"  # its checksum holds
        for start, end in spans:
            near = text[max(0, start - CONTEXT) : start] + "\n" + text[end : end + CONTEXT]
            score = base + 0.3 * bool(good.search(near)) + (0.4 if confirmed else -0.4 * bool(bad.search(near)))
            if score >= ACCEPT:
                found.append((kind, start, end, score))
    return found


def _listed(spans: list) -> str:
    return ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in spans)


def pii_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: counts of the base kinds, a digest of their spans, and all spans."""

    def measure(texts: pa.Array) -> list:
        counts, digests, spans = [[] for _ in BASE_KINDS], [], []
        for t in texts.to_pylist():
            base = base_spans(t or "")
            for column, kind in zip(counts, BASE_KINDS):
                column.append(sum(s[0] == kind for s in base))
            digests.append(hashlib.sha256(_listed(base).encode()).hexdigest())
            spans.append(_listed([*base, *added_spans(t or "")]))
        return [*(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())]

    fields = [(f"n_{k}", T.LongType()) for k in BASE_KINDS] + [("base_sha256", T.StringType()), ("spans", T.StringType())]
    return mapped(docs, text, [doc_id], fields, measure).withColumnRenamed(doc_id, "doc_id")


def redact(text: str | None) -> str | None:
    """The text with each span replaced by its kind; spans that overlap count as one, named by the first."""
    if not text:
        return text
    spans = sorted(((s[1], s[2], s[0]) for s in [*base_spans(text), *added_spans(text)]), key=lambda s: (s[0], -s[1]))
    out, end = [], 0
    for start, stop, kind in spans:
        if start >= end:
            out += [text[end:start], f"<{kind.upper()}>"]
        end = max(end, stop)
    return "".join([*out, text[end:]])


def redacted(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with personal data replaced; `length` is set to the new text's."""

    def measure(texts: pa.Array) -> list:
        return [pa.array([redact(t) for t in texts.to_pylist()], pa.string())]

    keep = [c for c in docs.columns if c != text]
    rows = mapped(docs, text, keep, [("__redacted", T.StringType())], measure)
    made = {text: F.col("__redacted")}
    if length in docs.columns:
        made[length] = F.coalesce(F.length("__redacted").cast(docs.schema[length].dataType), F.col(length))
    return rows.select(*(made.get(c, F.col(c)).alias(c) for c in docs.columns))
