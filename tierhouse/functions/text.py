"""Text cleansing rules as Column functions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_AVAILABLE = "n/a"

# The Unicode White_Space characters, which TRIM removes.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Characters after which INITCAP starts a new word, besides whitespace.
WORD_DELIMITERS = '[](){}/|\\<>!?@"^#$&~_,.:;*%+-'

# Code tables of the source systems.
MARITAL_STATUS = {"S": "Single", "M": "Married"}
GENDER_CODE = {"F": "Female", "M": "Male"}
GENDER_CODE_OR_WORD = {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
COUNTRY_CODE = {"DE": "Germany", "US": "United States", "USA": "United States"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _plain(char: Column) -> Column:
    return F.ascii(char).between(33, 126)


def ws_trim(c: Column | str) -> Column:
    """Trim all whitespace; Spark's own trim() only removes U+0020.

    Text that already starts and ends with a printable ASCII character after
    the fast blank trim skips the slower search of the whole set.
    """
    text = F.trim(_col(c))
    clean = _plain(text) & _plain(F.substring(text, -1, 1))
    return F.when(clean, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def decode(
    c: Column | str,
    labels: Mapping[str, str],
    default: str | None = NOT_AVAILABLE,
    fold_case: bool = True,
    passthrough: bool = False,
) -> Column:
    """Trimmed code looked up in `labels`.

    With `passthrough` an unknown non-blank code is returned trimmed; otherwise
    it becomes `default`, as NULL and blank always do. Codes in `labels` are
    upper case when `fold_case` is on.
    """
    text = ws_trim(c)
    code = F.upper(text) if fold_case else text
    by_label: dict[str, list[str]] = {}
    for key, label in labels.items():
        by_label.setdefault(label, []).append(key)
    out = None
    for label, keys in by_label.items():
        hit = code == keys[0] if len(keys) == 1 else code.isin(*keys)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    rest = F.when(text.isNull() | (text == ""), F.lit(default)).otherwise(text) if passthrough else F.lit(default)
    return rest if out is None else out.otherwise(rest)


def marital_status(c: Column | str) -> Column:
    return decode(c, MARITAL_STATUS)


def gender_code(c: Column | str) -> Column:
    """F / M only."""
    return decode(c, GENDER_CODE)


def gender(c: Column | str) -> Column:
    """F / Female / M / Male in any case."""
    return decode(c, GENDER_CODE_OR_WORD)


def product_line(c: Column | str) -> Column:
    return decode(c, PRODUCT_LINE)


def country(c: Column | str) -> Column:
    """Country codes to names; case-sensitive, so `de` stays `de`."""
    return decode(c, COUNTRY_CODE, fold_case=False, passthrough=True)


def title_case(c: Column | str) -> Column:
    """Capitalise each word, where punctuation also starts a word (`o-brien` -> `O-Brien`).

    Spark's initcap() only knows blanks, so it is applied to each run between
    delimiters.
    """
    marks = "".join("\\" + ch for ch in WORD_DELIMITERS)
    runs = F.regexp_extract_all(_col(c), F.lit(f"([{marks}\\s]+|[^{marks}\\s]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def clean_name(c: Column | str, style: str = "trim") -> Column:
    """`trim` keeps the case, `title` also applies title_case."""
    if style == "trim":
        return ws_trim(c)
    if style == "title":
        return title_case(ws_trim(c))
    raise ValueError(f"unknown name style {style!r}")


def clean_email(c: Column | str) -> Column:
    return F.lower(ws_trim(c))


def name_part(c: Column | str, index: int, pre_trim: bool = False) -> Column:
    """The index-th blank-separated token, trimmed; NULL if there is none.

    The untrimmed name is split by default, so leading blanks give empty
    tokens; `pre_trim=True` trims first.
    """
    source = ws_trim(c) if pre_trim else _col(c)
    return ws_trim(F.get(F.split(source, " "), F.lit(index)))


def category_of_key(c: Column | str) -> Column:
    """First five characters of a composed product key, `-` as `_`."""
    return F.replace(F.substr(_col(c), F.lit(1), F.lit(5)), F.lit("-"), F.lit("_"))


def product_of_key(c: Column | str) -> Column:
    """A composed product key from its seventh character on."""
    return F.substr(_col(c), F.lit(7))


def strip_prefix(c: Column | str, prefix: str = "NAS") -> Column:
    col = _col(c)
    return F.when(F.startswith(col, F.lit(prefix)), F.substr(col, F.lit(len(prefix) + 1))).otherwise(col)


def strip_separator(c: Column | str, separator: str = "-") -> Column:
    return F.replace(_col(c), F.lit(separator), F.lit(""))


def is_digits(c: Column | str) -> Column:
    """Only ASCII digits; `\\z`, since `$` also accepts a trailing newline."""
    return F.rlike(_col(c), F.lit(r"^[0-9]+\z"))


def is_present(c: Column | str) -> Column:
    """Neither NULL nor blank."""
    return F.coalesce(ws_trim(c) != "", F.lit(False))


def template(fmt: str, *args: Column) -> Column:
    """format_string with NULL arguments shown as `NULL`, so a message is never lost."""
    return F.format_string(fmt, *[F.coalesce(a.cast("string"), F.lit("NULL")) for a in args])
