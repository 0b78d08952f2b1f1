"""Number parsing and measure repair as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierhouse.functions.text import _col, ws_trim

NUMERIC = "decimal(38,9)"
_INTEGER = r"^[+-]?[0-9]+$"


def safe_long(c: Column | str) -> Column:
    """Trimmed text as a long, NULL if it is not one.

    Only text of an integer's shape is tried: a failing cast is many times dearer.
    """
    text = ws_trim(c)
    return F.when(text.rlike(_INTEGER), text.try_cast("bigint"))


def hard_long(c: Column | str) -> Column:
    """Trimmed text as a long; the job fails on anything else."""
    text = ws_trim(c)
    bad = F.raise_error(F.concat(F.lit("not an integer: "), text)).cast("bigint")
    return F.coalesce(F.when(text.rlike(_INTEGER), text.try_cast("bigint")), F.when(text.isNotNull(), bad))


def parse_price(c: Column | str) -> Column:
    """Currency text as decimal(38,9); NULL, blank, `free` and unparsable give 0."""
    amount = F.replace(ws_trim(c), F.lit("$"), F.lit(""))
    return F.coalesce(amount.try_cast(NUMERIC), F.lit(0).cast(NUMERIC))


def null_to_zero(c: Column | str) -> Column:
    col = _col(c)
    return F.coalesce(col, F.lit(0))


def repair_sales(sales: Column | str, quantity: Column | str, price: Column | str) -> Column:
    """quantity * |price| when sales is NULL, not positive or disagrees, else sales.

    A NULL price cannot disagree, but it makes the replacement NULL.
    """
    s, expected = _col(sales), _col(quantity) * F.abs(_col(price))
    return F.when(s.isNull() | (s <= 0) | (s != expected), expected).otherwise(s)


def repair_price(sales: Column | str, quantity: Column | str, price: Column | str) -> Column:
    """sales / quantity (integer, toward zero) when price is NULL or not positive, else price.

    Reads the raw sales, not the repaired one; zero quantity gives NULL.
    """
    s, q, p = _col(sales), _col(quantity), _col(price)
    derived = F.call_function("div", s, F.nullif(q, F.lit(0).cast("bigint")))
    return F.when(p.isNull() | (p <= 0), derived).otherwise(p)


def exact_amount(quantity: Column | str, unit_price: Column | str) -> Column:
    """quantity * unit_price without loss of scale; fails only if the product itself is beyond decimal(38,9).

    bigint * decimal(38,9) would be rounded to six decimals. Operands of up to 9
    and 19 whole digits multiply to exactly decimal(38,9). Larger ones are
    multiplied by limbs: the whole units and the billionths of the price apart,
    each as a whole number, with a carry from the second to the first. Whether
    the product fits is checked once, when its digits become a decimal again.
    """
    q, p = _col(quantity), _col(unit_price).cast(NUMERIC)
    small = (F.abs(q.cast("decimal(20,0)")) < F.lit("1000000000").cast("decimal(20,0)")) & (
        F.abs(p) < F.lit("1e19").cast(NUMERIC)
    )
    count, price, unit = F.abs(q.cast("decimal(19,0)")), F.abs(p), F.lit("1000000000").cast("decimal(10,0)")
    whole = count * F.floor(price).cast("decimal(29,0)")
    billionths = count * ((price % F.lit(1).cast("decimal(1,0)")) * unit).cast("decimal(9,0)")
    units = whole + F.call_function("div", billionths, unit).cast("decimal(19,0)")
    rest = F.lpad((billionths % unit).cast("decimal(9,0)").cast("string"), 9, "0")
    sign = F.when((q < 0) != (p < 0), "-").otherwise("")
    by_limbs = F.concat(sign, units.cast("string"), F.lit("."), rest).cast(NUMERIC)
    return F.when(small, q.cast("decimal(9,0)") * p.cast("decimal(28,9)")).otherwise(by_limbs)


def divide_or(numerator: Column | str, denominator: Column | str, fallback: float = 0.0) -> Column:
    """Floating quotient, `fallback` on division by zero."""
    return F.coalesce(F.try_divide(_col(numerator), _col(denominator)), F.lit(float(fallback)))


def cast_or(c: Column | str, data_type: str, fallback: object) -> Column:
    """Cast with `fallback` where the value does not convert (NULL stays NULL)."""
    col = _col(c)
    return F.coalesce(col.try_cast(data_type), F.when(col.isNotNull(), F.lit(fallback).cast(data_type)))
