"""Brazilian money, installment and rating text -> numbers.

Money stays ``DECIMAL(18,2)`` until the last cast, so totals are exact and
no rounding mode is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# Sentinels the bronze table uses for missing values.
MISSING_VALUE = -999.0
MISSING_COUNT = 0

_NUMBER = r"([0-9][0-9.]*(?:,[0-9]+)?)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def brl(text: Column | str) -> Column:
    """'R$ 1.234,56', 'ou R$ 1.234,56', '1.234' -> DECIMAL(18,2); NULL if no number.

    The first number of the text is taken; dots group thousands, the comma
    is the decimal mark.
    """
    num = F.regexp_extract(_c(text), _NUMBER, 1)
    return F.translate(num, ",.", ".").try_cast(MONEY)


def whole_plus_cents(whole: Column | str, cents: Column | str) -> Column:
    """Separate whole and cents nodes -> DECIMAL(18,2): '1.234' + '05' = 1234.05."""
    w = F.translate(_c(whole), ". ", "").try_cast(MONEY)
    ct = F.trim(_c(cents)).try_cast("int")
    return F.when(w.isNotNull(), (w + F.coalesce(ct, F.lit(0)).cast(MONEY) / 100).cast(MONEY))


def installment_count(text: Column | str) -> Column:
    """Up to two digits before the first 'x': '10x de R$ 1,00' -> 10."""
    return F.regexp_extract(_c(text), r"([0-9]{1,2})\s*x", 1).try_cast("int")


def value_after_currency(text: Column | str) -> Column:
    """Installment value after 'R$': '10x de R$ 123,45' -> 123.45."""
    return brl(F.split_part(_c(text), F.lit("R$"), F.lit(2)))


def total_count_value(text: Column | str) -> tuple[Column, Column, Column]:
    """'R$ 1.234,50 em 10x de R$ 123,45 sem juros' -> (total, count, value)."""
    t = _c(text)
    total = brl(F.split_part(t, F.lit(" em "), F.lit(1)))
    after = F.split_part(t, F.lit(" em "), F.lit(2))
    count = F.regexp_extract(after, r"([0-9]+)\s*x", 1).try_cast("int")
    value = brl(F.regexp_extract(after, r"x de\s*(.*)", 1))
    return total, count, value


def installment_total(value: Column, count: Column) -> Column:
    """value x count, exact in decimal; NULL when the value is missing."""
    return F.when(value.isNotNull(), (value * F.coalesce(count, F.lit(0))).cast(MONEY))


def rating_value(text: Column | str) -> Column:
    """'4.5 (123)' -> 4.5."""
    num = F.regexp_extract(_c(text), r"^\s*([0-9]+(?:[.,][0-9]+)?)", 1)
    return F.translate(num, ",", ".").try_cast("double")


def rating_users(text: Column | str) -> Column:
    """'4.5 (123)' or '(1.234)' -> number of raters."""
    num = F.regexp_extract(_c(text), r"\(([0-9.]+)\)", 1)
    return F.translate(num, ".", "").try_cast("int")


def as_double(money: Column) -> Column:
    return money.cast("double")
