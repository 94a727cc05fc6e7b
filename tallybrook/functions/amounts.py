"""Amounts and rates in text, by the rules of the three kinds of source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OKU = 100_000_000


def amount(value: Column) -> Column:
    """Spreadsheet cell: digits, point and minus; half-even to a whole number."""
    clean = F.regexp_replace(F.regexp_replace(value, "[,，円¥\\s]", ""), "[^0-9.-]", "")
    return F.bround(clean.try_cast("double")).cast("long")


def last_amount(value: Column) -> Column:
    """Page text: the last token whose digits, points and minus read as a number; half-even to a whole one."""
    tokens = F.transform(F.split(F.trim(value), r"\s+"), lambda t: F.regexp_replace(t, "[^0-9.-]", "").try_cast("double"))
    return F.bround(F.try_element_at(F.filter(tokens, lambda x: x.isNotNull()), F.lit(-1))).cast("long")


def unit_price_total(cells: Column) -> Column:
    """The planned total that a unit-price contract states in any cell."""
    found = F.transform(cells, lambda c: F.regexp_extract(c, "予定調達総額[^0-9]*([0-9][0-9,，]*)\\s*円", 1))
    return F.regexp_replace(F.try_element_at(F.filter(found, lambda x: x != ""), F.lit(1)), "[,，]", "").try_cast("long")


def first_nonzero(*options: Column) -> Column:
    """Zero counts as missing, as for NULL."""
    return F.coalesce(*(F.nullif(o, F.lit(0)) for o in options))


def rate(value: Column) -> Column:
    x = F.regexp_replace(value, "[%％\\s]", "").try_cast("double")
    return F.round(F.when(x <= 1.0, x * 100).otherwise(x), 2)


def oku(value: Column) -> Column:
    """Sum of the 兆 and 億 amounts of a text, in 億."""
    def total(unit: str, by: int) -> Column:
        found = F.regexp_extract_all(F.regexp_replace(value, "[,，]", ""), F.lit(f"([0-9]+(?:\\.[0-9]+)?)\\s*{unit}"), F.lit(1))
        return F.aggregate(found, F.lit(0.0), lambda a, x: a + x.try_cast("double") * by)

    return total("兆", 10_000) + total("億", 1)


def scaled(value: Column, low: float, high: float) -> Column:
    """The first plausible of value, value / 100 and value / 1e5."""
    return F.coalesce(*(F.when((value / s).between(low, high), value / s) for s in (1, 100, 100_000)))


def thousands(value: Column) -> Column:
    return F.coalesce(F.format_number(value, 0), F.lit("-"))


def bucket_rows(top: Column, size: float) -> Column:
    """Rows of a page by height, half to even."""
    return F.bround(top / size) * size
