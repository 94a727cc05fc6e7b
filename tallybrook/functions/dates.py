"""Dates: fiscal years that begin in April, and the several spellings that published tables use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: First years of the eras, less one.
ERA_BASE = {"令和": 2018, "平成": 1988, "昭和": 1925, "R": 2018, "H": 1988, "S": 1925}
#: Day 0 of spreadsheet serial dates.
SERIAL_ZERO = "1899-12-30"


def fiscal_year(day: Column) -> Column:
    return F.year(F.add_months(day, -3))


def fiscal_year_of_text(text: Column) -> Column:
    """From YYYYMMDD; NULL unless eight characters."""
    year, month = F.substring(text, 1, 4).try_cast("int"), F.substring(text, 5, 2).try_cast("int")
    return F.when(F.char_length(text) == 8, F.when(month >= 4, year).otherwise(year - 1))


def month_of_text(text: Column) -> Column:
    return F.substring(text, 5, 2).try_cast("int")


def fiscal_month(month: Column) -> Column:
    """April 4 ... December 12, January 13 ... March 15."""
    return F.when(month >= 4, month).otherwise(month + 12)


def fiscal_order(month: Column) -> Column:
    return (month + 8) % 12


def let(value: Column, f) -> Column:
    """f(value) with the value worked out once: within lambdas of arrays Catalyst merges no equal expressions."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _eight(year: Column, month: Column, day: Column) -> Column:
    """YYYYMMDD of numbers of four, two and two digits at most; a formatter takes several times as long."""
    return F.concat(*(F.lpad(n.cast("string"), k, "0") for n, k in ((year, 4), (month, 2), (day, 2))))


def _ymd(year: Column, month: Column, day: Column) -> Column:
    fits = month.between(1, 12) & day.between(1, 31)
    return F.when(fits, _eight(year, month, day))


def _parts(text: Column, pattern: str) -> tuple[Column, Column, Column]:
    return tuple(F.regexp_extract(text, pattern, i).try_cast("int") for i in (1, 2, 3))


def date_text(value: Column) -> Column:
    """YYYYMMDD of a cell: spreadsheet serial, era date (years 1 to 20 of the present era come first), Gregorian, eight digits.

    Dates stand at the cell's begin; a Gregorian one has no point, and its month and day are taken as they are.
    """
    text = F.translate(F.trim(value), "０１２３４５６７８９", "0123456789")
    serial = F.when(text.rlike(r"^[3-6][0-9]{4}(\.0+)?$"), F.date_format(F.date_add(F.lit(SERIAL_ZERO).cast("date"), F.regexp_extract(text, "^([0-9]+)", 1).try_cast("int")), "yyyyMMdd"))
    y, m, d = _parts(text, r"^[Rr令和]*\s*([0-9]{1,2})[.年/]([0-9]{1,2})[.月/]([0-9]{1,2})")
    era = F.when(y.between(1, 20), _ymd(y + ERA_BASE["R"], m, d))
    gregorian = r"^([0-9]{4})[-/年]([0-9]{1,2})[-/月]([0-9]{1,2})"
    digits = [F.regexp_extract(text, gregorian, i) for i in (1, 2, 3)]
    plain = F.when(text.rlike(gregorian), F.concat(digits[0], *(F.lpad(x, 2, "0") for x in digits[1:])))
    return F.coalesce(serial, era, plain, F.when(text.rlike("^[0-9]{8}$"), text))


def spaced_era_date(value: Column) -> Column:
    """The variant of page text: the era's mark may stand anywhere, digits may be spaced."""
    y, m, d = _parts(value, r"(?:令和|R)\s*([0-9]{1,2})\s*[.年]\s*([0-9]{1,2})\s*[.月]\s*([0-9]{1,2})")
    era = _ymd(y + ERA_BASE["R"], m, d)
    y, m, d = _parts(value, r"([0-9]{4})\s*[-/.年]\s*([0-9]{1,2})\s*[-/.月]\s*([0-9]{1,2})")
    return F.coalesce(era, _ymd(y, m, d))


def _either(text: Column, era: str, three: str | None = None) -> Column:
    """YYYYMMDD of an era date (years 1 to 20 of the present era) anywhere, else a Gregorian one as it is, else a bare triplet."""
    def read(t: Column, pattern: str, told) -> Column:
        of = lambda t: F.struct(*(p.alias(n) for n, p in zip("ymd", _parts(t, pattern), strict=True)))
        return F.when(t.rlike(pattern), let(of(t), lambda p: told(p["y"], p["m"], p["d"])))

    present = lambda y, m, d: F.when(y.between(1, 20), _ymd(y + ERA_BASE["R"], m, d))
    plain = lambda y, m, d: F.when(y.isNotNull(), _eight(y, m, d))
    ways = [(era, present), (r"([0-9]{4})[-/年]([0-9]{1,2})[-/月]([0-9]{1,2})", plain), *([(three, present)] if three else [])]
    return let(text, lambda t: F.coalesce(*(read(t, pattern, told) for pattern, told in ways)))


def page_date(text: Column) -> Column:
    """The date of a cell of page text; "6 . 4 . 1" alone is a date of the present era."""
    return _either(F.trim(text), r"(?:令和|R)\s*([0-9]{1,2})[./年]([0-9]{1,2})[./月]([0-9]{1,2})", r"^([0-9]{1,2})\s*\.\s*([0-9]{1,2})\s*\.\s*([0-9]{1,2})$")


def scan_date(text: Column) -> Column:
    """The date of recognised text: digits of an era date may be spaced."""
    return _either(F.trim(text), r"(?:令和|[Rr])\s*([0-9]{1,2})\s*[./年]\s*([0-9]{1,2})\s*[./月]\s*([0-9]{1,2})")


def era_year(text: Column) -> Column:
    """令和元年度 -> 2019."""
    out = F.lit(None).cast("int")
    for era in ("令和", "平成", "昭和"):
        n = F.regexp_extract(text, f"{era}\\s*(元|[0-9]+)\\s*年", 1)
        out = F.coalesce(out, F.when(n == "元", F.lit(ERA_BASE[era] + 1)).otherwise(F.nullif(n, F.lit("")).try_cast("int") + ERA_BASE[era]))
    return out


def era_label(year: Column) -> Column:
    return F.when(year >= 2019, F.format_string("R%d", year - 2018)).otherwise(F.format_string("H%d", year - 1988))


def display(text: Column) -> Column:
    return F.when(F.char_length(text) == 8, F.concat_ws("/", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))).otherwise(text)


def months_covered(first: Column, last: Column, year: Column) -> Column:
    """Months of a fiscal year between two dates, clamped to it, in fiscal order."""
    begin, end = F.make_date(year, F.lit(4), F.lit(1)), F.make_date(year + 1, F.lit(3), F.lit(31))
    a, b = F.trunc(F.greatest(first, begin), "month"), F.trunc(F.least(last, end), "month")
    return F.when(a <= b, F.transform(F.sequence(a, b, F.expr("interval 1 month")), lambda d: F.month(d)))
