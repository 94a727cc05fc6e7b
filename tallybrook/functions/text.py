"""Names: normal forms of items, vendors, equipment, bids and urls. Each concept keeps its own variants, by name."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallybrook.functions.dates import let


@F.pandas_udf(StringType())
def _nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: v if v is None or v.isascii() else unicodedata.normalize("NFKC", v), na_action="ignore")


def nfkc(value: Column) -> Column:
    """Compatibility normal form: Spark has none built in, so an Arrow function, for texts that are not ASCII only."""
    return F.when(value.rlike("^[\\x00-\\x7F]*$"), value).otherwise(_nfkc(value))


@F.pandas_udf(StringType())
def cp932_repaired(values: pd.Series) -> pd.Series:
    """Text that was read as Latin-1 but was written in code page 932."""

    def fix(v: str | None) -> str | None:
        try:
            return v.encode("latin-1").decode("cp932") if v else v
        except UnicodeError:
            return v

    return values.map(fix, na_action="ignore")


#: Marks that names of items, and of programmes, are stripped of after NFKC; dashes that it leaves.
ITEM_MARKS = r"[\s\x1c-\x1f\x85、,。・/_\-‐ー()「」『』【】\[\]]+"
PROGRAMME_MARKS = r"[\s\x1c-\x1f\x85\-―ー~〜・,、.。:;'\"()\[\]【】「」『』]"
DASHES = "‐‑‒–—―−"
#: Legal forms that move behind a name, and those that keep one in front where they stand inside.
FORMS, INNER_FORMS = "株式会社|有限会社|合同会社|合名会社|合資会社", "株式会社|有限会社|合同会社"


def item_name(value: Column) -> Column:
    """Without marks and lower-cased; NULL gives ''."""
    return F.lower(F.regexp_replace(nfkc(F.coalesce(value, F.lit(""))), ITEM_MARKS, ""))


def programme_name(value: Column) -> Column:
    return F.lower(F.regexp_replace(nfkc(F.coalesce(value, F.lit(""))), PROGRAMME_MARKS, ""))


def equipment_name(value: Column) -> Column:
    return F.translate(nfkc(value), DASHES, "-" * len(DASHES))


def stripped(value: Column) -> Column:
    return F.regexp_replace(value, r"^[\s\x1c-\x1f\x85]+|[\s\x1c-\x1f\x85]+$", "")


def without_parentheses(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, r"(\s*[（(][^)）]*[)）])+\s*$", ""))


def vendor(value: Column) -> Column:
    """Legal forms in full; a form in front moves behind, unless another stands inside."""
    full = nfkc(value)
    for short, long in (("(株)", "株式会社"), ("(有)", "有限会社"), ("(合)", "合同会社")):
        full = F.replace(full, F.lit(short), F.lit(long))
    form, rest = (F.regexp_extract(full, rf"^({FORMS})\s*(.+)$", i) for i in (1, 2))
    moved = F.when((form != "") & ~rest.rlike(INNER_FORMS), F.concat(stripped(rest), form)).otherwise(full)
    return F.nullif(stripped(F.regexp_replace(moved, r"\s+", " ")), F.lit(""))


def vendor_plain(value: Column) -> Column:
    """The ledger's own column: two forms in full, nothing moved; '' stays ''."""
    full = nfkc(value)
    for short, long in (("(株)", "株式会社"), ("(有)", "有限会社")):
        full = F.replace(full, F.lit(short), F.lit(long))
    return stripped(full)


def lines_of(cell: Column) -> Column:
    return F.filter(F.transform(F.split(cell, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def vendor_and_address(cell: Column) -> tuple[Column, Column]:
    return vendor_of_lines(lines_of(cell))


def vendor_of_lines(lines: Column) -> tuple[Column, Column]:
    name = F.substring(F.try_element_at(lines, F.lit(1)), 1, 300)
    rest = F.nullif(F.array_join(F.slice(lines, 2, 1000), " / "), F.lit(""))
    return name, F.substring(rest, 1, 500)


def corporate_number(value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    return F.when(digits.rlike("^[0-9]{13}$"), digits)


def by_rules(value: Column, rules: list[tuple[str, str]], other: Column) -> Column:
    """The label of the first rule whose text the value contains."""
    out = F.when(value.isNull() | (value == ""), F.lit(None).cast("string"))
    for text, label in rules:
        out = out.when(F.contains(value, F.lit(text)), F.lit(label))
    return out.otherwise(other)


def bid_method(value: Column, rules: list[tuple[str, str]]) -> Column:
    return by_rules(F.trim(value), rules, F.substring(F.trim(value), 1, 30))


def bid_class(value: Column) -> Column:
    return F.when(F.contains(value, F.lit("随")), "随契").when(value.isNotNull(), "競争")


def unwrapped_url(url: Column) -> Column:
    """The page that an archive url holds."""
    inner = F.regexp_extract(url, r"^https?://[^/]*(?:warp|web\.archive)[^/]*/(?:[^/]+/)*?(https?://.*|[a-z0-9.-]+\.[a-z]{2,}/.*)$", 1)
    return F.when(inner == "", url).otherwise(inner)


def file_type(url: Column) -> Column:
    path = F.lower(F.regexp_extract(unwrapped_url(url), r"^[^?#]*", 0))
    out = F.when(path.endswith(".pdf"), "pdf").when(path.rlike(r"\.xlsx?$"), "excel").when(path.endswith(".csv"), "csv")
    return out.otherwise("html")


def basename(url: Column) -> Column:
    return F.element_at(F.split(F.regexp_extract(url, r"^[^?#]*", 0), "/"), -1)


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://([^/?#:]+)", 1)


def cache_key(url: Column) -> Column:
    return F.substring(F.sha2(url, 256), 1, 16)


def trailing_digits(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"([0-9]+)(?:\.[A-Za-z]+)?$", 1), F.lit(""))


def rolling_months(digits: Column) -> Column:
    """'456789101112123' -> [4, ..., 12, 1, 2, 3]: two digits where they read 10 to 12 and do not repeat; [] on a repeat."""
    start = F.struct(F.array().cast("array<int>").alias("out"), F.lit(1).alias("at"), F.lit(True).alias("ok"))

    none = F.array().cast("array<int>")

    def walk(digits: Column) -> Column:
        def step(a: Column, _: Column) -> Column:
            two, one = F.substring(digits, a.at, F.lit(2)).try_cast("int"), F.substring(digits, a.at, F.lit(1)).try_cast("int")
            take = F.substring(digits, a.at, F.lit(2)).isin("10", "11", "12") & ~F.array_contains(a.out, two)

            def told(s: Column) -> Column:
                again = F.array_contains(a.out, s["month"]) | (s["month"] == 0)
                return F.struct(F.when(again, a.out).otherwise(F.array_append(a.out, s["month"])).alias("out"), (a.at + F.when(s["take"], 2).otherwise(1)).alias("at"), (a.ok & ~again).alias("ok"))

            return F.when(a.at > F.length(digits), a).otherwise(let(let(take, lambda t: F.struct(t.alias("take"), F.when(t, two).otherwise(one).alias("month"))), told))

        return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), start, step, lambda a: F.when(a.ok, a.out).otherwise(none))

    walked = let(digits, walk)
    # where no pair of digits from 10 to 12 stands twice, months are what one pattern cuts, and any other repeat is none
    tokens = F.regexp_extract_all(digits, F.lit("1[012]|[0-9]"), F.lit(0))
    cut = F.when((F.size(F.array_distinct(tokens)) == F.size(tokens)) & ~F.array_contains(tokens, "0"), tokens.cast("array<int>")).otherwise(none)
    return F.when(digits.rlike("^[0-9]*\\z") & ~digits.rlike("10.*10|11.*11|12.*12"), cut).otherwise(walked)


def truncated(value: Column, n: int) -> Column:
    return F.when(F.char_length(value) > n, F.concat(F.substring(value, 1, n), F.lit("…"))).otherwise(F.coalesce(value, F.lit("-")))


def listed(values: Column, most: int = 12) -> Column:
    """The first few joined, and how many more there are."""
    more = F.size(values) - most
    return F.when(more > 0, F.concat(F.array_join(F.slice(values, 1, most), ", "), F.format_string(" 他%d件", more))).otherwise(F.array_join(values, ", "))


def model_names(value: Column) -> Column:
    """Spellings of a model, in order: F-35A -> [F-35, F-35A, F35, F35A]; CH-47J/JA also gives both models apart."""
    bare = lambda c: F.replace(c, F.lit("-"), F.lit(""))
    first, other = F.regexp_extract(value, "^([^/]*)/", 1), F.regexp_extract(value, "^[^/]*/(?s)(.*)$", 1)
    second = F.concat(F.regexp_replace(first, "[A-Za-z]+$", ""), other)
    slash, base = F.contains(value, F.lit("/")), F.regexp_extract(value, "^([A-Za-z]+-?[0-9]+)", 1)
    each = [value, bare(value), *(F.when(slash, c) for c in (first, bare(first), second, bare(second))), base, bare(base)]
    return F.sort_array(F.array_distinct(F.filter(F.array(*each), lambda x: x.isNotNull() & (x != ""))))
