"""Ordered rules as columns: years in addresses, kinds of file, agencies, units, terms of names. The rules are arguments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybrook.functions import text


def year_of_url(url: Column) -> Column:
    """Fiscal year in an address, by the first of: fy2024, an era year with its month (r6.3 is of 2023), an era year as a
    whole part, a calendar year as a whole part."""
    page = text.unwrapped_url(url)
    number = lambda p, i=1: F.nullif(F.regexp_extract(page, p, i), F.lit("")).try_cast("int")
    with_month = r"[rR]0?([0-9]{1,2})[.\-_/]([0-9]{1,2})"
    era, month, alone = number(with_month), number(with_month, 2), number(r"(?i)[/\-_]r0?([0-9]{1,2})[/\-_]")
    dated = F.when(era.between(1, 20) & month.between(1, 12), F.when(month >= 4, era + 2018).otherwise(era + 2017))
    return F.coalesce(number(r"(?i)fy(202[2-9])"), dated, F.when(alone.between(1, 20), alone + 2018), number(r"[/\-_](202[2-9])[/\-_]"))


def by_keywords(value: Column, rules: list[tuple[list[str], str]], other: str | None = None) -> Column:
    """The label of the first rule of which the value has a keyword."""
    low = F.lower(value)
    hit = lambda words: reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for words, label in rules:
        out = out.when(hit(words), F.lit(label))
    return out.otherwise(F.lit(other))


def by_prefix(agency: Column, rules: list[tuple[str, str]], exact_without: str | None = None, other: str | None = None) -> Column:
    """The label of the first prefix; with `exact_without`, rules that lack that ending must equal the whole value."""
    out = F.when(F.lit(False), F.lit(""))
    for prefix, label in rules:
        whole = exact_without is not None and not prefix.endswith(exact_without)
        out = out.when(agency == prefix if whole else F.startswith(agency, F.lit(prefix)), F.lit(label))
    return out.otherwise(F.lit(other))


def mapped(value: Column, direct: dict[str, str], other: Column) -> Column:
    """A value's entry in a small map, else another column."""
    table = F.create_map(*(F.lit(x) for kv in direct.items() for x in kv)) if direct else F.create_map().cast("map<string,string>")
    return F.coalesce(F.try_element_at(table, value), other)


def longest_keyword(value: Column, rules: list[tuple[str, str]]) -> Column:
    """The label of the longest keyword in the value, the part in parentheses first."""
    inner = F.regexp_extract(value, r"[（(]([^)）]*)[)）]", 1)
    ordered = sorted(rules, key=lambda r: (-len(r[0]), r[0]))
    scan = lambda v: reduce(lambda c, r: c.when(F.contains(v, F.lit(r[0])), F.lit(r[1])), ordered, F.when(F.lit(False), F.lit("")))
    return F.coalesce(scan(inner), scan(value))


def bid_cleaned(value: Column, rules: list[tuple[list[str], str]], unknown: list[str]) -> Column:
    """The ledger's clean-up: spaces out, ordered keywords, marks of the unknown to NULL, else as it is."""
    compact = F.regexp_replace(text.nfkc(value), r"\s", "")
    return F.when(compact.isin("", *unknown), F.lit(None).cast("string")).otherwise(F.coalesce(by_keywords(compact, rules), value))


def bid_shown(value: Column, exact: dict[str, str], sole_source: list[str]) -> Column:
    """For display: exact names, words of sole source, dashes as unknown, else the first 30 characters."""
    v = F.trim(value)
    sole = reduce(lambda a, b: a | b, [F.contains(v, F.lit(w)) for w in sole_source], F.lit(False))
    return mapped(v, exact, F.when(sole, "随意契約").when(v.isNull() | v.rlike("^[-－ー―]*$"), "不明").otherwise(F.substring(v, 1, 30)))


def month_of_text(value: Column) -> Column:
    """'4月', '2024/4', '４' -> 4."""
    v = F.translate(value, "０１２３４５６７８９", "0123456789")
    number = lambda p: F.nullif(F.regexp_extract(v, p, 1), F.lit("")).try_cast("int")
    month = F.coalesce(number(r"([0-9]{1,2})\s*月"), number(r"[0-9]{4}[/.-]([0-9]{1,2})"), number(r"^\s*([0-9]{1,2})\s*$"))
    return F.when(month.between(1, 12), month)


def terms(name: Column, suffixes: list[str], generic: list[str], least: int = 4) -> Column:
    """The telling words of a programme's name."""
    stripped = reduce(lambda v, s: F.regexp_replace(v, f"{s}$", ""), suffixes, name)
    words = F.split(stripped, r"[\s・、,()（）]+")
    return F.array_distinct(F.filter(words, lambda w: (F.char_length(w) >= least) & ~w.isin(*generic) if generic else F.char_length(w) >= least))


def name_is_valid(name: Column, most: int = 100) -> Column:
    """Not a number, a page or a sentence."""
    return F.coalesce(name.rlike(r"[^\d\s.,()-]") & F.char_length(name).between(2, most) & ~name.rlike("[。]$"), F.lit(False))


def garbled(value: Column) -> Column:
    """Latin-1 letters where Japanese should be."""
    return F.coalesce(value.rlike("[\\x80-\\xff]{2,}") & ~value.rlike("[ぁ-んァ-ヶ一-龠]"), F.lit(False))


def url_variants(url: Column) -> Column:
    """Spellings of an address to try, in order, without repeats."""
    plain = F.regexp_replace(url, "#.*$", "")
    bare = F.regexp_replace(plain, r"\?.*$", "")
    other = F.when(F.startswith(plain, F.lit("https:")), F.regexp_replace(plain, "^https:", "http:")).otherwise(F.regexp_replace(plain, "^http:", "https:"))
    return F.array_distinct(F.array(url, plain, other, bare, F.regexp_replace(bare, "/index\\.html?$", "/"), F.regexp_replace(plain, "://www\\.", "://")))


def current_fiscal_year() -> Column:
    return F.year(F.add_months(F.current_date(), -3))


def kind_of_file(name: Column) -> Column:
    upper = F.upper(name)
    return F.when(F.contains(upper, F.lit("ZUIKEI")), "随契").when(upper.rlike(r"_K(?:[._]|$)"), "競争").otherwise(F.lit(None).cast("string"))


def effective_base(budget: Column, outside: Column, follow_up: Column) -> Column:
    """The denominator of coverage: NULL if a main part is."""
    return budget - outside - F.coalesce(follow_up, F.lit(0))
