"""Lines of reports: bullets under headings, amounts in pages of a category, file names with dates, unit detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.functions import amounts, dates, rules, text


def bullets(lines: DataFrame, heading: str, bullet: str) -> DataFrame:
    """(file_id, page, line, section, name) of lines that match `bullet` (group 1), under the last line that matched `heading` (group 1)."""
    order = Window.partitionBy("file_id").orderBy("page", "line").rowsBetween(Window.unboundedPreceding, 0)
    section = F.last(F.nullif(F.regexp_extract("text", heading, 1), F.lit("")), ignorenulls=True).over(order)
    name = text.without_parentheses(F.trim(F.regexp_extract("text", bullet, 1)))
    return lines.withColumns({"section": section, "name": name}).where(rules.name_is_valid(F.col("name"))).select("file_id", "page", "line", "section", "name")


def category_lines(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """Names and amounts (in 億) of a plan whose pages belong to categories; a line may hold several bullets."""
    parts = lines.join(pages, ["file_id", "page"]).select("file_id", "page", "category", F.explode(F.split("text", "[○●・■]")).alias("part"))
    name = F.trim(F.regexp_replace("part", r"[(（]?[0-9,兆億]+円.*$", ""))
    return parts.select("file_id", "page", "category", name.alias("name"), amounts.oku(F.col("part")).alias("oku")).where(rules.name_is_valid(F.col("name")))


def sections(texts: DataFrame, heads: list[tuple[int, str]]) -> DataFrame:
    """(file_id, section, body) of texts (file_id, text): a section goes from the first place of its head to the first place of
    the next head in the list that stands behind it, else to the end. Heads that a text lacks give nothing."""
    at = F.array(*(F.struct(F.lit(n).alias("section"), F.instr("text", h).alias("at")) for n, h in heads))
    held = texts.select("file_id", "text", at.alias("heads")).select("file_id", "text", "heads", F.posexplode("heads").alias("i", "h")).where("h.at > 0")
    later = F.get(F.filter(F.slice("heads", F.col("i") + 2, F.lit(len(heads))), lambda x: x["at"] > F.col("h.at")), F.lit(0))["at"]
    end = F.coalesce(later, F.char_length("text") + 1)
    return held.select("file_id", F.col("h.section").alias("section"), F.substr("text", F.col("h.at"), end - F.col("h.at")).alias("body"))


def narratives(texts: DataFrame, heads: list[tuple[int, str]], keywords: list[tuple[str, int, str]], known: DataFrame | None = None) -> DataFrame:
    """(file_id, section, name, context) of programmes (pattern, section, name) that the prose of texts names: sought in their
    section, or in the whole text if it has other sections but not theirs; a text without sections gives none. A name counts once
    a file, by its first pattern, and not at all where `known` (file_id, name) has it."""
    parts = sections(texts, heads)
    held = texts.join(parts.groupBy("file_id").agg(F.map_from_entries(F.collect_list(F.struct("section", "body"))).alias("parts")), "file_id")
    part = lambda n: F.coalesce(F.try_element_at("parts", F.lit(n)), F.col("text"))
    seen = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(n).alias("section"), F.lit(name).alias("name"), F.nullif(F.regexp_extract(part(n), p, 0), F.lit("")).alias("context")) for i, (p, n, name) in enumerate(keywords)))
    rows = held.select("file_id", F.inline(F.filter(seen, lambda x: x["context"].isNotNull())))
    rows = rows.groupBy("file_id", "name").agg(F.min_by(F.struct("section", "context"), "i").alias("r")).select("file_id", "r.section", "name", F.substring("r.context", 1, 150).alias("context"))
    return rows if known is None else rows.join(known.select("file_id", "name"), ["file_id", "name"], "left_anti")


def with_neighbour(lines: DataFrame, pattern: str) -> DataFrame:
    """Lines that fit, with the texts before and after them."""
    w = Window.partitionBy("file_id", "page").orderBy("line")
    return lines.withColumns({"before": F.lag("text").over(w), "after": F.lead("text").over(w)}).where(F.col("text").rlike(pattern))


def dated_results(files: DataFrame) -> DataFrame:
    """(file, contract_date, fiscal_year, contract_amount, vendor_name) of one-contract files with cells: the date of the name, the
    first amount of 10,000 or more, the last cell of text. A ninth digit in a date is a slip of the pen."""
    digits = F.regexp_extract("file", r"((?:19|20)[0-9]{6,7})", 1)
    date = F.when(F.length(digits) == 9, F.concat(F.substring(digits, 1, 4), F.substring(digits, 6, 4))).when(F.length(digits) == 8, digits)
    money = F.try_element_at(F.filter(F.transform("cells", lambda c: amounts.amount(F.when(c.rlike(r"^[\s\d,，円¥￥.-]+$"), c))), lambda x: x >= 10_000), F.lit(1))
    vendor = F.try_element_at(F.filter("cells", lambda c: c.rlike("[^\\d\\s,，円¥￥.-]")), F.lit(-1))
    return files.select("file", date.alias("contract_date"), dates.fiscal_year_of_text(date).alias("fiscal_year"), money.alias("contract_amount"), F.trim(vendor).alias("vendor_name")).where("contract_amount is not null")


def yearly_totals(rows: DataFrame, low: float, high: float) -> DataFrame:
    """Totals whose unit differs by year, scaled to the first plausible one."""
    return rows.withColumn("total_100m", amounts.scaled(F.col("total"), low, high))


def planned_items(grid: DataFrame, codes: dict[str, str]) -> DataFrame:
    """Rows whose first cell is a known code: organisation, item, its normal form, month in fiscal numbering."""
    cell = lambda i: F.try_element_at("cells", F.lit(i))
    month = rules.month_of_text(cell(4))
    org = rules.mapped(cell(1), codes, F.lit(None).cast("string"))
    return grid.select("file_id", "row", org.alias("org"), cell(2).alias("item_name"), text.item_name(cell(2)).alias("item_name_norm"), cell(3).alias("qty"), dates.fiscal_month(month).alias("contract_month")).where("org is not null and item_name is not null")


def portal_rows(lines: DataFrame) -> DataFrame:
    """Table rows under headings that carry an era year and a kind."""
    order = Window.partitionBy("file_id").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    year = F.last(F.when(F.col("is_heading"), dates.era_year(F.col("text"))), ignorenulls=True).over(order)
    kind = F.last(F.when(F.col("is_heading"), F.nullif(F.regexp_extract("text", "(事前|中間|事後|期中)", 1), F.lit(""))), ignorenulls=True).over(order)
    return lines.withColumns({"fiscal_year": year, "kind": kind}).where(~F.col("is_heading"))


def without_placeholders(rows: DataFrame) -> DataFrame:
    """Drops the placeholder "0一式" and continuation lines that have neither date nor amount."""
    return rows.where(~F.coalesce(F.col("quantity") == "0一式", F.lit(False)) & (F.col("contract_date").isNotNull() | F.col("contract_amount").isNotNull()))
