"""Headerless grids (sheets, tables of cells) and positioned words to typed records.

A grid is a row per line: file_id, row, cells array<string>. Decoding of binary office files is outside; their grids come
as JSON or Parquet. Rules map header texts to fields: (ord, keyword, field), the first that matches a field wins.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.functions import amounts, dates, text
from tallybrook.lineage import cut
from tallybrook.sources import pages

#: A header is looked for in so many first rows.
HEADER_ROWS = 15
DITTO = ["〃", "々", '"', "”"]
RECORD = ["file_id", "row", "contract_name", "vendor_name", "vendor_address", "contract_amount", "contract_date", "bid_method", "fiscal_year"]


def header_rows(grid: DataFrame, words: list[str], least: int = 2, default: int | None = None) -> DataFrame:
    """file_id and the first row, within HEADER_ROWS, that has at least so many of the words."""
    joined = F.array_join(F.transform("cells", lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"\s", "")), "\u0001")
    hits = sum((F.contains(joined, F.lit(w)).cast("int") for w in words), F.lit(0))
    found = grid.where(F.col("row") < HEADER_ROWS).withColumn("_hits", hits).groupBy("file_id").agg(F.min(F.when(F.col("_hits") >= least, F.col("row"))).alias("header"))
    return found.withColumn("header", F.coalesce("header", F.lit(default).cast("int")))


def column_map(grid: DataFrame, headers: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """file_id, field, column: each field's first keyword, in order, and then the first column that has it. A header may be split over two rows."""
    near = grid.join(headers, "file_id").where(F.col("row").between(F.col("header"), F.col("header") + 1))
    cells = near.select("file_id", F.posexplode("cells").alias("column", "cell"), (F.col("row") == F.col("header")).alias("main"))
    merged = cells.groupBy("file_id", "column").agg(F.concat(F.coalesce(F.max(F.when(F.col("main"), F.col("cell"))), F.lit("")), F.lit("\u0001"), F.coalesce(F.max(F.when(~F.col("main"), F.col("cell"))), F.lit(""))).alias("title"))
    table = F.array(*(F.struct(F.lit(i).alias("ord"), F.lit(k).alias("keyword"), F.lit(f).alias("field")) for i, (k, f) in enumerate(rules)))
    title = F.regexp_replace(F.col("title"), r"\s", "")
    hits = merged.withColumn("r", F.explode(table)).where(F.contains(F.split(title, "\u0001")[0], F.col("r.keyword")))
    return hits.groupBy(F.col("file_id"), F.col("r.field").alias("field")).agg(F.min_by("column", F.struct("r.ord", "column")).alias("column"))


def records(grid: DataFrame, headers: DataFrame, columns: DataFrame, bid_rules: list[tuple[str, str]], target_year: int | None = None) -> DataFrame:
    """Typed rows below the header: ditto marks carried, lines without vendor and amount, or without name and amount, dropped."""
    by_field = columns.groupBy("file_id").agg(F.map_from_entries(F.collect_list(F.struct("field", "column"))).alias("map"))
    body = grid.join(headers, "file_id").where(F.col("row") > F.col("header")).join(by_field, "file_id")
    return _typed(body, lambda f: F.try_element_at("cells", F.try_element_at("map", F.lit(f)) + 1), bid_rules, target_year)


def sheet_records(grid: DataFrame, words: list[str], rules: list[tuple[str, str]], bid_rules: list[tuple[str, str]], least: int = 2, default: int | None = None, target_year: int | None = None) -> DataFrame:
    """`records` by `header_rows` and `column_map` in one pass: a sheet's rows are gathered once and meet its header by windows,
    where those are joined back. Of rows that share the header's number the greatest counts."""
    order = Window.partitionBy("file_id").orderBy("row")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    title = F.regexp_replace(F.array_join("cells", "\u0001", ""), r"\s", "")
    hits = sum((F.contains(title, F.lit(w)).cast("int") for w in words), F.lit(0))
    header = F.coalesce(F.min(F.when(F.col("row") < HEADER_ROWS, F.when(hits >= least, F.col("row")))).over(whole), F.lit(default).cast("int"))
    titles = F.transform("cells", lambda c: F.substring_index(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s", ""), "\u0001", 1))
    fields = list(dict.fromkeys(f for _, f in rules))
    place = lambda t, k: F.nullif(F.array_position(F.transform(t, lambda c: F.contains(c, F.lit(k))), F.lit(True)), F.lit(0))
    places = dates.let(titles, lambda t: F.array(*(F.coalesce(*(place(t, k) for k, g in rules if g == f)) for f in fields)))
    body = grid.where("file_id is not null and row is not null").withColumn("header", header)
    body = body.withColumn("places", F.max(F.when(F.col("row") == F.col("header"), places)).over(whole))
    body = body.where((F.col("row") > F.col("header")) & (F.size(F.array_compact("places")) > 0))
    of = lambda f: F.try_element_at("cells", F.get("places", F.lit(fields.index(f))).cast("int")) if f in fields else F.lit(None).cast("string")
    return _typed(body, of, bid_rules, target_year)


def _typed(body: DataFrame, of: Callable[[str], Column], bid_rules: list[tuple[str, str]], target_year: int | None) -> DataFrame:
    """RECORD of rows below a header, whose texts `of` gives by field."""
    cell = lambda f: F.nullif(F.trim(of(f)), F.lit(""))
    name, address = text.vendor_of_lines(F.col("_vendor"))
    ditto, bid = F.coalesce(F.col("_method").isin(*DITTO), F.lit(False)), text.bid_method(F.col("_method"), bid_rules)
    carry = Window.partitionBy("file_id").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    rows = body.select("file_id", "row", "cells", cell("contract_name").alias("contract_name"), text.lines_of(cell("vendor_name")).alias("_vendor"), cell("contract_amount").alias("_amount"), cell("contract_date").alias("_date"), cell("bid_method").alias("_method"))
    rows = rows.withColumns({"_ditto": ditto, "_bid": bid}).withColumn("_carried", F.last(F.when(~F.col("_ditto"), F.col("_bid")), ignorenulls=True).over(carry))
    rows = rows.select(
        "file_id", "row", "contract_name", name.alias("vendor_name"), address.alias("vendor_address"),
        amounts.first_nonzero(amounts.amount(F.col("_amount")), amounts.unit_price_total(F.col("cells"))).alias("contract_amount"),
        dates.date_text(F.col("_date")).alias("contract_date"), F.when(F.col("_ditto"), F.col("_carried")).otherwise(F.col("_bid")).alias("bid_method"),
    )
    rows = pages.held(rows).withColumn("fiscal_year", F.coalesce(dates.fiscal_year_of_text(F.col("contract_date")), F.lit(target_year).cast("int")))
    useful = (F.col("vendor_name").isNotNull() | F.col("contract_amount").isNotNull()) & (F.col("contract_name").isNotNull() | F.col("contract_amount").isNotNull())
    guard = F.lit(True) if target_year is None else F.col("fiscal_year") == target_year
    return rows.where(useful & guard).select(*RECORD)


def lines_of_words(words: DataFrame, tolerance: float = 10.0, least_confidence: float = 0.4) -> DataFrame:
    """(file_id, page, line, text) of positioned words (text, x0, top, conf): a line goes on while a word is near its first."""
    good = words.where(F.coalesce("conf", F.lit(1.0)) >= least_confidence)
    lines = pages.pages_of(good, tolerance).select("file_id", "page", F.posexplode("lines").alias("line", "words"))
    return lines.select("file_id", "page", "line", pages.joined(F.col("words")).alias("text"))


def banded(words: DataFrame, anchors: DataFrame) -> DataFrame:
    """Words of each anchor's band (lo <= top < hi): a range condition within the page's equi-join."""
    a = anchors.select("file_id", "page", F.col("anchor"), "lo", "hi")
    return words.join(a, ["file_id", "page"]).where((F.col("top") >= F.col("lo")) & (F.col("top") < F.col("hi")))


def absolute(url: Column, link: Column) -> Column:
    """A link on the address of the page that it stands in, its steps up taken."""
    base, root = F.regexp_extract(url, r"^([a-z]+://[^?#]*/)", 1), F.regexp_extract(url, r"^([a-z]+://[^/?#]+)", 1)
    full = F.when(link.rlike("^[a-z]+://"), link).when(F.startswith(link, F.lit("/")), F.concat(root, link)).otherwise(F.concat(base, link))
    step = lambda a, s: F.when(s == ".", a).when(s == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(3)))).otherwise(F.array_append(a, s))
    return F.when(full.rlike(r"/\.\.?/"), F.array_join(F.aggregate(F.split(full, "/"), F.array().cast("array<string>"), step), "/")).otherwise(full)


def html_links(sites: DataFrame, extensions: list[str], include: str | None = None) -> DataFrame:
    """(page_id, link) of anchors whose target ends in an extension and, if given, fits a pattern; relative targets are put
    on the page's own address."""
    found = F.regexp_extract_all("html", F.lit(r"(?i)<a\s[^>]*href\s*=\s*[\"']?([^\"'\s>]+)"), F.lit(1))
    links = sites.select("page_id", "url", F.explode(found).alias("link"))
    full = absolute(F.col("url"), F.col("link"))
    links = links if include is None else links.where(F.col("link").rlike(include))
    wanted = F.lit(False)
    for e in extensions:
        wanted = wanted | F.lower(F.regexp_extract("link", "^[^?#]*", 0)).endswith(e)
    return links.where(wanted).select("page_id", full.alias("link")).distinct()


def html_rows(sites: DataFrame) -> DataFrame:
    """(page_id, row, cells) of all table rows."""
    rows = F.regexp_extract_all("html", F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.regexp_extract_all("tr", F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1))
    plain = F.transform(cells, lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"\s+", " ")))
    return sites.select("page_id", F.posexplode(rows).alias("row", "tr")).select("page_id", "row", plain.alias("cells"))


def framed(sites: DataFrame) -> DataFrame:
    """The sheets (page_id, url, html) behind workbooks saved as framesets, under the id of the frameset: its links are theirs,
    on the sheet's own address."""
    frames = sites.where(F.contains("html", F.lit("Excel Workbook Frameset")) | F.contains("html", F.lit("Excel.Sheet")))
    sheet = F.nullif(F.regexp_extract("html", r"(?i)href=[\"']([^\"']*sheet001\.html)[\"']", 1), F.lit(""))
    targets = frames.select("page_id", absolute(F.col("url"), sheet).alias("url")).where("url is not null")
    return targets.join(sites.select("url", "html"), "url").select("page_id", "url", "html")


#: Elements without an end, whose tags open nothing.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Tags, comments, and scripts and styles whole.
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([A-Za-z][A-Za-z0-9]*)\b[^>]*?(/?)>", re.S | re.I)

#: Comments, scripts, styles and brackets within brackets; where there are none, tags of other names can be passed over.
TANGLED = re.compile(r"<[^<>]*<|<!--|<(?:script|style)", re.I)
PDF_MARK = re.compile(r"\(PDF[:：][^)]*\)")


@cache
def _tags(names: frozenset[str]) -> re.Pattern:
    return re.compile(rf"()<(/?)({'|'.join(sorted(names))})\b[^>]*?(/?)>", re.I)


def elements(page: str, names: frozenset[str] | None = None) -> list[tuple[str, int, int, int, int, int]]:
    """(tag, depth, place where it begins, where its content begins, where it ends, where its end tag ends) of a page's elements in
    their order, those with a name alone if names are given.

    Brackets are matched by a stack of open tags: an end tag closes the last open one of its name and all within it; one without
    an open tag closes nothing; what is never closed ends with what holds it, or with the page.
    """
    out, stack = [], []
    markup = _tags(names) if names and not TANGLED.search(page) else MARKUP
    for m in markup.finditer(page):
        _, end, tag, empty = m.groups()
        if not tag:
            continue
        tag = tag.lower()
        if names is not None and tag not in names:
            continue
        if end:
            if stack and out[stack[-1]][0] == tag or any(out[i][0] == tag for i in stack):
                while True:
                    i = stack.pop()
                    out[i][4], out[i][5] = m.start(), m.end() if out[i][0] == tag else m.start()
                    if out[i][0] == tag:
                        break
        else:
            out.append([tag, len(stack), m.start(), m.end(), len(page), len(page)])
            if tag not in VOID and not empty:
                stack.append(len(out) - 1)
            else:
                out[-1][4] = out[-1][5] = m.end()
    return [tuple(x) for x in out]


def plain(part: str) -> str:
    """The texts between tags, trimmed and joined by spaces."""
    if "<" not in part and "\0" not in part:
        return unescape(part).strip()
    return " ".join(t for t in (unescape(x).strip() for x in MARKUP.sub("\0", part).split("\0")) if t)


def page_tables(page: str) -> list[list[list[str]]]:
    """The tables of a page as rows of cells: a table has all rows within it, those of tables in its cells too, and a row all its
    cells; rows without text are left out, and so are tables without rows."""
    found = elements(page, frozenset(("table", "tr", "td", "th")))

    def of(i: int, *names: str) -> Iterator[tuple]:
        """Elements within the i-th: they are in order, so they follow it."""
        for j in range(i + 1, len(found)):
            if found[j][2] >= found[i][4]:
                return
            if found[j][0] in names:
                yield found[j]

    def text_of(c: tuple) -> str:
        told = plain(page[c[3] : c[4]])
        return PDF_MARK.sub("", told).strip() if "(PDF" in told else told.strip()

    rows = {tr[2]: [text_of(c) for c in of(i, "td", "th")] for i, tr in enumerate(found) if tr[0] == "tr"}
    filled = lambda places: [rows[i] for i in places if any(rows[i])]
    tables = [t for t in (filled(tr[2] for tr in of(i, "tr")) for i, x in enumerate(found) if x[0] == "table") if t]
    if not any(re.search("契約金額|落札金額", " ".join(r)) for t in tables for r in t):
        flat = [list(r) for r in dict.fromkeys(tuple(r) for r in filled(rows))]
        return [flat] if flat else tables
    return tables


def html_tables(sites: DataFrame) -> DataFrame:
    """(page_id, table, row, cells) of the rows with text. Where no row of a page's tables names an amount, which is so where
    tables lie within tables, all its rows count as one table and equal ones once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(i, t, r, cells) for i, page in enumerate(batch.column(1).to_pylist()) for t, table in enumerate(page_tables(page or "")) for r, cells in enumerate(table)]
            at, tables, rows, cells = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(tables, pa.int32()), pa.array(rows, pa.int32()), pa.array(cells, pa.list_(pa.string()))], ["page_id", "table", "row", "cells"])

    kind = dict(sites.dtypes)["page_id"]
    return sites.select("page_id", "html").mapInArrow(run, f"page_id {kind}, table int, row int, cells array<string>")


def element_depths(sites: DataFrame, names: list[str]) -> DataFrame:
    """(page_id, tag, depth, elements): how many elements of these names a page has at each depth among them."""
    wanted = frozenset(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(i, tag, depth, n) for i, page in enumerate(batch.column(1).to_pylist()) for (tag, depth), n in Counter(x[:2] for x in elements(page or "", wanted)).items()]
            at, tags, depths, n = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(tags, pa.string()), pa.array(depths, pa.int32()), pa.array(n, pa.int64())], ["page_id", "tag", "depth", "elements"])

    kind = dict(sites.dtypes)["page_id"]
    return sites.select("page_id", "html").mapInArrow(run, f"page_id {kind}, tag string, depth int, elements long")


def crawl(links: DataFrame, seeds: DataFrame, depth: int) -> DataFrame:
    """(url, depth) of what can be reached over (src, dst) in so many steps; each round meets only what is new, and is written."""
    seen = frontier = seeds.select("url").distinct().withColumn("depth", F.lit(0))
    for d in range(1, depth + 1):
        frontier = cut(frontier.join(links, F.col("url") == F.col("src")).select(F.col("dst").alias("url")).distinct().join(seen, "url", "left_anti").withColumn("depth", F.lit(d)))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen


def decoded(files: DataFrame) -> DataFrame:
    """(path, text) of binary files: the declared charset, then UTF-8, code page 932 and EUC."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import re

        def one(raw: bytes) -> str:
            declared = re.search(rb"charset=[\"']?([A-Za-z0-9_-]+)", raw[:4096])
            for name in [*([declared[1].decode()] if declared else []), "utf-8", "cp932", "shift_jis", "euc_jp"]:
                try:
                    return raw.decode(name)
                except (UnicodeError, LookupError):
                    continue
            return raw.decode("utf-8", "replace")

        for b in batches:
            yield pd.DataFrame({"path": b["path"], "text": b["content"].map(one)})

    return files.select("path", "content").mapInPandas(run, "path string, text string")


def jsonl(spark: SparkSession, path: str, schema: str, meta: str | None = None) -> DataFrame:
    """Gzipped JSON lines whose first line is a header object with a `_meta` field; with `meta`, a schema, its fields are put in a
    struct `meta` beside the rows of its own file. A file without a header has none there; one with nothing else has no row.

    A file's header is its first line in order of the file's blocks; the headers, one for each file, are joined by file.
    """
    rows = spark.read.schema(f"{schema}, _meta string").json(path)
    if meta is None:
        return rows.where("_meta is null").drop("_meta")
    names = [f"`{c}`" for c in rows.columns if c != "_meta"]
    rows = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    heads = rows.where("_block = 0 and _meta is not null").groupBy("_file").agg(F.first("_meta").alias("_head"))
    parsed = heads.select("_file", F.from_json("_head", meta).alias("meta"))
    return rows.where("_meta is null").join(parsed, "_file", "left").select(*names, "meta")


def csv(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    df = spark.read.option("header", True).option("encoding", encoding).csv(path)
    return df.withColumnsRenamed({c: c.lstrip("﻿") for c in df.columns})


def payments(rows: DataFrame, payload: str, key: list[str]) -> DataFrame:
    """JSON lists of payees to rows, their place as rank."""
    items = F.from_json(payload, "array<struct<name:string,amount:bigint>>")
    return rows.select(*key, F.posexplode(items).alias("_pos", "item")).select(*key, (F.col("_pos") + 1).alias("rank"), "item.name", "item.amount")


def url_grid(spark: SparkSession, template: str, **dimensions: list) -> DataFrame:
    """All urls of a template over small lists of values (explodes of literals, so the size is the product of the lists)."""
    df = spark.range(1)
    for name, values in dimensions.items():
        df = df.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    return df.drop("id").withColumn("url", F.format_string(template, *dimensions))


def filled(grid: Column, flag_404: Column, url: Column) -> Column:
    """State of a coverage cell."""
    return F.when(F.coalesce(flag_404, F.lit(0)) == 1, "404").when(grid.isin("filled", "filled_new"), grid).when(url.isNotNull() & (url != ""), "pending").otherwise("dash")
