"""Tables of pages by where their words stand: text grids and the choice between ways to read a page, lists whose columns
move, and tables read along both axes.

As in `pages`, a page of words becomes one row, so what an expression walks is a sheet of paper; what passes from page to
page (borders, running numbers) goes in two steps, runs of pages and then the runs, so no task holds a whole file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.functions import amounts, dates, rules, text
from tallybrook.lineage import cut
from tallybrook.operators import windows
from tallybrook.sources import pages, placed
from tallybrook.sources.pages import first, found, held, joined

#: Words nearer than this belong to one column; heights of words that tell none.
COLUMN_GAP, WORD_HEIGHT = 3.0, 6.0
#: Rows in which a table's header is sought, and the words that make one.
TABLE_HEADER_ROWS, TABLE_AMOUNTS, TABLE_NAMES = 6, "契約金額|落札金額|落札価格", "名称|件名|工事|業務|品名|数量"
DITTO = ["〃", "〝", "ditto", "同上"]
#: Fixed values of planned lists: header words and how far from the organisation's column theirs stand.
LIST_HEAD_TO, LIST_HEAD_APART, LIST_CODE_TO, LIST_SHIFT = 200.0, 25.0, 130.0, 8.0
#: Fixed values of yearly tables: organisations by words, and what totals and parts are plausible in hundreds of millions.
ORGS = {"army": "陸上|陸幕|陸自", "navy": "海上|海幕|海自", "airforce": "航空|空幕|空自"}
TOTALS, PARTS, MOST_OF_TOTAL, MOST_OVER = (5_000, 100_000), (100, 70_000), 0.95, 1.05
UNITS = (1, 100, 100_000)


def islands(spans: Column, gap: float) -> Column:
    """The union of spans (structs lo, hi) as spans from left to right; those at most `gap` apart are one."""
    last = lambda a: F.try_element_at(a, F.lit(-1))
    wider = lambda a, s: F.concat(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.array(F.struct(last(a)["lo"].alias("lo"), F.greatest(last(a)["hi"], s["hi"]).alias("hi"))))
    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<lo:double,hi:double>>"), lambda a, s: F.when(s["lo"] <= last(a)["hi"] + gap, wider(a, s)).otherwise(F.array_append(a, s)))


def _gathered(words: DataFrame, ruled: DataFrame | None) -> DataFrame:
    """(file_id, page, words, ruled): a page's words (top, x0, x1, bottom, text) and the rows of its ruled tables, in order."""
    bottom = F.col("bottom") if "bottom" in words.columns else F.lit(None).cast("double")
    double = [F.col(c).cast("double").alias(c) for c in ("top", "x0", "x1")]
    w = F.when(F.trim("text") != "", F.struct(*double, F.coalesce(bottom, F.col("top") + WORD_HEIGHT).cast("double").alias("bottom"), "text"))
    row, gathered = "struct<table:int,row:int,cells:array<string>>", F.sort_array(F.collect_list("w")).alias("words")
    if ruled is None:
        return words.select("file_id", "page", w.alias("w")).groupBy("file_id", "page").agg(gathered).withColumn("ruled", F.array().cast(f"array<{row}>"))
    none = F.lit(None).cast("struct<top:double,x0:double,x1:double,bottom:double,text:string>")
    both = words.select("file_id", "page", w.alias("w"), F.lit(None).cast(row).alias("r"))
    both = both.unionByName(ruled.select("file_id", "page", none.alias("w"), F.struct(F.col("table").cast("int").alias("table"), F.col("row").cast("int").alias("row"), "cells").alias("r")))
    return both.groupBy("file_id", "page").agg(gathered, F.sort_array(F.collect_list("r")).alias("ruled"))


def _read(words: list[tuple], ruled: list[tuple], gap: float) -> tuple[str, list]:
    """The tier of a page and its tables."""
    if ruled:
        tables: dict[int | None, list] = {}
        for table, _, cells in ruled:
            tables.setdefault(table, []).append(cells)
        return "ruled", list(tables.values())
    if (grid := placed.grid(words, gap)) is not None:
        return "text", [grid]
    return ("words" if words else "none"), []


def _ruled_rows(ruled: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.ListArray]:
    """Page, table, row and cells of rows that rulings gave, which come in order; tables and rows are numbered anew."""
    _, of, structs = placed.flat(ruled)
    number = structs.field(0)
    marks = [of, number.fill_null(0).to_numpy(), number.is_null().to_numpy(zero_copy_only=False)]
    fresh = np.concatenate([[True], np.any([m[1:] != m[:-1] for m in marks], axis=0)])[: len(of)]
    begins = np.flatnonzero(fresh)
    table = np.arange(len(begins)) - np.searchsorted(of[begins], of[begins])
    at = np.cumsum(fresh) - 1
    return of, table[at], np.arange(len(of)) - begins[at], structs.field(2).cast(pa.list_(placed.TEXT))


def _tables(batch: pa.RecordBatch, gap: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.ListArray]:
    """The tier of each page (its place in TIERS), and page, table, row and cells of its tables' rows, in order."""
    words, ruled = batch.column("words"), batch.column("ruled")
    some, lined = (np.diff(c.offsets.to_numpy()) > 0 for c in (words, ruled))
    page, row, cells = placed.grids(words, ~lined, gap)
    tier = np.where(some, 2, 3)
    tier[page], tier[lined] = 1, 0
    if not lined.any():
        return tier, page, np.zeros(len(page), np.int64), row, cells
    of, table, at, given = _ruled_rows(ruled)
    page, table, row = np.concatenate([page, of]), np.concatenate([np.zeros(len(page), np.int64), table]), np.concatenate([row, at])
    by = np.argsort(page, kind="stable")
    return tier, page[by], table[by], row[by], pa.concat_arrays([cells, given]).take(pa.array(by))


TIERS = pa.array(["ruled", "text", "words", "none"])


def tiered(words: DataFrame, ruled: DataFrame | None = None, gap: float = COLUMN_GAP) -> DataFrame:
    """(file_id, page, tier, tables, words): how each page is to be read.

    words: file_id, page, text, x0, x1, top and, if known, bottom; a row without text only says that there is such a page.
    ruled: file_id, page, table, row, cells of the tables that rulings gave. Tier 'ruled': the page has such a table; 'text': its
    words form a grid of two columns and two rows at least; 'words': it has words; 'none'. Columns are the islands of the words'
    extents over rows that have more than one, so titles across the page join nothing; rows are islands of heights.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            tier, page, table, _, cells = _tables(batch, gap)
            fresh = np.flatnonzero(np.concatenate([[True], (page[1:] != page[:-1]) | (table[1:] != table[:-1])])[: len(page)])
            tables = pa.ListArray.from_arrays(pa.array(np.append(fresh, len(page)), pa.int32()), cells)
            ends = np.concatenate([[0], np.cumsum(np.bincount(page[fresh], minlength=batch.num_rows))])
            yield batch, np.arange(batch.num_rows), [TIERS.take(pa.array(tier)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tables)]

    out = [("tier", "string"), ("tables", "array<array<array<string>>>")]
    told = placed.by_batch(_gathered(words, ruled), ["file_id", "page", "words"], ["words", "ruled"], out, read)
    return told.select("file_id", "page", "tier", "tables", "words")


def table_rows(words: DataFrame, ruled: DataFrame | None = None, gap: float = COLUMN_GAP) -> DataFrame:
    """(file_id, page, tier, table, row, cells) of what `tiered` reads as tables, in one pass."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            tier, page, table, row, cells = _tables(batch, gap)
            yield batch, page, [TIERS.take(pa.array(tier[page])), pa.array(table, pa.int32()), pa.array(row, pa.int32()), cells]

    out = [("tier", "string"), ("table", "int"), ("row", "int"), ("cells", "array<string>")]
    return placed.by_batch(_gathered(words, ruled), ["file_id", "page"], ["words", "ruled"], out, read)


#: What is read of a contract in a table, the amount first.
READ = [*pages.READ, "corporate_number", "quantity", "unit_measure", "zuii_reason", "contract_officer"]
CELLS = [("table", "int", placed.NUMBER), ("row", "int", placed.NUMBER), *((f"c_{f}", "string", placed.TEXT) for f in READ), ("beside", "string", placed.TEXT)]


def _cells(tables: list, header_rules: list[tuple[str, str]]) -> Iterator[tuple]:
    return placed.paid_rows(tables, header_rules, TABLE_AMOUNTS, TABLE_NAMES, TABLE_HEADER_ROWS, DITTO, READ)


def _typed(rows: DataFrame, bid_rules: list[tuple[str, str]], years: list[int] | None) -> DataFrame:
    """Contracts of cells; those of tier 'words' are texts under a header, which `beside` holds what is left of."""
    loose, cell = F.col("tier") == "words", lambda f: F.col(f"c_{f}")
    one_line = lambda c: F.nullif(F.trim(F.replace(c, F.lit("\n"), F.lit(" "))), F.lit(""))
    plain = rows.select("*", one_line(cell("contract_name")).alias("name"), one_line(F.col("beside")).alias("next"))
    number = lambda c: c.rlike("^[0-9]+$")
    name = F.when(number(F.col("name")) & F.col("next").isNotNull() & ~number(F.col("next")), F.col("next")).when(~number(F.col("name")), F.col("name"))
    name = F.when(loose, F.coalesce(cell("contract_name"), F.substring("beside", 1, 500))).otherwise(F.substring(name, 1, 500))
    vendor, address = text.vendor_and_address(cell("vendor_name"))
    only = F.contains(cell("vendor_name"), F.lit("\n"))  # most cells have one line
    first_line = F.when(only, vendor).otherwise(F.substring(F.nullif(F.trim(cell("vendor_name")), F.lit("")), 1, 300))
    method = F.when(loose, text.bid_method(cell("bid_method"), bid_rules)).otherwise(F.nullif(text.bid_method(F.trim(cell("bid_method")), bid_rules), F.lit("")))
    out = held(plain.select(
        "file_id", "page", "tier", "table", "row", name.alias("contract_name"), F.when(loose, cell("vendor_name")).otherwise(first_line).alias("vendor_name"),
        F.when(~loose & only, address).alias("vendor_address"), amounts.last_amount(cell("contract_amount")).alias("contract_amount"),
        amounts.last_amount(cell("estimated_price")).alias("estimated_price"), amounts.rate(cell("award_rate")).alias("award_rate"), dates.page_date(cell("contract_date")).alias("contract_date"), method.alias("bid_method"),
        *(F.substring(one_line(cell(f)), 1, 500).alias(f) for f in ("corporate_number", "quantity", "unit_measure", "zuii_reason", "contract_officer")),
    ))
    out = out.withColumn("fiscal_year", dates.fiscal_year_of_text(F.col("contract_date")))
    out = out.where("(contract_amount > 0 or tier <> 'words' and contract_amount <> 0) and (vendor_name is not null or contract_name is not null)")
    return out if years is None else out.where(F.col("fiscal_year").isNull() | F.col("fiscal_year").isin(years))


def table_records(pages_: DataFrame, header_rules: list[tuple[str, str]], bid_rules: list[tuple[str, str]], years: list[int] | None = None) -> DataFrame:
    """Contracts of the tables that `tiered` read, each with its tier.

    A header stands in the first rows and names an amount and a thing; a column takes its first rule whose field is free.
    Rows need an amount and a name or vendor; ditto marks take the method before them; a name that is a running number gives
    way to the cell right of it.
    """
    table = pages_.select("file_id", "page", "tier", F.transform("tables", lambda t: F.struct(t.alias("rows"))).alias("tables"))
    return _typed(placed.by_page(table, ["file_id", "page", "tier"], ["tables"], CELLS, lambda ts: _cells([t for t, in ts], header_rules)), bid_rules, years)


def page_contracts(words: DataFrame, ruled: DataFrame | None, header_rules: list[tuple[str, str]], bid_rules: list[tuple[str, str]], years: list[int] | None = None) -> DataFrame:
    """Contracts of every page, by the first way that fits it: its ruled tables, a grid of its words, or words under a header.

    One pass: a page is read and its cells are taken at once.
    """
    none = (None,) * (len(READ) - len(pages.READ))
    order = lambda w: [(v is not None, v) for v in w]

    def read(ws: list[tuple], rs: list[tuple]) -> Iterator[tuple]:
        tier, tables = _read(ws, rs, COLUMN_GAP)
        if tier != "words":
            return ((tier, *r) for r in _cells(tables, header_rules))
        loose = [(x0, top, x1, t) for top, x0, x1, _, t in ws]
        loose.sort(key=order if any(None in w for w in loose) else None)
        return ((tier, 0, line, *told, *none, left) for line, *told, left in pages.word_cells(loose, header_rules))

    rows = placed.by_page(_gathered(words, ruled), ["file_id", "page"], ["words", "ruled"], [("tier", "string", placed.TEXT), *CELLS], read)
    return _typed(rows, bid_rules, years).select("file_id", "page", "tier", "contract_name", "vendor_name", "contract_amount", "contract_date", "bid_method", "estimated_price", "award_rate", "fiscal_year")


#: A line of a planned list, and what a page says to those after it: its own borders, or its words where it knows none.
LISTED = [("i", "int"), *((f, "string") for f in ("item", "org", "qty", "due"))]
KEPT = [("own", "array<double>"), ("words", "array<struct<x0:double,top:double,text:string>>")]
BORDERS = pa.list_(pa.float64())
CODE = "^[0-9]{1,2}(?:\r\n|[\n\r\x85\u2028\u2029])?$"


def _borders(words: list[tuple]) -> list[float | None] | None:
    """Where lines begin, and the left borders of organisation, quantity, due date and class, by a page's own header."""
    heads = [(top, x0) for x0, top, t in words if top is not None and top < LIST_HEAD_TO and "要求元" in t]
    if not heads:
        return None
    top, x0 = min(heads, key=lambda h: (h[0], h[1] is not None, h[1] or 0.0))
    if x0 is None:
        return [top + LIST_HEAD_APART, None, None, None, None]

    def right(mark: str, least: float, beyond: float) -> float:
        return next((x for x, y, t in words if x is not None and y is not None and x >= least and abs(y - top) <= LIST_HEAD_APART and mark in t), beyond)

    qty = right("件", x0 + 15, x0 + 40)
    due = right("納", x0 + 40, qty + 35)
    return [top + LIST_HEAD_APART, x0 - LIST_SHIFT / 2, *(x - LIST_SHIFT for x in (qty, due, right("区", due + 10, due + 35)))]


def _list_lines(words: tuple, borders: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """The page, and the columns of LISTED, of all lines with an organisation; borders: a row for each page, or no numbers."""
    _, of, structs = words
    (x, told), (top, stands), text_ = placed.places(structs.field(0)), placed.places(structs.field(1)), structs.field(2)
    low, *edges = borders[of].T
    here = np.flatnonzero(told & stands & (top >= low))
    here = here[np.lexsort((np.rint(top[here]), of[here]))]  # lines one below another, words in their order
    page, y, x, (org, qty, due, kind) = of[here], np.rint(top[here]), x[here], (e[here] for e in edges)
    line = np.cumsum(np.concatenate([[True], (page[1:] != page[:-1]) | (y[1:] != y[:-1])])[: len(here)]) - 1
    named = (org <= x) & (x < qty)
    good = np.bincount(line[named], minlength=line[-1] + 1 if len(line) else 0) > 0
    n, line = int(good.sum()), (np.cumsum(good) - 1)[line] * good[line] - ~good[line]
    texts, within = text_.take(pa.array(here)), line >= 0
    left = within & (x < org)
    item = left & ~((x <= LIST_CODE_TO) & pc.match_substring_regex(texts, CODE).to_numpy(zero_copy_only=False))
    seen = np.concatenate([[0], np.cumsum(item)])
    first_ = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])[: len(line)])
    before = np.repeat(seen[first_], np.diff(np.concatenate([first_, [len(line)]])))
    spans = (left & (seen[1:] > before), within & named, within & (qty <= x) & (x < due), within & (due <= x) & (x < kind))
    name, *rest = (placed.gathered(texts, s, line, n) for s in spans)
    pages_ = page[first_[line[first_] >= 0]]
    i = np.arange(n) - np.searchsorted(pages_, pages_)
    return pages_, [pa.array(i, pa.int32()), name, *(pc.utf8_trim(t, " ") for t in rest)]


def _read_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Lines of pages that come in the order of their runs, each by the last borders of its run."""
    key = left = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        at, of, structs = words = placed.flat(batch.column("words"))
        keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("file_id", "_run")]
        fresh = np.concatenate([[key != [k[0] for k in keys]], np.any([k[1:] != k[:-1] for k in keys], axis=0)])
        marked = np.unique(of[np.flatnonzero(pc.match_substring(structs.field(2), "要求元").to_numpy(zero_copy_only=False))])
        own = {p: b for p, ws in zip(marked, placed.lists(batch.column("words").take(pa.array(marked))), strict=True) if (b := _borders(ws))}
        table = np.full((n, 5), np.nan)
        heads = np.fromiter(own, np.int64, len(own))
        if own:
            table[heads] = np.array(list(own.values()), float)
        last = np.full(n, -1)
        last[heads] = heads
        last, begun = np.maximum.accumulate(last), np.maximum.accumulate(np.where(fresh, np.arange(n), -1))
        known = (last >= begun) & (last >= 0)
        borders = np.where(known[:, None], table[last], np.nan)
        if left is not None:
            before = (begun < 0) & ~known
            borders[before], known = left, known | before
        page, lines = _list_lines(words, borders)
        kept = np.flatnonzero(~known)
        told = [pa.concat_arrays([c, pa.nulls(len(heads) + len(kept), c.type)]) for c in lines]
        edges = pa.concat_arrays([pa.nulls(len(page), BORDERS), pa.array([own[h] for h in heads], BORDERS), pa.nulls(len(kept), BORDERS)])
        later = batch.column("words").take(pa.array(kept))
        yield batch, np.concatenate([page, heads, kept]), [*told, edges, pa.concat_arrays([pa.nulls(len(page) + len(heads), later.type), later])]
        key, left = [k[-1] for k in keys], borders[-1] if known[-1] else None


def _read_kept(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        borders = np.array([[np.nan if x is None else x for x in b] for b in batch.column("before").to_pylist()], float).reshape(-1, 5)
        yield batch, *_list_lines(placed.flat(batch.column("words")), borders)


def planned_rows(words: DataFrame, codes: dict[str, str]) -> DataFrame:
    """Rows of planned lists whose borders move: (file_id, page, source_row, org_raw, org, item_name, item_name_norm, qty, contract_month).

    A page's borders come from its own header, the highest word with 要求元 near its top, else from the last page before it in
    the file that had one; without any, the page has no rows. source_row counts a file's rows with an organisation, known or not;
    rows of unknown ones are left out. What is read is written once, in the folder of spark.checkpoint.dir, and numbered from there.
    """
    near = F.struct(F.col("x0").cast("double").alias("x0"), F.col("top").cast("double").alias("top"), "text")
    page = words.where((F.trim("text") != "") & F.col("file_id").isNotNull() & F.col("page").isNotNull()).groupBy("file_id", "page").agg(F.sort_array(F.collect_list(near)).alias("words"))
    run = ["file_id", "_run"]
    # a page is read once, when its run's borders are known; the few before a run's first header are kept for the runs before to tell
    page = page.withColumn("_run", F.floor(F.col("page") / windows.RUN)).repartition(*run).sortWithinPartitions(*run, "page")
    told = cut(placed.by_batch(page, [*run, "page"], ["words"], [*LISTED, *KEPT], _read_lists))
    outer = Window.partitionBy("file_id").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = told.groupBy(*run).agg(F.max_by("own", F.when(F.col("own").isNotNull(), F.col("page"))).alias("own"))
    starts = runs.select(*run, F.last("own", ignorenulls=True).over(outer).alias("before")).where("before is not null")
    kept = told.where("words is not null").select(*run, "page", "words").join(starts, run)
    later = placed.by_batch(kept, [*run, "page"], ["words", "before"], LISTED, _read_kept)
    rows = told.where("i is not null").select(*run, "page", *(n for n, _ in LISTED)).unionByName(later)
    sums = rows.groupBy(*run).agg(F.count("*").alias("n")).select(*run, F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("rows_before"))
    rows = rows.withColumn("at", F.row_number().over(Window.partitionBy(*run).orderBy("page", "i"))).join(sums, run)
    raw = F.split("org", r"\s+")[0]
    month = F.coalesce(*(found("due", p, 1).try_cast("int") for p in (r"^R[0-9]+\.([0-9]{1,2})", r"^[0-9]{4}/([0-9]{1,2})/", r"^[0-9]{4}年([0-9]{1,2})月")))
    out = rows.select(
        "file_id", "page", (F.col("rows_before") + F.col("at")).alias("source_row"), raw.alias("org_raw"), rules.mapped(raw, codes, F.lit(None).cast("string")).alias("org"), F.col("item").alias("item_name"),
        text.item_name(F.col("item")).alias("item_name_norm"), F.when(F.col("qty").rlike("^[0-9]+$"), F.col("qty")).try_cast("int").alias("qty"), dates.fiscal_month(month).alias("contract_month"),
    )
    return out.where("org is not null")


def _number(t: Column) -> Column:
    clean = F.translate(t, "０１２３４５６７８９，", "0123456789,")
    return F.when(clean.rlike(r"^[0-9][0-9,]*(\.[0-9]+)?$"), F.replace(clean, F.lit(","), F.lit(""))).try_cast("double")


def two_axis(words: DataFrame, row_labels: list[tuple[str, str]], column_labels: list[tuple[str, str]]) -> DataFrame:
    """(file_id, page, label, measure, value) of tables read along both axes.

    Labels are words with a keyword (keyword, name), the first of each name, top down and then from the left. A number belongs
    to the column label whose begin is nearest in x and the row label nearest in y, of equals the left and the upper one; where
    several numbers meet in a cell the nearest counts, of equals the first. Numbers at or above the column labels are none of
    the table's. A page that names 百万円 and not 億円 below it counts in millions, and its amounts are put in hundreds of millions.
    """
    page = words.where(F.trim("text") != "").groupBy("file_id", "page").agg(F.array_sort(F.collect_list(F.struct("top", "x0", "text"))).alias("words"))

    def labels(table: list[tuple[str, str]]) -> Column:
        known = F.array(*(F.struct(F.lit(k).alias("keyword"), F.lit(n).alias("name")) for k, n in table))
        name = lambda w: first(known, lambda k: F.contains(w["text"], k["keyword"]))["name"]
        seen = F.filter(F.transform("words", lambda w: F.struct(w["top"].alias("top"), w["x0"].alias("x0"), name(w).alias("name"))), lambda w: w["name"].isNotNull())
        return F.filter(F.transform(F.array_distinct(F.transform(seen, lambda w: w["name"])), lambda n: first(seen, lambda w: w["name"] == n)), lambda w: w.isNotNull())

    page = held(page.withColumns({"across": labels(column_labels), "down": labels(row_labels)})).where((F.size("across") > 0) & (F.size("down") > 0))
    units = F.filter(F.transform("words", lambda w: F.when(F.contains(w["text"], F.lit("百万円")), 100).when(F.contains(w["text"], F.lit("億円")), 1)), lambda u: u.isNotNull())
    page = held(page.withColumn("unit", F.coalesce(F.try_element_at(units, F.lit(-1)), F.lit(1))))
    numbers = F.filter(F.transform("words", lambda w: F.struct(w["top"].alias("top"), w["x0"].alias("x0"), _number(w["text"]).alias("value"))), lambda n: n["value"].isNotNull() & (n["top"] > F.array_max(F.col("across.top"))))
    rows = page.select("file_id", "page", "across", "down", "unit", F.explode(numbers).alias("n"))
    column = F.array_min(F.transform("across", lambda a: F.struct(F.abs(a["x0"] - F.col("n.x0")).alias("d"), a["x0"].alias("x"), a["name"].alias("name"))))
    row = F.array_min(F.transform("down", lambda a: F.struct(F.abs(a["top"] - F.col("n.top")).alias("d"), a["top"].alias("y"), a["name"].alias("name"))))
    rows = rows.select("file_id", "page", "unit", "n", column.alias("c"), row.alias("r"))
    best = rows.groupBy("file_id", "page", F.col("r.name").alias("label"), F.col("c.name").alias("measure")).agg(F.min_by(F.struct("n.value", "unit"), F.struct(F.col("c.d") + F.col("r.d"), "n.top", "n.x0")).alias("v"))
    return best.select("file_id", "page", "label", "measure", F.col("v.value").alias("value"), F.col("v.unit").alias("unit"))


def method_table(words: DataFrame, methods: list[tuple[str, str]]) -> DataFrame:
    """(file_id, page, method, cases, amount_100m) of a page's table of contract methods: cases and amounts are its rows."""
    cells = two_axis(words, [("件数", "cases"), ("金額", "amount")], methods)
    amount = F.when(F.col("unit") == 100, F.round(F.col("value") / 100, 2)).otherwise(F.col("value"))
    of = lambda label, value: F.max(F.when(F.col("label") == label, value))
    return cells.groupBy("file_id", "page", F.col("measure").alias("method")).agg(of("cases", F.col("value").cast("long")).alias("cases"), of("amount", amount).alias("amount_100m"))


def cell_number(t: Column) -> Column:
    """A cell's number, however it is written; what follows a unit's sign is left out."""
    clean = F.regexp_replace(F.translate(t, "０１２３４５６７８９．", "0123456789."), "[,， 　]", "")
    clean = F.regexp_replace(F.regexp_replace(clean, "(?s)[億件円以上未満約〜～\\s].*$", ""), "[^0-9.]", "")
    value = clean.try_cast("double")
    return F.when(value < 1e13, value)


def yearly_summary(rows: DataFrame) -> DataFrame:
    """(file_id, label, value) in hundreds of millions: the total and each organisation's part, from a file's first table with
    a plausible total.

    rows: file_id, table, row, cells. The total is the largest number of the first row that names 合計 and gives a plausible one
    in some unit; an organisation's part likewise, from the first row whose first cell names it alone, and below the total if
    that stands above it. Parts that exceed the total together are none.
    """
    table = rows.groupBy("file_id", "table").agg(F.array_sort(F.collect_list(F.struct("row", "cells")))["cells"].alias("rows"))
    largest = lambda cells: F.array_max(F.filter(F.transform(cells, cell_number), lambda x: x.isNotNull()))
    plausible = lambda raw: F.coalesce(*(F.when((raw / u).between(*TOTALS), raw / u) for u in UNITS))
    totals = F.transform("rows", lambda r, i: F.struct(i.alias("i"), F.when(F.exists(r, lambda c: F.contains(c, F.lit("合計"))), plausible(largest(r))).alias("v")))
    table = held(table.withColumn("total", first(totals, lambda t: t["v"].isNotNull())))
    one_of = lambda c: F.filter(F.array(*(F.when(c.rlike(p), F.lit(o)) for o, p in ORGS.items())), lambda o: o.isNotNull())
    org = lambda r: F.when(F.size(one_of(F.get(r, F.lit(0)))) == 1, F.get(one_of(F.get(r, F.lit(0))), F.lit(0)))
    under = lambda v, i: F.coalesce(F.col("total.i") > i, F.lit(True)) | (v < F.col("total.v") * MOST_OF_TOTAL)
    part = lambda raw, i: F.coalesce(*(F.when((raw / u).between(*PARTS) & under(raw / u, i), raw / u) for u in UNITS))
    parts = F.transform("rows", lambda r, i: F.struct(org(r).alias("org"), part(largest(F.slice(r, 2, 1000)), i).alias("v")))
    table = held(table.withColumn("parts", F.filter(parts, lambda p: p["org"].isNotNull() & p["v"].isNotNull())))
    mine = F.filter(F.transform(F.array(*map(F.lit, ORGS)), lambda o: first(F.col("parts"), lambda p: p["org"] == o)), lambda p: p.isNotNull())
    table = held(table.withColumn("mine", mine)).where("total is not null")
    fits = F.aggregate("mine", F.lit(0.0), lambda a, p: a + p["v"]) <= F.col("total.v") * MOST_OVER
    kept = F.when(fits, F.col("mine")).otherwise(F.slice("mine", 1, 0))
    told = F.concat(F.array(F.struct(F.lit("total").alias("label"), F.col("total.v").alias("value"))), F.transform(kept, lambda p: F.struct(p["org"].alias("label"), p["v"].alias("value"))))
    return table.groupBy("file_id").agg(F.min_by(told, "table").alias("told")).select("file_id", F.inline("told"))


NUMERIC, PAID, PLAIN = (re.compile(p + placed.END) for p in (r"[0-9,，\s.]+", "[0-9,，]+", r"[0-9,，\s.-]+"))
NO_HEAD = re.compile("単位|年度|区分|過去|注|（|※")


def _main_lines(words: list[tuple], item: tuple[float, float], quantity: tuple[float, float], amount_from: float, org_to: float, org_pattern: re.Pattern, mixed: bool, bucket: float) -> Iterator[tuple]:
    """(line, organisation, item, quantity, amount, vendor) of the lines of a page's words (top, x0, text) that head no others."""
    lines: dict[float, list[tuple]] = {}
    for top, x, t in words:
        if top is not None:
            lines.setdefault(placed.rounded(top / bucket), []).append((x, t))
    org = ""
    for n, (_, ws) in enumerate(sorted(lines.items())):
        ws = sorted(w for w in ws if w[0] is not None)
        head = "".join([t for x, t in ws if x < org_to and len(t) <= 8 and not NUMERIC.match(t) and not NO_HEAD.search(t)])
        if org_pattern.search(head):
            org = head
            continue
        name = "".join([t for x, t in ws if item[0] <= x <= item[1] and not NUMERIC.match(t)]).strip(" ")
        count = "".join([t for x, t in ws if quantity[0] <= x <= quantity[1]]).strip(" ")
        beyond = [t for x, t in ws if amount_from <= x < float("inf")]
        paid = "".join(beyond if mixed else [t for t in beyond if PAID.match(t)]).strip(" ")
        yield n, org, name, count, paid, "" if mixed else "".join([t for t in beyond if not PLAIN.match(t)]).strip(" ")


def main_items(words: DataFrame, item: tuple[float, float], quantity: tuple[float, float], amount_from: float, org_to: float, org_pattern: str, skipped: str, mixed: bool, bucket: float = 5.0) -> DataFrame:
    """(file_id, page, line, org, item_name, quantity, amount, vendor_name) of a page's list of main items; layouts are parameters.

    A short text left of `org_to` that fits `org_pattern` heads the items below it. `mixed`: amount and vendor share a
    column from `amount_from` on, the number first; else numbers there are the amount and texts the vendor.
    """
    at = [F.col(c).cast("double").alias(c) for c in ("top", "x0")]
    page = words.where(F.trim("text") != "").groupBy("file_id", "page").agg(F.sort_array(F.collect_list(F.struct(*at, "text"))).alias("words"))
    read = lambda ws: _main_lines(ws, item, quantity, amount_from, org_to, re.compile(org_pattern), mixed, bucket)
    texts = [(f, "string", placed.TEXT) for f in ("org", "name", "count", "paid", "rest")]
    rows = placed.by_page(page, ["file_id", "page"], ["words"], [("line", "int", placed.NUMBER), *texts], read)
    name = F.col("name")
    if mixed:
        both = F.replace("paid", F.lit("，"), F.lit(","))
        amount, vendor = found(both, "^([0-9,]+)", 1), F.trim(found(both, r"^[0-9,]+\s*(.*)$", 1))
    else:
        amount = F.col("paid")
        vendor = F.when(~F.replace("rest", F.lit(" "), F.lit("")).rlike("^[0-9]{13}$"), F.col("rest"))
    out = rows.select("file_id", "page", "line", "org", name.alias("item_name"), F.nullif("count", F.lit("")).alias("quantity"), _number(amount).alias("amount"), F.nullif(vendor, F.lit("")).alias("vendor_name"))
    return held(out).where((F.char_length("item_name") >= 2) & ~F.col("item_name").rlike(skipped))
