"""Records of pages that have no ruled tables: positioned words, recognised lines, scans of one layout, ranked lists.

Words are (file_id, page, text, x0, x1, top). A page becomes one row that holds its words or lines: one shuffle by page. Rules
about nearby lines are array expressions over that row, or, where these took several times the work, `placed`. What a row
holds is bounded by a sheet of paper.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions import amounts, dates, text
from tallybrook.sources import placed

#: How far words of one line, words of one column, and lines of one contract may lie apart.
LINE_APART, COLUMN_APART, BLOCK_APART, BLOCK_LINES = 6.0, 28.0, 90.0, 5
#: Words by which a page's header, its amounts and its places are known.
AMOUNT_HEADS, NAME_HEADS = "契約金額|落札金額", "件名|名称|工事|数量|品名"
MONEY = r"(?U)\b(\d{1,3}(?:[,，]\d{3})+)\b"
LEAST_MONEY = 100_000
CORPORATE = r"(?U)\b(\d{13})\b"
DATE = r"(?:令和|[Rr])\s*[0-9]{1,2}\s*[./年]\s*[0-9]{1,2}\s*[./月]\s*[0-9]{1,2}|[0-9]{4}[/年-][0-9]{1,2}[/月-][0-9]{1,2}"
PLACES = "[都道府県市区町村]"
COMPANIES = "株式会社|有限会社|合同会社|一般社団|一般財団|公益財団|合資会社|企業組合|協同組合|グループ|ホールディングス"
TITLES = "公共調達|適正化|情報の公表|に基づく競争入札|公表（物品"
SHORT_TITLES = "件名|名称|契約金額|落札金額|業者名|法人番号|入札方式|落札率|予定価格|締結日|契約日|様式|航空自衛隊|会計隊|ページ|合計|小計"
METHOD_TITLES = ["随意契約", "競争入札", "一般競争入札", "指名競争入札", "公共工事"]
SCAN_TITLES = "公共調達|適正化|財計第|情報の公表|行政改革|公益法人|付紙様式|※|公財|特財"
LIST_TITLES = "順位|件数|金額|主な調達品|法人番号|年度"
NUMBERS = r"^[0-9\s,，.%-]+$"


def first(items: Column, fits) -> Column:
    return F.get(F.filter(items, fits), F.lit(0))


def found(value: Column, pattern: str, group: int = 0) -> Column:
    return F.nullif(F.regexp_extract(value, pattern, group), F.lit(""))


def pages_of(words: DataFrame, tolerance: float) -> DataFrame:
    """(file_id, page, lines): a line goes on while a word lies near the line's highest word; its words go from left to right."""
    right = F.col("x1") if "x1" in words.columns else F.col("x0")
    page = words.groupBy("file_id", "page").agg(F.collect_list(F.struct("x0", "top", right.alias("x1"), "text")).alias("words"))
    tops = F.array_sort(F.array_distinct(F.col("words.top")))
    starts = F.aggregate(tops, F.array().cast("array<double>"), lambda a, t: F.when(t - F.try_element_at(a, F.lit(-1)) <= tolerance, a).otherwise(F.array_append(a, t)))
    page = page.withColumn("starts", starts)
    line = lambda s, i: F.array_sort(F.filter("words", lambda w: (w.top >= s) & (w.top < F.coalesce(F.get("starts", i + 1), F.lit(float("inf"))))))
    return page.select("file_id", "page", F.transform("starts", line).alias("lines"))


def joined(words: Column, by: str = " ") -> Column:
    return F.array_join(F.transform(words, lambda w: w.text), by)


def held(df: DataFrame) -> DataFrame:
    """The same rows, their columns worked out once: Catalyst does not merge expressions across a generator."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


#: What is read of a contract under a header, the amount first.
READ = ["contract_amount", "contract_name", "vendor_name", "contract_date", "bid_method", "estimated_price", "award_rate"]


def word_cells(words: list[tuple], rules: list[tuple[str, str]]) -> Iterator[tuple]:
    """(line, *READ, left): the texts of a page's contracts, from its words (x0, top, x1, text) in order."""
    return placed.paid_lines(words, rules, AMOUNT_HEADS, NAME_HEADS, LINE_APART, COLUMN_APART, BLOCK_APART, BLOCK_LINES, READ)


def word_records(words: DataFrame, rules: list[tuple[str, str]], bid_rules: list[tuple[str, str]], years: list[int] | None = None) -> DataFrame:
    """Contracts of pages whose columns are known by the centres of their header words.

    The header is the first run of one to three lines, among the first twelve, that names an amount and a thing; a header
    word takes its first rule whose field is still free. Each later line with an amount in the amount's column ends a
    contract, whose other fields lie in that line and up to five above it. Texts left of all columns make up for a name.
    """
    right = F.col("x1") if "x1" in words.columns else F.col("x0")
    page = words.groupBy("file_id", "page").agg(F.sort_array(F.collect_list(F.struct(*(F.col(c).cast("double").alias(c) for c in ("x0", "top")), right.cast("double").alias("x1"), "text"))).alias("words"))
    texts = [(f, "string", placed.TEXT) for f in (*READ, "left")]
    rows = placed.by_page(page, ["file_id", "page"], ["words"], [("line", "int", placed.NUMBER), *texts], lambda ws: word_cells(ws, rules))
    rows = rows.select(
        "file_id", "page", "line", F.coalesce("contract_name", F.substring("left", 1, 500)).alias("contract_name"), "vendor_name", amounts.last_amount(F.col("contract_amount")).alias("contract_amount"),
        dates.page_date(F.col("contract_date")).alias("contract_date"), text.bid_method(F.col("bid_method"), bid_rules).alias("bid_method"),
        amounts.last_amount(F.col("estimated_price")).alias("estimated_price"), amounts.rate(F.col("award_rate")).alias("award_rate"),
    )
    rows = held(rows).withColumn("fiscal_year", dates.fiscal_year_of_text(F.col("contract_date"))).where("contract_amount > 0 and (vendor_name is not null or contract_name is not null)")
    return rows if years is None else rows.where(F.col("fiscal_year").isNull() | F.col("fiscal_year").isin(years))


def _names(t: Column, words: str) -> Column:
    """Does a text hold one of the words? As a pattern, each is tried at each character, at many times the work."""
    return reduce(or_, (F.contains(t, F.lit(w)) for w in words.split("|")))


def _title(t: Column) -> Column:
    return _names(t, TITLES) | ((F.char_length(t) <= 40) & _names(t, SHORT_TITLES)) | t.isin(METHOD_TITLES)


def _paid(t: Column) -> Column:
    """Does a text hold an amount? The pattern is sought where there is a comma."""
    return _names(t, ",|，") & t.rlike(MONEY)


def _money(t: Column) -> Column:
    digits = F.regexp_replace(F.translate(t, "０１２３４５６７８９,，", "0123456789"), "[^0-9]", "")  # of what MONEY finds: digits and commas
    return F.bround(digits.try_cast("double")).cast("long")


def corporate(t: Column) -> Column:
    return found(F.replace(t, F.lit(" "), F.lit("")), CORPORATE, 1)


def line_records(lines: DataFrame) -> DataFrame:
    """Contracts of recognised lines (file_id, page, line, text): one for each amount of 100,000 or more in a line.

    Date and number are those of the line or else of the first of four lines above and below; the vendor stands next to
    the number's first line, or else above the amount; the name is the first of five lines above that has eight characters.
    """
    text_ = lines.select("file_id", "page", "line", F.trim(F.coalesce("text", F.lit(""))).alias("text"))
    told = text_.select("*", _title(F.col("text")).alias("title"), _paid(F.col("text")).alias("paid"), found(F.col("text"), DATE).alias("date"))
    # what a line says is told once, here, where Spark compiles it; over a page's array it would be interpreted, and told again for each line near it
    plain = ~(F.col("title") | F.col("paid") | F.col("date").isNotNull()) & ~F.col("text").rlike(r"^[0-9\s,，.]+$")
    line = told.select("file_id", "page", F.struct("line", "text", (F.col("paid") & ~F.col("title")).alias("anchor"), (~F.col("paid") & ~F.col("title")).alias("other"), plain.alias("plain"), F.when(F.col("date").isNotNull(), dates.scan_date(F.col("date"))).alias("day")).alias("l"))
    page = line.groupBy("file_id", "page").agg(F.sort_array(F.collect_list("l")).alias("lines"))
    rows = page.select("file_id", "page", "lines", F.posexplode("lines").alias("at", "l")).where("l.anchor")
    at, line = F.col("at"), lambda i: F.get("lines", i)
    up = lambda n: F.slice("lines", F.greatest(at - n, F.lit(0)) + 1, F.least(at, F.lit(n)))
    rows = rows.withColumn("around", F.concat(up(4), F.slice("lines", at + 2, 4)))
    seen = lambda read: F.coalesce(read(F.col("l")), first(F.transform("around", read), lambda x: x.isNotNull()))
    whole = lambda l: F.replace(l["text"], F.lit(" "), F.lit(""))  # noqa: E731, E741
    numbered = F.exists("lines", lambda l: (F.char_length(l["text"]) >= 13) & whole(l).rlike(r"\p{Nd}{13}"))  # noqa: E741
    rows = rows.withColumns({"contract_date": seen(lambda l: l["day"]), "corporate_number": F.when(numbered, seen(lambda l: corporate(l["text"])))})  # noqa: E741
    owner = F.when(F.col("corporate_number").isNotNull(), F.array_position(F.transform("lines", lambda l: F.contains(whole(l), F.col("corporate_number"))), True).cast("int") - 1)  # noqa: E741
    fits = lambda n: lambda l: l["plain"] & (F.char_length(l["text"]) >= n)  # noqa: E731, E741
    options = F.array(*(line(owner + d) for d in (-1, -2, 1, 2)), line(at - 1), line(at - 2))
    amount = F.filter(F.transform(F.regexp_extract_all("l.text", F.lit(MONEY), F.lit(1)), _money), lambda x: x >= LEAST_MONEY)
    return rows.select(
        "file_id", "page", F.col("at").alias("line"), F.substring(first(up(5), fits(8))["text"], 1, 300).alias("contract_name"), F.substring(first(options, fits(3))["text"], 1, 200).alias("vendor_name"),
        F.substring(first(F.col("around"), lambda l: l["other"] & l["text"].rlike(PLACES))["text"], 1, 300).alias("vendor_address"), "corporate_number", "contract_date",  # noqa: E741
        dates.fiscal_year_of_text(F.col("contract_date")).alias("fiscal_year"), F.explode(amount).alias("contract_amount"),
    )


def scan_records(words: DataFrame, columns: list[tuple[float, str]], head: float, foot: float, band: float, least_confidence: float = 0.3) -> DataFrame:
    """Contracts of scans of one layout: words (file_id, page, seq, text, x, y, conf), x and y the centre as shares of the page.

    `columns` are the right borders of fields in order. Amounts of 100,000 or more in contract_amount are anchors; an
    anchor's band reaches half way to its neighbours, or `band` where there is none. seq is the order of recognition.
    """
    t = F.trim("text")
    good = words.where((F.coalesce("conf", F.lit(1.0)) >= least_confidence) & (t != "") & ~t.rlike(SCAN_TITLES) & F.col("y").between(head, foot))
    field = F.coalesce(*(F.when(F.col("x") < b, F.lit(f)) for b, f in columns), F.lit(columns[-1][1]))
    page = good.groupBy("file_id", "page").agg(F.sort_array(F.collect_list(F.struct("seq", field.alias("field"), "y", t.alias("text")))).alias("items"))
    page = held(page)
    money = lambda c: _money(found(c, MONEY, 1))
    anchors = F.filter(F.transform("items", lambda w: F.struct(w["y"].alias("y"), F.when(w["field"] == "contract_amount", money(w["text"])).alias("amount"))), lambda a: a["amount"] >= LEAST_MONEY)
    page = held(page.withColumn("anchors", anchors)).withColumn("ys", F.sort_array(F.col("anchors.y")))
    rows = page.select("file_id", "page", "items", "ys", F.posexplode("anchors").alias("anchor", "a"))
    y, place = F.col("a.y"), F.array_position("ys", F.col("a.y")).cast("int") - 1
    lo, hi = F.coalesce((y + F.get("ys", place - 1)) / 2, y - band), F.coalesce((y + F.get("ys", place + 1)) / 2, y + band)
    rows = held(rows.withColumns({"lo": lo, "hi": hi}))  # once a band, not once a word
    rows = held(rows.withColumn("items", F.filter("items", lambda w: w["y"].between(F.col("lo"), F.col("hi")))))
    of = lambda f: F.transform(F.filter("items", lambda w: w["field"] == f), lambda w: w["text"])
    fixed = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "(?<=年)[sS](?=月)", "5"), "(?<=年)[Oo](?=月)", "0"), "(?<=令和)G(?=年)", "6")
    date = lambda c: dates.scan_date(F.regexp_extract(fixed(c), DATE, 0))
    seen = lambda items, read: first(F.transform(items, read), lambda x: x.isNotNull())
    text_of = lambda items, n: F.substring(F.nullif(F.array_join(items, " "), F.lit("")), 1, n)
    company, place_only = (lambda c: c.rlike(COMPANIES)), (lambda c: c.rlike(PLACES) & ~c.rlike(COMPANIES))
    vendor = of("vendor")
    other = F.filter(vendor, lambda c: ~company(c) & ~place_only(c) & corporate(c).isNull())
    bid = of("bid_method")
    out = rows.select(
        "file_id", "page", "anchor", text_of(F.filter(of("contract_name"), lambda c: (F.char_length(c) >= 3) & date(c).isNull()), 300).alias("contract_name"),
        F.coalesce(text_of(F.filter(vendor, company), 200), text_of(other, 200)).alias("vendor_name"), text_of(F.filter(vendor, place_only), 300).alias("vendor_address"),
        seen(F.concat(of("corporate_number"), vendor), corporate).alias("corporate_number"), F.col("a.amount").alias("contract_amount"), seen(of("estimated_price"), money).alias("estimated_price"),
        seen(of("contract_date"), date).alias("contract_date"), F.when(F.size(bid) > 0, F.when(F.exists(bid, lambda c: F.contains(c, F.lit("指名"))), "指名競争入札").otherwise("一般競争入札")).alias("bid_method"),
    )
    return out.withColumn("fiscal_year", dates.fiscal_year_of_text(F.col("contract_date")))


def ranked_items(words: DataFrame, rank_to: float, company: tuple[float, float], items: tuple[float, float], bucket: float, reach: float = 0.0, split: bool = True, most: int = 5) -> DataFrame:
    """(file_id, page, rank, company_name, item_order, item_name) of ranked lists; the layouts of the years are parameters.

    A rank is 1 to 20 left of `rank_to`; its row is the highest one. The company's name lies within `reach` of that row, the
    items between the middles to the ranks before and after. Items are cut at commas and stops, or are one to a row.
    """
    row = lambda w: amounts.bucket_rows(w["top"], bucket)
    page = words.groupBy("file_id", "page").agg(F.sort_array(F.collect_list(F.struct(amounts.bucket_rows(F.col("top"), bucket).alias("y"), "x0", "text"))).alias("words"))
    number = lambda w: found(w["text"], "^([0-9]{1,2})$", 1).try_cast("int")
    seats = F.filter("words", lambda w: (w["x0"] < rank_to) & number(w).between(1, 20))
    tops = F.transform(F.array_distinct(F.transform(seats, number)), lambda r: F.struct(r.alias("rank"), F.array_min(F.transform(F.filter(seats, lambda w: number(w) == r), lambda w: w["y"])).alias("y")))
    page = page.withColumn("ranks", F.array_sort(tops))
    rows = page.select("file_id", "page", "words", "ranks", F.posexplode("ranks").alias("i", "r"))
    y, next_to = F.col("r.y"), lambda d: F.get("ranks", F.col("i") + d)["y"]
    rows = rows.withColumns({"lo": F.coalesce((next_to(-1) + y) / 2, y - 30), "hi": F.coalesce((y + next_to(1)) / 2, F.lit(float("inf")))})
    words_in = lambda span, more: F.filter("words", lambda w: (w["x0"] >= span[0]) & (w["x0"] < span[1]) & ~w["text"].rlike(NUMBERS) & ~F.contains(w["text"], F.lit("法人番号")) & more(w))
    texts = lambda ws, by="": F.array_join(F.transform(ws, lambda w: w["text"]), by)
    name = texts(words_in(company, lambda w: F.abs(w["y"] - y) <= reach))
    wares = words_in(items, lambda w: (w["y"] > F.col("lo")) & (w["y"] <= F.col("hi")))
    if split:
        parts = F.split(F.regexp_replace(texts(wares), "^(主な調達品|主要調達品目|品目名|調達品目)", ""), "[、,，。]")
        parts = F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: (F.char_length(p) >= 3) & ~p.rlike(NUMBERS))
    else:
        each = F.transform(F.array_distinct(F.transform(wares, lambda w: w["y"])), lambda at: texts(F.filter(wares, lambda w: w["y"] == at)))
        parts = F.filter(F.transform(each, lambda p: F.trim(F.regexp_replace(p, r"^[0-9]{3,6}[,，][0-9]{3}\s*", ""))), lambda p: (F.char_length(p) >= 2) & ~p.rlike(LIST_TITLES))
    out = rows.select("file_id", "page", F.col("r.rank").alias("rank"), name.alias("company_name"), F.posexplode(F.slice(parts, 1, most)).alias("item_order", "item_name"))
    return out.withColumn("item_order", F.col("item_order") + 1)


def companies(grid: DataFrame) -> DataFrame:
    """(file_id, rank, company_name, contracts, amount_100m, share) of ranking tables (file_id, row, cells) below a header that
    names a rank and a company. Of the first three numbers the largest from 1 to 20,000 (hundreds of millions; a table whose
    numbers are over 20,000 counts in millions) is the amount, then the least up to 100 the share, then a whole one the count."""
    title = F.array_join("cells", "")
    headed = grid.where(F.contains(title, F.lit("位")) & title.rlike("企業|相手|会社")).groupBy("file_id").agg(F.min("row").alias("header"))
    rank = F.regexp_replace(F.get("cells", F.lit(0)), "[^0-9]", "").try_cast("int")
    name = F.trim(F.get("cells", F.lit(1)))
    numbers = F.filter(F.transform(F.slice("cells", 3, 100), lambda c: F.regexp_replace(F.when(c.rlike(r"^[\s0-9,，.%％]+$"), c), "[,，%％\\s]", "").try_cast("double")), lambda x: x.isNotNull())
    rows = grid.join(headed, "file_id").where(F.col("row") > F.col("header")).select("file_id", "row", rank.alias("rank"), name.alias("company_name"), F.slice(numbers, 1, 3).alias("n"))
    rows = rows.where(F.col("rank").between(1, 20) & (F.col("company_name") != "") & ~F.col("company_name").rlike("^[0-9]+$"))
    large = rows.groupBy("file_id").agg(F.when(F.array_max(F.min_by("n", "row")) > 20_000, 100.0).otherwise(1.0).alias("by"))
    rows = rows.groupBy("file_id", "rank").agg(F.min_by(F.struct("company_name", "n"), "row").alias("r")).join(large, "file_id").select("file_id", "rank", "r.*", "by")
    amount = F.array_max(F.filter("n", lambda x: (x / F.col("by")).between(1, 20_000)))
    rest = F.array_sort(F.filter("n", lambda x: ~F.coalesce(x == amount, F.lit(False))))
    share = first(rest, lambda x: (x > 0) & (x <= 100))
    count = first(rest, lambda x: (x == F.floor(x)) & (x < 5000) & ~F.coalesce(x == share, F.lit(False)))
    return rows.select("file_id", "rank", "company_name", count.cast("int").alias("contracts"), (amount / F.col("by")).alias("amount_100m"), share.alias("share"))
