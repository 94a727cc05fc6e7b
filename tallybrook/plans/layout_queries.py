"""Whole tables laid out as pages whose columns, headers and tables vary from page to page, and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.sources import layouts
from tallybrook.sources.ledger import table

QUERIES: dict = {}
SQL: dict[str, str] = {}
RULES = [("件名", "contract_name"), ("契約日", "contract_date"), ("相手方", "vendor_name"), ("契約金額", "contract_amount")]
FISCAL = "case when month(l_shipdate) >= 4 then year(l_shipdate) else year(l_shipdate) - 1 end::int"


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _items(spark: SparkSession, sf: str) -> DataFrame:
    """(page, rows, at, first, l_linenumber, name, vendor, amount, day, flag): an order is a page, its items in order; the first of its flag?"""
    item = F.struct("l_linenumber", F.concat(F.lit("P"), "l_partkey").alias("name"), F.concat(F.lit("S"), "l_suppkey").alias("vendor"), F.format_number(F.floor("l_extendedprice"), 0).alias("amount"), F.date_format("l_shipdate", "yyyy/MM/dd").alias("day"), F.when(F.col("l_returnflag").isin("A", "N"), F.col("l_returnflag")).otherwise("-").alias("flag"))
    orders = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").cast("int").alias("page")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    first = F.array_position("items.flag", F.col("i.flag")) == F.col("at") + 1
    return orders.select("page", F.size("items").alias("rows"), "items", F.posexplode("items").alias("at", "i")).select("page", "rows", "at", first.alias("first"), "i.*")


def _word(t: Column, x: Column | float, top: Column | float, width: float | None = None) -> Column:
    x0 = (x if isinstance(x, Column) else F.lit(x)).cast("double")
    x1 = x0 + (F.char_length(t) * 5.0 if width is None else F.lit(width))
    y = (top if isinstance(top, Column) else F.lit(top)).cast("double")
    return F.struct(t.alias("text"), x0.alias("x0"), x1.alias("x1"), y.alias("top"), (y + 8.0).alias("bottom"))


def _grid_words(items: DataFrame) -> DataFrame:
    """Columns that begin elsewhere on each page, names of two words, cells left out, a title across, heights that waver."""
    shift, down = (F.col("page") % 7) * 3.0, F.col("at") * 20.0 + 20 + F.col("at") % 3
    name = F.array(_word(F.col("name"), 50 + shift, down), _word(F.lit("kg"), 50 + shift + F.char_length("name") * 5 + 2, down + 2))
    vendor = F.when(F.col("l_linenumber") % 3 != 0, F.array(_word(F.col("vendor"), 150 + shift, down + 3))).otherwise(F.slice(F.array(_word(F.col("vendor"), 0.0, 0.0)), 1, 0))
    title, body = F.array(_word(F.lit("list"), 40.0, 0.0, 400.0)), F.concat(name, vendor, F.array(_word(F.col("amount"), 250 + shift, down + 1)))
    return items.select(F.lit("f").alias("file_id"), "page", F.inline(F.when(F.col("at") == 0, F.concat(title, body)).otherwise(body)))


@query("""with l as (select *, format('{:,}', floor(l_extendedprice)::bigint) as v, count(*) over (partition by l_orderkey) as n, count(*) filter (l_linenumber % 3 <> 0) over (partition by l_orderkey) as vendors from lineitem),
k as (select *, row_number() over (partition by l_orderkey order by l_linenumber, 'P' || l_partkey, 'S' || l_suppkey, v) as k from l where n >= 2)
select l_orderkey::int as page, k::int as row, 'P' || l_partkey || ' kg|' || case when l_linenumber % 3 <> 0 then 'S' || l_suppkey || '|' when vendors > 0 then '|' else '' end || v as cells from k
union all select distinct l_orderkey::int, 0, case when vendors > 0 then 'list||' else 'list|' end from k""")
def text_grids(spark: SparkSession, sf: str) -> DataFrame:
    """Tables without rulings or header; a page of one row is none."""
    item = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("int").alias("page"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").repartition("page")
    item = item.select("page", "l_linenumber", F.concat(F.lit("P"), "l_partkey").alias("name"), F.concat(F.lit("S"), "l_suppkey").alias("vendor"), F.format_number(F.floor("l_extendedprice"), 0).alias("amount"))
    at = F.row_number().over(Window.partitionBy("page").orderBy("l_linenumber", "name", "vendor", "amount")) - 1
    read = layouts.table_rows(_grid_words(item.withColumn("at", at)))
    return read.select("page", "row", F.array_join("cells", "|").alias("cells"))


@query("""with n as (select l_orderkey::int as page, count(*) as n from lineitem group by 1)
select 'f' as file_id, page, case when page % 3 = 0 then 'ruled' when n >= 2 then 'text' else 'words' end as tier, (case when page % 3 = 0 then 1 when n >= 2 then n + 1 else 0 end)::int as rows from n
union all select 'c', c_custkey::int, 'none', 0 from customer""")
def page_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """How each page is read, empty ones among them."""
    items = _items(spark, sf)
    empty = table(spark, sf, "customer").select(F.lit("c").alias("file_id"), F.col("c_custkey").cast("int").alias("page"), F.inline(F.array(_word(F.lit(None).cast("string"), 0.0, 0.0, 0.0))))
    ruled = items.where("page % 3 = 0 and at = 0").select(F.lit("f").alias("file_id"), "page", F.lit(0).alias("table"), F.lit(0).alias("row"), F.array("name").alias("cells"))
    read = layouts.tiered(_grid_words(items).unionByName(empty), ruled)
    return read.select("file_id", "page", "tier", F.aggregate("tables", F.lit(0), lambda a, t: a + F.size(t)).alias("rows"))


@query(f"""with l as (select *, count(*) over (partition by l_orderkey) as n from lineitem)
select l_orderkey::int as page, case l_orderkey % 3 when 0 then 'ruled' when 1 then 'text' else 'words' end as tier, 'P' || l_partkey as contract_name, 'S' || l_suppkey as vendor_name, floor(l_extendedprice)::bigint as contract_amount, strftime(l_shipdate, '%Y%m%d') as contract_date, {FISCAL} as fiscal_year from l""")
def tiered_contracts(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with ruled tables, with grids of words, and with a field to a line, all by the one reader."""
    items = _items(spark, sf).withColumn("shift", (F.col("page") % 5) * 4.0)
    fields = ("name", "day", "vendor", "amount")
    head = items.where("at = 0").select("page", F.array(*(F.lit(k) for k, _ in RULES)).alias("cells"), F.lit(0).alias("row"))
    ruled = head.unionByName(items.select("page", F.array(*fields).alias("cells"), (F.col("at") + 1).alias("row"))).where("page % 3 = 0")
    ruled = ruled.select(F.lit("f").alias("file_id"), "page", F.lit(0).alias("table"), "row", "cells")
    step = F.when(F.col("page") % 3 == 2, 20.0).otherwise(0.0)  # in pages of the last kind each field has a line of its own
    down = F.col("at") * 100.0 + 100
    places = [100.0, 200.0, 300.0, 400.0]
    body = F.array(*(_word(F.col(f), x + F.col("shift"), down + step * i, 10.0) for i, (f, x) in enumerate(zip(fields, places, strict=True))))
    top = F.array(*(_word(F.lit(k), x + F.col("shift"), 10.0, 10.0) for (k, _), x in zip(RULES, places, strict=True)))
    words = items.where("page % 3 <> 0").select(F.lit("f").alias("file_id"), "page", F.inline(F.when(F.col("at") == 0, F.concat(top, body)).otherwise(body)))
    return layouts.page_contracts(words, ruled, RULES, []).select("page", "tier", "contract_name", "vendor_name", "contract_amount", "contract_date", "fiscal_year")


CODES = {"A": "army", "N": "navy"}


@query("""with l as (select l_suppkey % 10 as f, l_orderkey as p, l_linenumber as n, l_partkey, l_suppkey, l_quantity::int as q, l_returnflag as flag, month(l_shipdate) as m, row_number() over (partition by l_suppkey % 10, l_orderkey order by l_linenumber, l_partkey, l_suppkey) as k from lineitem),
pages as (select distinct f, p, case when p % 3 = 0 then p end as head from l),
known as (select f, p, last_value(head ignore nulls) over (partition by f order by p rows between unbounded preceding and current row) as head from pages),
rows as (select l.*, known.head, row_number() over (partition by l.f order by l.p, l.k) as source_row from l join known on known.f = l.f and known.p = l.p where known.head is not null)
select f::varchar as file_id, p::int as page, source_row::bigint as source_row, flag as org_raw, case flag when 'A' then 'army' when 'N' then 'navy' end as org, 'item ' || l_partkey as item_name, case when head % 2 = 0 then q end::int as qty, case when m >= 4 then m else m + 12 end::int as contract_month
from rows where flag in ('A', 'N')""")
def planned_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Ten files of many pages, every third with a header, whose place says whether a number belongs to the organisation or is a quantity."""
    l = table(spark, sf, "lineitem")
    item = F.struct("l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").cast("string").alias("q"), F.col("l_returnflag").alias("flag"), F.month("l_shipdate").alias("m"))
    pages = l.groupBy((F.col("l_suppkey") % 10).cast("string").alias("file_id"), F.col("l_orderkey").cast("int").alias("page")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    rows = pages.select("file_id", "page", F.posexplode("items").alias("at", "i"))
    down = F.col("at") * 12.0 + 300
    line = [(F.lit("12"), 100.0), (F.lit("item"), 150.0), (F.col("i.l_partkey").cast("string"), 180.0), (F.col("i.flag"), 300.0), (F.col("i.q"), 350.0), (F.concat(F.lit("R5."), F.col("i.m").cast("string")), 420.0), (F.lit("x"), 480.0)]
    body = F.array(*(_word(t, x, down) for t, x in line))
    number = F.when(F.col("page") % 2 == 0, 345.0).otherwise(375.0)
    heads = F.array(_word(F.lit("要求元"), 302.0, 100.0), _word(F.lit("件数"), number, 110.0), _word(F.lit("納期"), 425.0, 100.0), _word(F.lit("区分"), 485.0, 95.0), _word(F.lit("要求元"), 10.0, 150.0))
    words = rows.select("file_id", "page", F.inline(F.when((F.col("page") % 3 == 0) & (F.col("at") == 0), F.concat(heads, body)).otherwise(body)))  # a page's words stay together
    return layouts.planned_rows(words, CODES).drop("item_name_norm")


METHODS = [("一般競争", "open"), ("随意", "direct"), ("FMS", "sales")]


@query("""select o_custkey::int as page, case o_orderstatus when 'F' then 'open' when 'O' then 'direct' else 'sales' end as method, count(*) as cases, case when o_custkey % 2 = 1 then round(sum(floor(o_totalprice)) / 100, 2) else sum(floor(o_totalprice)) end::double as amount_100m from orders group by o_custkey, 1, 2, o_orderstatus""")
def method_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as pages; numbers stand beside their labels, some half way to the next label, half of the pages in millions."""
    sums = table(spark, sf, "orders").groupBy(F.col("o_custkey").cast("int").alias("page"), F.col("o_orderstatus").alias("s")).agg(F.count("*").alias("n"), F.sum(F.floor("o_totalprice")).alias("v"))
    half = F.col("page") % 10 == 0
    x = F.when(F.col("s") == "F", 100.0).when(F.col("s") == "O", 200.0).otherwise(300.0) + F.when(half, 50.0).otherwise(F.col("page") % 9 - 4)
    body = sums.select("page", F.inline(F.array(_word(F.format_number("n", 0), x, F.when(half, 60.0).otherwise(52.0)), _word(F.format_number("v", 0), x, F.when(half, 72.0).otherwise(69.0)))))
    unit = F.when(F.col("page") % 2 == 1, "（単位：百万円）").otherwise("（単位：億円）")
    labels = F.array(_word(unit, 300.0, 5.0), *(_word(F.lit(k), 100.0 * (i + 1), 20.0) for i, (k, _) in enumerate(METHODS)), _word(F.lit("件数"), 10.0, 50.0), _word(F.lit("金額"), 10.0, 70.0))
    words = body.unionByName(sums.select("page").distinct().select("page", F.inline(labels))).withColumn("file_id", F.lit("f"))
    return layouts.method_table(words, METHODS).select("page", "method", "cases", "amount_100m")


@query("""with s as (select o_custkey as c, sum(case when o_orderstatus = 'F' then floor(o_totalprice) end)::double as f, sum(case when o_orderstatus = 'O' then floor(o_totalprice) end)::double as o, sum(case when o_orderstatus = 'P' then floor(o_totalprice) end)::double as p, sum(floor(o_totalprice))::double as t from orders group by 1),
t as (select *, case when t between 5000 and 100000 then t when t / 100 between 5000 and 100000 then t / 100 when t / 100000 between 5000 and 100000 then t / 100000 end as total from s),
u as (select *, unnest([{'label': 'army', 'v': f}, {'label': 'navy', 'v': o}, {'label': 'airforce', 'v': p}]) as x from t where total is not null),
w as (select c, total, x.label as label, case when x.v between 100 and 70000 and (c % 2 = 0 or x.v < total * 0.95) then x.v when x.v / 100 between 100 and 70000 and (c % 2 = 0 or x.v / 100 < total * 0.95) then x.v / 100 when x.v / 100000 between 100 and 70000 and (c % 2 = 0 or x.v / 100000 < total * 0.95) then x.v / 100000 end as value from u),
k as (select *, sum(value) over (partition by c) as parts from w)
select c::varchar as file_id, label, value from k where value is not null and parts <= total * 1.05 union all select c::varchar, 'total', total from t where total is not null""")
def yearly_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """A file for each customer: a table without figures, then one whose total stands first or last; the unit is found by what is plausible."""
    o = table(spark, sf, "orders")
    value = lambda s: F.sum(F.when(F.col("o_orderstatus") == s, F.floor("o_totalprice")))
    sums = o.groupBy(F.col("o_custkey").alias("c")).agg(value("F").alias("f"), value("O").alias("o"), value("P").alias("p"), F.sum(F.floor("o_totalprice")).alias("t"))
    row = lambda t, v: F.array(F.lit(t), F.lit("3件"), F.concat(F.coalesce(F.format_number(v, 0), F.lit("")), F.lit("約")))
    parts = F.array(row("陸上自衛隊", F.col("f")), row("海幕", F.col("o")), row("航空", F.col("p")), row("陸上・海上", F.col("t")))
    total = F.array(row("合計", F.col("t")))
    first = F.array(F.array(F.lit("合計"), F.lit("なし")))
    laid = sums.select("c", F.posexplode(F.array(first, F.when(F.col("c") % 2 == 0, F.concat(parts, total)).otherwise(F.concat(total, parts)))).alias("table", "rows"))
    return layouts.yearly_summary(laid.select(F.col("c").cast("string").alias("file_id"), "table", F.posexplode("rows").alias("row", "cells")))


@query("""select l_orderkey::int as page, case l_returnflag when 'A' then '陸幕' when 'N' then '海幕' else '空幕' end as org, 'P' || l_partkey as item_name, l_linenumber || 'kg' as quantity, floor(l_extendedprice)::double as amount, 'S' || l_suppkey as vendor_name from lineitem""")
def main_item_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Items under their organisations, whose lines stand between them; odd pages share one column for amount and vendor."""
    items = _items(spark, sf)
    group = F.when(F.col("flag") == "A", 0).when(F.col("flag") == "N", 1).otherwise(2)
    down = group * 1000.0 + F.col("at") * 10 + 100
    line = [_word(F.col("name"), 100.0, down), _word(F.concat(F.col("l_linenumber").cast("string"), F.lit("kg")), 340.0, down)]
    apart = F.array(*line, _word(F.col("amount"), 390.0, down), _word(F.col("vendor"), 450.0, down))
    mixed = F.array(*line, _word(F.concat("amount", "vendor"), 400.0, down))
    names = F.element_at(F.array(F.lit("陸幕"), F.lit("海幕"), F.lit("空幕")), group + 1)
    heads = F.array(_word(names, 20.0, group * 1000.0 + 50), _word(F.lit("令和5年度"), 60.0, 20.0))
    with_head = lambda body: F.inline(F.when(F.col("first"), F.concat(heads, body)).otherwise(body))
    of = lambda odd, body: items.where((F.col("page") % 2 == 1) == odd).select(F.lit("f").alias("file_id"), "page", with_head(body))
    skipped = "品目|要求機関|区分|令和|平成|（注|（金額"
    even = layouts.main_items(of(False, apart), (60.0, 310.0), (310.0, 380.0), 385.0, 100.0, "[幕庁]|内局", skipped, False)
    odd = layouts.main_items(of(True, mixed), (60.0, 330.0), (330.0, 390.0), 395.0, 80.0, "[幕庁]|内局", skipped, True)
    return even.unionByName(odd).select("page", "org", "item_name", "quantity", "amount", "vendor_name")
