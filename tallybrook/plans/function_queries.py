"""Scalar functions over texts made from the tables' own values; the SQL states the expected values from the values themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions import amounts, dates, rules, text
from tallybrook.operators import linkage
from tallybrook.sources.ledger import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def pick(k: Column, *options: Column) -> Column:
    """The option of a key's remainder."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for i, o in enumerate(options):
        out = out.when(k % len(options) == i, o)
    return out


@query("""select o_orderkey, case when month(o_orderdate) >= 4 then year(o_orderdate) else year(o_orderdate) - 1 end::int as fiscal_year, month(o_orderdate)::int as month,
    case when month(o_orderdate) >= 4 then month(o_orderdate) else month(o_orderdate) + 12 end::int as fiscal_month, strftime(o_orderdate, '%Y/%m/%d') as shown,
    case when year(o_orderdate) >= 2019 then 'R' || (year(o_orderdate) - 2018) else 'H' || (year(o_orderdate) - 1988) end as era from orders""")
def fiscal_parts(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyyMMdd")
    month = dates.month_of_text(day)
    return table(spark, sf, "orders").select("o_orderkey", dates.fiscal_year_of_text(day).alias("fiscal_year"), month.alias("month"), dates.fiscal_month(month).alias("fiscal_month"), dates.display(day).alias("shown"), dates.era_label(F.substring(day, 1, 4).cast("int")).alias("era"))


@query("""select o_orderkey, case o_orderkey % 7 when 2 then (year(o_orderdate) + 24) || strftime(o_orderdate, '%m%d') when 5 then null when 6 then null else strftime(o_orderdate, '%Y%m%d') end as day from orders""")
def date_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Slashes, years and days in words, era years, eight digits, serials; points after a year, and words before it, are no date."""
    d, form = F.col("o_orderdate"), lambda p: F.date_format("o_orderdate", p)
    era = F.concat_ws(".", F.concat(F.lit("R"), (F.year(d) - 1994).cast("string")), F.month(d).cast("string"), F.dayofmonth(d).cast("string"))
    cell = pick(F.col("o_orderkey"), form("yyyy/M/d"), form("yyyy年M月d日"), era, form("yyyyMMdd"), F.date_diff(d, F.lit(dates.SERIAL_ZERO).cast("date")).cast("string"), form("yyyy.M.d"), F.concat(F.lit("契約 "), form("yyyy/M/d")))
    return table(spark, sf, "orders").select("o_orderkey", dates.date_text(cell).alias("day"))


@query("""select o_orderkey, case o_orderkey % 4 when 2 then null when 3 then null else o_orderkey end as amount,
    case o_orderkey % 4 when 3 then null when 2 then cast(round_even(floor(o_totalprice) + 0.5, 0) as bigint) else o_orderkey end as last from orders""")
def amount_cells(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey").cast("string")
    cell = pick(F.col("o_orderkey"), F.concat(F.lit("¥"), k, F.lit("円")), F.concat(F.lit("約 "), k, F.lit("円也")), F.concat(k, F.lit("円 "), F.floor("o_totalprice").cast("string"), F.lit(".5")), F.lit("-"))
    return table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 != 2, amounts.amount(cell)).alias("amount"), amounts.last_amount(cell).alias("last"))


@query("select l_orderkey, l_linenumber, case when l_discount <= 1 then round(l_discount * 100, 2) end as rate, cast(floor(l_quantity) * 10000 + l_linenumber as double) as oku from lineitem")
def rate_and_unit_cells(spark: SparkSession, sf: str) -> DataFrame:
    units = F.concat(F.lit("総額"), F.floor("l_quantity").cast("string"), F.lit("兆"), F.col("l_linenumber").cast("string"), F.lit("億円"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", amounts.rate(F.concat(F.col("l_discount").cast("string"), F.lit("%"))).alias("rate"), amounts.oku(units).alias("oku"))


@query("""select c_custkey, case c_custkey % 6 when 0 then c_name || '株式会社' when 1 then c_name || '株式会社' when 2 then c_name || '有限会社' when 3 then c_name || '合名会社' when 4 then '株式会社' || c_name || '有限会社' end as vendor,
    case c_custkey % 6 when 0 then '株式会社' || c_name when 1 then '株式会社 ' || c_name when 2 then c_name || '有限会社' when 3 then '合名会社' || c_name when 4 then '株式会社' || c_name || '有限会社' else '' end as plain from customer""")
def vendor_cells(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("c_name")
    cell = pick(F.col("c_custkey"), F.concat(F.lit("（株）"), n), F.concat(F.lit("株式会社　"), n), F.concat(n, F.lit("㈲ ")), F.concat(F.lit("合名会社"), n), F.concat(F.lit("㈱"), n, F.lit("(有)")), F.lit(" "))
    return table(spark, sf, "customer").select("c_custkey", text.vendor(cell).alias("vendor"), text.vendor_plain(cell).alias("plain"))


@query("""select p_partkey, '改' || replace(lower(p_name), ' ', '') || 'a' as item, '改' || replace(lower(p_name), ' ', '') || 'a' as programme,
    '(改)・' || p_name || '-Aー' as equipment, p_name as bare from part""")
def name_forms(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.lit("（改）・"), F.col("p_name"), F.lit("－Ａー"))
    bare = text.without_parentheses(F.concat(F.col("p_name"), F.lit("(甲)（乙） ")))
    return table(spark, sf, "part").select("p_partkey", text.item_name(name).alias("item"), text.programme_name(name).alias("programme"), text.equipment_name(name).alias("equipment"), bare.alias("bare"))


@query("""with b as (select o_orderkey, case when contains(o_orderpriority, 'URGENT') then '随意契約' when contains(o_orderpriority, 'HIGH') then '指名競争契約' else substr(o_orderpriority, 1, 30) end as bid from orders)
select o_orderkey, bid, case when contains(bid, '随') then '随契' else '競争' end as class from b""")
def bid_cells(spark: SparkSession, sf: str) -> DataFrame:
    bid = text.bid_method(F.concat(F.lit(" "), F.col("o_orderpriority")), [("URGENT", "随意契約"), ("HIGH", "指名競争契約")])
    return table(spark, sf, "orders").select("o_orderkey", bid.alias("bid")).withColumn("class", text.bid_class(F.col("bid")))


@query("""select p_partkey, case when contains(lower(p_type), 'brass') or contains(lower(p_type), 'steel') then 'metal' when contains(lower(p_type), 'anodized') then 'finish' else 'other' end as kind,
    case when starts_with(p_brand, 'Brand#1') then 'one' when p_brand = 'Brand#22' then 'two' else 'rest' end as branch, case p_size when 1 then 'one' when 2 then 'two' else p_brand end as mapped from part""")
def keyword_and_prefix_rules(spark: SparkSession, sf: str) -> DataFrame:
    kind = rules.by_keywords(F.col("p_type"), [(["brass", "steel"], "metal"), (["anodized"], "finish")], "other")
    branch = rules.by_prefix(F.col("p_brand"), [("Brand#1", "one"), ("Brand#22", "two")], other="rest")
    return table(spark, sf, "part").select("p_partkey", kind.alias("kind"), branch.alias("branch"), rules.mapped(F.col("p_size").cast("string"), {"1": "one", "2": "two"}, F.col("p_brand")).alias("mapped"))


@query("""select o_orderkey, case o_orderkey % 6 when 0 then 2022 + o_orderkey % 8 when 1 then 2017 + 1 + o_orderkey % 7 when 2 then 2018 + 1 + o_orderkey % 7 when 3 then 2018 + 1 + o_orderkey % 20 when 4 then 2022 + o_orderkey % 8 end::int as fiscal_year from orders""")
def url_years(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    part = lambda n, more: (F.lit(n) + k % more).cast("string")
    join = lambda *x: F.concat(*(F.lit(i) if isinstance(i, str) else i for i in x))
    url = pick(k, join("https://a.example/FY", part(2022, 8), "/x.pdf"), join("https://a.example/r", part(1, 7), ".3/x.pdf"), join("https://a.example/R0", part(1, 7), "-04_x.xlsx"), join("https://a.example/r", part(1, 20), "/x"), join("https://a.example/", part(2022, 8), "/x"), F.lit("https://a.example/x"))
    return table(spark, sf, "orders").select("o_orderkey", rules.year_of_url(url).alias("fiscal_year"))


@query("""select p_partkey, [4, 5, 6, 7, 8, 9, 10, 11, 12, 1, 2, 3][1 : p_size % 12 + 1] as months, cast([] as integer[]) as again, case when p_size % 12 < 10 then '7' else cast(p_size as varchar) end as digits from part""")
def month_digits(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("p_size") % 12 + 1
    months = F.array_join(F.slice(F.array(*(F.lit(str(m)) for m in (4, 5, 6, 7, 8, 9, 10, 11, 12, 1, 2, 3))), F.lit(1), n), "")
    name = F.when(F.col("p_size") % 12 < 10, "k2024_7.xlsx").otherwise(F.concat(F.lit("k"), F.col("p_size").cast("string")))
    return table(spark, sf, "part").select("p_partkey", text.rolling_months(months).alias("months"), text.rolling_months(F.lit("4564")).alias("again"), text.trailing_digits(name).alias("digits"))


@query("""select s_suppkey, s_name as name, 'Chiyoda / ' || s_suppkey as address, lpad(cast(s_suppkey as varchar), 13, '1') as number from supplier""")
def vendor_addresses(spark: SparkSession, sf: str) -> DataFrame:
    name, address = text.vendor_and_address(F.concat(F.col("s_name"), F.lit("\n Chiyoda \n\n"), F.col("s_suppkey").cast("string")))
    number = F.concat(F.lit("法人番号 "), F.lpad(F.col("s_suppkey").cast("string"), 13, "1"))
    return table(spark, sf, "supplier").select("s_suppkey", name.alias("name"), address.alias("address"), text.corporate_number(number).alias("number"))


@query("""select s_suppkey, list_sort(list_distinct(['F-' || s_suppkey, 'F-' || s_suppkey || 'A', 'F' || s_suppkey, 'F' || s_suppkey || 'A'])) as single,
    list_sort(['H-' || s_suppkey, 'H-' || s_suppkey || 'J', 'H-' || s_suppkey || 'J/JA', 'H-' || s_suppkey || 'JA', 'H' || s_suppkey, 'H' || s_suppkey || 'J', 'H' || s_suppkey || 'J/JA', 'H' || s_suppkey || 'JA']) as double from supplier""")
def model_spellings(spark: SparkSession, sf: str) -> DataFrame:
    model = lambda a, b: F.concat(F.lit(a), F.col("s_suppkey").cast("string"), F.lit(b))
    return table(spark, sf, "supplier").select("s_suppkey", text.model_names(model("F-", "A")).alias("single"), text.model_names(model("H-", "J/JA")).alias("double"))


@query("""select n_nationkey, case when n_nationkey % 3 = 2 then 'ab, ' || n_name || ', c, d, e, f, g, h, i, j, k, l 他2件' else n_name || ', b' end as listed,
    case when length(n_name) > 6 then substr(n_name, 1, 6) || '…' else n_name end as shown, case when n_nationkey % 2 = 0 then 2019 + n_nationkey % 2 else 1989 + n_nationkey end::int as year from nation""")
def shown_lists(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n_name")
    many = F.array(F.lit("ab"), n, *(F.lit(c) for c in "cdefghijklmn"))
    values = F.when(F.col("n_nationkey") % 3 == 2, many).otherwise(F.array(n, F.lit("b")))
    era = F.when(F.col("n_nationkey") % 2 == 0, "令和元年度").otherwise(F.concat(F.lit("平成"), (F.col("n_nationkey") + 1).cast("string"), F.lit("年")))
    return table(spark, sf, "nation").select("n_nationkey", text.listed(values).alias("listed"), text.truncated(n, 6).alias("shown"), dates.era_year(era).alias("year"))


@query("""select p_partkey, list_sort(list_distinct(list(code))) as codes from part join (values ('small', 1), ('ring', 2), ('red', 3), ('gear', 1), ('blue widget', 4)) as c(name, code) on contains(p_name, name) group by 1""")
def code_sets(spark: SparkSession, sf: str) -> DataFrame:
    """The sorted distinct codes of every programme whose name a contract's name contains."""
    programmes = spark.createDataFrame([("small", 1), ("ring", 2), ("red", 3), ("gear", 1), ("blue widget", 4)], "name string, code int")
    found = linkage.contains_join(table(spark, sf, "part"), programmes, "p_name", "name")
    return found.groupBy("p_partkey").agg(F.sort_array(F.collect_set("code")).alias("codes"))
