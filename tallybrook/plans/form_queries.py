"""Values of whole tables written in the forms of cells, names, lines and sheets, and read back by the source's rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions import rules
from tallybrook.operators import coverage, enrichment, linkage
from tallybrook.sources import grids, reports
from tallybrook.sources.ledger import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def one_of(key: str, options: list[str | None]) -> Column:
    """The option at key modulo their number."""
    at = F.pmod(F.col(key), F.lit(len(options)))
    return reduce(lambda c, i: c.when(at == i, F.lit(options[i])), range(1, len(options)), F.when(at == 0, F.lit(options[0])))


@query("""with t as (select o_orderkey, o_orderkey % 6 as k from orders)
select o_orderkey, case k when 0 then '一般競争入札' when 1 then '随意契約' when 2 then '不明' when 3 then 'その他の方式' when 4 then '不明' else '随意契約' end as shown,
case k when 0 then '一般競争入札' when 1 then '随意契約' when 2 then null when 3 then 'その他の方式' when 4 then null else '随意契約' end as cleaned,
case o_orderkey % 4 when 0 then '随契' when 1 then '競争' when 2 then '競争' end as kind, month(o_orderdate) as month from orders join t using (o_orderkey)""")
def bid_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Methods as shown and as cleaned, kinds of files by name, months in three spellings."""
    o = table(spark, sf, "orders")
    bid = one_of("o_orderkey", ["一般競争", " 随意契約（少額）", "－", "その他の方式", "", "特命 随意"])
    cleaned = rules.bid_cleaned(bid, [(["一般競争"], "一般競争入札"), (["随意"], "随意契約")], ["-"])
    name = one_of("o_orderkey", ["a_zuikei01.pdf", "b_k.xlsx", "c_K_2.pdf", "d_kk.pdf"])
    month = F.month("o_orderdate").cast("string")
    spelt = F.when(F.col("o_orderkey") % 3 == 0, F.concat(month, F.lit(" 月分"))).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("2024/"), month)).otherwise(F.translate(month, "0123456789", "０１２３４５６７８９"))
    return o.select("o_orderkey", rules.bid_shown(bid, {"一般競争": "一般競争入札"}, ["随意"]).alias("shown"), cleaned.alias("cleaned"), rules.kind_of_file(name).alias("kind"), rules.month_of_text(spelt).alias("month"))


@query("""with t as (select p_partkey, p_name, string_split(p_name, ' ') as w from part)
select p_partkey, p_partkey % 5 in (0, 4) as valid, list_aggregate(list_filter([w[1], w[2]], lambda x: length(x) >= 4 and x <> 'gear'), 'string_agg', '|') as terms,
case p_partkey % 4 when 0 then 'GSDF' when 1 then 'MSDF' when 2 then 'ASDF' end as org from t""")
def name_forms_of_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Names that are valid, their telling words, and organisations by the longest keyword, that in parentheses first."""
    p = table(spark, sf, "part")
    name = F.when(F.col("p_partkey") % 5 == 0, F.col("p_name")).when(F.col("p_partkey") % 5 == 1, "12 - 3").when(F.col("p_partkey") % 5 == 2, F.concat("p_name", F.lit("。"))).when(F.col("p_partkey") % 5 == 3, F.repeat("p_name", 40)).otherwise(F.substring("p_name", 1, 2))
    terms = rules.terms(F.concat("p_name", F.lit("の整備")), ["の整備"], ["gear"])
    office = one_of("p_partkey", ["統合局（陸上）", "海上局", "海上局（航空室）", "本部"])
    found = rules.longest_keyword(office, [("陸上", "GSDF"), ("海上", "MSDF"), ("航空室", "ASDF")])
    return p.select("p_partkey", rules.name_is_valid(name).alias("valid"), F.nullif(F.array_join(terms, "|"), F.lit("")).alias("terms"), found.alias("org"))


@query("""with v as (select page_id, unnest(list_distinct([url, regexp_replace(url, '#.*$', ''), case when starts_with(url, 'https:') then regexp_replace(regexp_replace(url, '#.*$', ''), '^https:', 'http:') else regexp_replace(regexp_replace(url, '#.*$', ''), '^http:', 'https:') end,
regexp_replace(regexp_replace(url, '#.*$', ''), '\\?.*$', ''), regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), '\\?.*$', ''), '/index\\.html?$', '/'), regexp_replace(regexp_replace(url, '#.*$', ''), '://www\\.', '://')])) as address from pages where url is not null)
select page_id, count(*) as variants, min(address) as least, max(address) as greatest from v group by 1""")
def url_spellings(spark: SparkSession, sf: str) -> DataFrame:
    """The addresses to try for each page."""
    each = table(spark, sf, "pages").where("url is not null").select("page_id", F.explode(rules.url_variants(F.col("url"))).alias("address"))
    return each.groupBy("page_id").agg(F.count("*").alias("variants"), F.min("address").alias("least"), F.max("address").alias("greatest"))


@query("""with t as (select p_partkey, p_type, p_name, row_number() over (partition by p_size order by p_partkey) as k, p_size from part),
s as (select *, last_value(case when p_partkey % 5 = 0 then p_type end ignore nulls) over (partition by p_size order by p_partkey rows between unbounded preceding and current row) as section from t)
select p_size::varchar as file_id, p_partkey::int as page, section, p_name as name from s where p_partkey % 3 <> 0""")
def report_bullets(spark: SparkSession, sf: str) -> DataFrame:
    """Bullets under the last heading of their report, which may stand pages before; names without what is in parentheses."""
    p = table(spark, sf, "part")
    heading = F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("## "), "p_type"))
    bullet = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("○ "), F.col("p_partkey").cast("string"))).otherwise(F.concat(F.lit("○ "), "p_name", F.lit("（注）")))
    lines = p.select(F.col("p_size").cast("string").alias("file_id"), F.col("p_partkey").cast("int").alias("page"), F.posexplode(F.array(heading, bullet)).alias("line", "text")).where("text is not null")
    return reports.bullets(lines, "^## (.*)$", "^○ (.*)$").select("file_id", "page", "section", "name")


@query("""select o_orderkey::int as page, case when o_orderkey % 2 = 0 then 'even' else 'odd' end as category, u.name as name, u.oku::double as oku from (select o_orderkey, unnest([{'name': 'plan of ' || o_custkey, 'oku': floor(o_totalprice)}, {'name': 'more for ' || o_orderpriority, 'oku': 20000 + o_orderkey % 10}]) as u from orders)""")
def category_amounts(spark: SparkSession, sf: str) -> DataFrame:
    """Two bullets to a line with amounts in hundreds of millions and in trillions, by the category of their page."""
    o = table(spark, sf, "orders")
    amount = F.format_number(F.floor("o_totalprice"), 0)
    text_ = F.concat(F.lit("○plan of "), F.col("o_custkey").cast("string"), F.lit("（"), amount, F.lit("億円）●more for "), "o_orderpriority", F.lit("(2兆"), (F.col("o_orderkey") % 10).cast("string"), F.lit("億円)"))
    page = F.col("o_orderkey").cast("int").alias("page")
    lines = o.select(F.lit("f").alias("file_id"), page, text_.alias("text"))
    pages = o.select(F.lit("f").alias("file_id"), page, F.when(F.col("o_orderkey") % 2 == 0, "even").otherwise("odd").alias("category"))
    return reports.category_lines(lines, pages).select("page", "category", "name", "oku")


@query("""with k as (select o_custkey, o_orderkey, year(o_orderdate) as y, o_orderpriority, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as i from orders)
select o_custkey::varchar as file_id, o_orderkey::varchar as text, (2019 + (i - 1) // 3 % 5)::int as fiscal_year, case (i - 1) // 3 % 2 when 0 then '事前' else '事後' end as kind from k""")
def portal_lists(spark: SparkSession, sf: str) -> DataFrame:
    """A customer's orders as rows of a portal, three under each heading that gives era year and kind."""
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey"))).alias("orders"))
    part = lambda j: F.floor(j / 3).cast("int")
    heading = lambda j: F.struct((F.col("i") * 2).alias("line"), F.lit(True).alias("is_heading"), F.format_string("令和%s年度 %s評価", F.when(part(j) % 5 == 0, "元").otherwise((part(j) % 5 + 1).cast("string")), F.when(part(j) % 2 == 0, "事前").otherwise("事後")).alias("text"))
    row = F.struct((F.col("i") * 2 + 1).alias("line"), F.lit(False).alias("is_heading"), F.col("o.o_orderkey").cast("string").alias("text"))
    lines = o.select("o_custkey", F.posexplode("orders").alias("i", "o")).select(F.col("o_custkey").cast("string").alias("file_id"), F.inline(F.when(F.col("i") % 3 == 0, F.array(heading(F.col("i")), row)).otherwise(F.array(row))))
    return reports.portal_rows(lines).select("file_id", "text", "fiscal_year", "kind")


@query("""select o_orderkey, strftime(o_orderdate, '%Y%m%d') as contract_date, (year(o_orderdate - interval 3 month))::int as fiscal_year, case when floor(o_totalprice) >= 10000 then floor(o_totalprice) else 77777 end::bigint as contract_amount, 'vendor ' || o_custkey as vendor_name from orders""")
def dated_files(spark: SparkSession, sf: str) -> DataFrame:
    """One-contract files with the date in their name, now and then with a digit too many."""
    digits = F.date_format("o_orderdate", "yyyyMMdd")
    slip = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.substring(digits, 1, 4), F.lit("0"), F.substring(digits, 5, 4))).otherwise(digits)
    cells = F.array(F.lit("件名"), F.lit("12"), F.format_number(F.floor("o_totalprice"), 0), F.lit("77,777"), F.concat(F.lit("vendor "), F.col("o_custkey").cast("string")))
    files = table(spark, sf, "orders").select(F.concat(F.col("o_orderkey").cast("string"), F.lit("_"), slip, F.lit(".xlsx")).alias("file"), cells.alias("cells"))
    return reports.dated_results(files).select(F.split("file", "_")[0].cast("long").alias("o_orderkey"), "contract_date", "fiscal_year", "contract_amount", "vendor_name")


@query("""select (p_partkey % 20)::varchar as file_id, p_partkey::int as row, case p_partkey % 3 when 0 then 'army' else 'navy' end as org, p_name as item_name, lower(replace(p_name, ' ', '')) as item_name_norm, p_size::varchar as qty, (case when p_size % 12 + 1 >= 4 then p_size % 12 + 1 else p_size % 12 + 13 end)::int as contract_month from part where p_partkey % 3 <> 2""")
def planned_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Sheets of planned items, by code; unknown codes are left out."""
    month = F.concat(((F.col("p_size") % 12) + 1).cast("string"), F.lit("月"))
    grid = table(spark, sf, "part").select((F.col("p_partkey") % 20).cast("string").alias("file_id"), F.col("p_partkey").cast("int").alias("row"), F.array(one_of("p_partkey", ["A1", "B2", "?"]), F.col("p_name"), F.col("p_size").cast("string"), month).alias("cells"))
    return reports.planned_items(grid, {"A1": "army", "B2": "navy"})


@query("""with l as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as k from lineitem),
b as (select *, case when l_returnflag = 'A' then '一般競争入札' when l_returnflag = 'N' then null else '随意契約' end as own from l)
select l_orderkey::varchar as file_id, 'part ' || l_partkey as contract_name, 'S' || l_suppkey as vendor_name, '東京都' as vendor_address, floor(l_extendedprice)::bigint as contract_amount, strftime(l_shipdate, '%Y%m%d') as contract_date, year(l_shipdate - interval 3 month)::int as fiscal_year,
case when l_returnflag = 'N' then last_value(own ignore nulls) over (partition by l_orderkey order by k rows between unbounded preceding and current row) else own end as bid_method from b""")
def grid_records(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as sheets: titles above a header at some height, columns in two orders, ditto marks for the method."""
    item = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_returnflag")
    orders = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("file_id")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    lines = orders.select("file_id", F.col("file_id").cast("long").alias("l_orderkey"), F.posexplode("items").alias("at", "i"))
    bid = F.when(F.col("i.l_returnflag") == "A", "一般競争").when(F.col("i.l_returnflag") == "N", "〃").otherwise("随意契約")
    cells = [F.concat(F.lit("part "), F.col("i.l_partkey").cast("string")), F.concat(F.lit("S"), F.col("i.l_suppkey").cast("string"), F.lit("\n東京都")), F.format_number(F.floor("i.l_extendedprice"), 0), F.date_format("i.l_shipdate", "yyyy/MM/dd"), bid]
    order = lambda c: F.when(F.col("l_orderkey") % 2 == 1, F.array(*c[::-1])).otherwise(F.array(*c))
    row = lambda n, c: F.struct(F.lit(n).alias("row"), c.alias("cells"))
    head = order([F.lit(x) for x in ("契約件名", "相手方の 商号", "契約金額（円）", "契約締結日", "入札方式")])
    short = F.col("l_orderkey") % 3 == 0
    top = F.when(short, F.array(row(0, F.array(F.lit("公表"))), row(1, head))).otherwise(F.array(row(0, F.array(F.lit("令和"))), row(1, F.array(F.lit("契約件名"))), row(2, head)))
    body = F.array(F.struct((F.col("at") + F.when(short, 2).otherwise(3)).alias("row"), order(cells).alias("cells")))
    grid = lines.select("file_id", F.inline(F.when(F.col("at") == 0, F.concat(top, body)).otherwise(body)))  # a sheet's rows stay together
    fields = [("件名", "contract_name"), ("相手方", "vendor_name"), ("契約金額", "contract_amount"), ("締結日", "contract_date"), ("方式", "bid_method")]
    out = grids.sheet_records(grid, ["件名", "契約金額", "締結日"], fields, [("一般競争", "一般競争入札"), ("随意", "随意契約")])
    return out.drop("row")


@query("""with c as (select p_partkey as id, p_name || ' set' as n from part), p as (select p_name as n, p_type as org, string_split(p_name, ' ') as terms from part where p_size <= 5),
w as (select c.id, p.org from c join p on (contains(c.n, p.n) or contains(p.n, c.n)) and length(c.n) >= 6 and length(p.n) >= 6), f as (select id, min(org) as org from w group by 1 having min(org) = max(org)),
t as (select distinct org, unnest(terms) as term from p), h as (select c.id, t.org, count(*) as k from c join t on contains(c.n, t.term) group by 1, 2),
r as (select id, org, k, row_number() over (partition by id order by k desc, org) as i, lead(k) over (partition by id order by k desc, org) as next from h), s as (select id, org from r where i = 1 and coalesce(next, 0) < k)
select c.id, coalesce(f.org, s.org) as org, case when f.org is not null then 'full_match' else 'kw_match' end as source from c left join f on f.id = c.id left join s on s.id = c.id where coalesce(f.org, s.org) is not null""")
def programme_names(spark: SparkSession, sf: str) -> DataFrame:
    """Parts against programmes: a name within a name if all agree, else the plurality of shared words."""
    p = table(spark, sf, "part")
    programmes = p.where("p_size <= 5").select(F.col("p_name").alias("name_norm"), F.col("p_type").alias("org"), F.split("p_name", " ").alias("terms"))
    return enrichment.programme_fallback(p.select(F.col("p_partkey").alias("id"), F.concat("p_name", F.lit(" set")).alias("name_norm")), programmes)


@query("""with g as (select page_id as id, url, case when page_id % 5 = 0 then 'filled' else 'dash' end as status, lower(list_last(string_split(regexp_extract(url, '^[^?#]*'), '/'))) as file from pages where url is not null),
l as (select url, lower(list_last(string_split(regexp_extract(url, '^[^?#]*'), '/'))) as file from pages where page_id % 4 = 0 and url is not null),
s as (select g.*, case when url in (select url from l) then 'exact' when file <> '' and file in (select file from l where file <> '') then 'file' end as strategy from g)
select id, url, case when status = 'dash' and strategy is not null then 'filled_new' else status end as status, strategy from s""")
def grid_status(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of a crawl's grid that become filled by what was loaded: by address, archived page or file name."""
    p = table(spark, sf, "pages").where("url is not null")
    cells = p.select(F.col("page_id").alias("id"), "url", F.when(F.col("page_id") % 5 == 0, "filled").otherwise("dash").alias("status"))
    return coverage.reconciled(cells, p.where("page_id % 4 = 0").select(F.col("url").alias("source_url")))


@query("""with n as (select p_partkey as id, p_name as exact, replace(p_name, ' ', '') as squeezed, split_part(p_name, ' ', 2) as word from part),
k as (select o_orderkey as doc, year(o_orderdate) as fy, p_name as name from orders join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey where l_linenumber = 1),
b as (select name, fy, doc, row_number() over (partition by name order by fy desc, doc) as r from k), d as (select name, fy, doc from b where r = 1)
select n.id, w.name, w.fy::int as fy, w.doc from n join lateral (select name, fy, doc from d where contains(d.name, n.word) order by fy desc, name limit 1) w on true""")
def latest_like(spark: SparkSession, sf: str) -> DataFrame:
    """For each part, the latest programme whose name holds its second word: of one year, the first by name."""
    p = table(spark, sf, "part")
    items = table(spark, sf, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"))
    known = table(spark, sf, "orders").join(items, "o_orderkey").join(p, "p_partkey").select(F.col("p_name").alias("name"), F.year("o_orderdate").alias("fy"), F.col("o_orderkey").alias("doc"))
    words = p.select(F.col("p_partkey").alias("id"), F.split("p_name", " ")[1].alias("word"))
    return linkage.latest_like(words, known, "id", "word", "name", "fy", "doc")


@query("""with g as (select page_id, lower(list_last(string_split(regexp_extract(url, '^[^?#]*'), '/'))) as filename, case when page_id % 2 = 0 then 'goods' else 'works' end as category, case when page_id % 3 = 0 then null else 'open' end as bid_method from pages where url is not null),
h as (select filename, min(category) as c, max(bid_method) as b from g where filename <> '' group by 1)
select page_id, filename, category, bid_method, c as found_category, b as found_bid from g join h using (filename) where category is distinct from c or bid_method is distinct from b""")
def header_audits(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose file says another kind or method than they do: the file's is the first kind and the last method of its pages."""
    p = table(spark, sf, "pages").where("url is not null")
    name = F.lower(F.element_at(F.split(F.regexp_extract("url", "^[^?#]*", 0), "/"), -1))
    grid = p.select("page_id", name.alias("filename"), F.when(F.col("page_id") % 2 == 0, "goods").otherwise("works").alias("category"), F.when(F.col("page_id") % 3 != 0, "open").alias("bid_method"))
    heads = grid.where("filename <> ''").groupBy("filename").agg(F.min("category").alias("category"), F.max("bid_method").alias("bid_method"))
    return coverage.header_audit(grid, heads).select("page_id", "filename", "category", "bid_method", "found_category", "found_bid")


@query("""with n as (select p_partkey as id, case when p_partkey % 3 = 0 then ' ' || replace(p_name, ' ', chr(12288)) when p_partkey % 3 = 1 then p_name else p_name || '!' end as name from part),
k as (select p_name as name, min(p_partkey) as doc from part group by 1)
select id, doc, case when n.name = k.name then 'exact' else 'plain' end as form from n join k on k.name = trim(replace(n.name, chr(12288), ' '))""")
def names_by_form(spark: SparkSession, sf: str) -> DataFrame:
    """Names as they are, else without wide spaces and blanks at their ends."""
    p = table(spark, sf, "part")
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("　")))).when(F.col("p_partkey") % 3 == 1, F.col("p_name")).otherwise(F.concat("p_name", F.lit("!")))
    known = p.select(F.col("p_name").alias("name"), F.col("p_partkey").alias("doc"))
    return linkage.by_name_forms(p.select(F.col("p_partkey").alias("id"), name.alias("name")), known, "id", "name", "doc")
