"""Merges, votes, cascades, grids and checks of the operators over whole tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions import dates
from tallybrook.operators import coverage, enrichment, intervals, linkage, merge, verify, windows
from tallybrook.sources.ledger import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


@query("""with a as (select user_id, min(event_id) as event_id from events where event_type = 'purchase' group by 1), b as (select user_id, min(event_id) as event_id from events group by 1)
select * from a union all select * from b where user_id not in (select user_id from a)""")
def gap_filled(spark: SparkSession, sf: str) -> DataFrame:
    """Users without a purchase are filled in with their first event."""
    e = table(spark, sf, "events")
    first = lambda d: d.groupBy("user_id").agg(F.min("event_id").alias("event_id"))
    return merge.gap_fill(first(e.where("event_type = 'purchase'")), first(e), ["user_id"])


@query("""with f as (select l_orderkey, max(l_shipdate) as last, count(*) filter (l_returnflag = 'R') > 0 as returned from lineitem group by 1)
select o_orderkey, case when f.returned then 'R' else o_orderstatus end as o_orderstatus, coalesce(f.returned, false) as flag from orders left join f on l_orderkey = o_orderkey""")
def flagged_patch(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with a returned line get a status of their own, and a flag."""
    returned = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), F.lit("R").alias("o_orderstatus"), F.lit(True).alias("flag")).distinct()
    return merge.patch(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.lit(False).alias("flag")), returned, "o_orderkey", ["o_orderstatus", "flag"])


@query("""with e as (select user_id, event_type, event_id, value from events), k as (select * from e where event_type = 'signup'), n as (select * from e where event_type <> 'signup'),
f as (select *, row_number() over (partition by user_id, event_type order by event_id) as r from n)
select user_id, event_type, event_id, value from k union all select user_id, event_type, event_id, value from f where r = 1""")
def protected_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Sign-ups stay as they are; of everything else the first row of each user and type enters."""
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    return merge.replace_unprotected(e, e.where("event_type <> 'signup'"), ["user_id", "event_type"], F.col("event_type") == "signup", "event_id")


@query("""with n as (select s_nationkey, count(*) as suppliers from supplier group by 1), e as (select c_nationkey, count(*) as customers from customer group by 1)
select n_nationkey, customers, coalesce(suppliers, 0) as actual, coalesce(suppliers, 0) - customers as difference from nation join e on c_nationkey = n_nationkey left join n on s_nationkey = n_nationkey where coalesce(suppliers, 0) < customers order by abs(coalesce(suppliers, 0) - customers) desc, n_nationkey limit 20""")
def shortfalls(spark: SparkSession, sf: str) -> DataFrame:
    """The twenty nations with most fewer suppliers than customers."""
    expected = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"))
    actual = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"))
    return verify.largest_gaps(verify.missing(expected, actual, ["n_nationkey"], "customers"), ["n_nationkey"]).drop("ok")


@query("""select o_orderpriority, year(o_orderdate)::int as year, count(*) as cells, count(*) filter (o_orderstatus <> 'P') as filled, round(count(*) filter (o_orderstatus <> 'P') / count(*), 4) as rate from orders group by 1, 2""")
def coverage_rates(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "filled").when(F.col("o_orderstatus") == "O", "filled_new").otherwise("dash")
    return coverage.rates(table(spark, sf, "orders").select("o_orderpriority", F.year("o_orderdate").alias("year"), status.alias("status")), ["o_orderpriority", "year"])


@query("""with y as (select distinct o_custkey, year(o_orderdate) as y from orders), c as (select c_custkey, 1995 + c_custkey % 9 as wanted from customer),
r as (select c_custkey, wanted, y, row_number() over (partition by c_custkey order by abs(y - wanted), y) as k from c join y on o_custkey = c_custkey)
select c_custkey, y::int as nearest, case abs(y - wanted) when 0 then 0.9 when 1 then 0.8 else 0.65 end::double as confidence from r where k = 1""")
def nearest_years(spark: SparkSession, sf: str) -> DataFrame:
    """The year of an order that lies closest to the one wanted, and how sure that is."""
    years = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_set(F.year("o_orderdate")).alias("years"))
    c = table(spark, sf, "customer").select("c_custkey", (F.lit(1995) + F.col("c_custkey") % 9).cast("int").alias("wanted")).join(years, "c_custkey")
    return c.select("c_custkey", linkage.nearest_year(F.col("wanted"), F.col("years")).alias("nearest"), linkage.year_confidence(F.col("wanted"), F.col("years")).cast("double").alias("confidence"))


@query("""with h as (select p_partkey, p_name, p_type, [case when contains(p_name, 'small') or contains(p_name, 'ring') then {'c': 0.7, 's': -1, 'l': 'a'} end, case when contains(p_name, 'red') then {'c': 0.9, 's': -2, 'l': 'b'} end] as o from part),
b as (select p_partkey, p_type, p_name, list_max(list_filter(o, lambda x: x is not null)) as m from h),
f as (select p_partkey, p_type, case when regexp_matches(p_name, 'gear|ring') and coalesce(m.c, 0) < 0.8 then 'c' else m.l end as label, case when regexp_matches(p_name, 'gear|ring') and coalesce(m.c, 0) < 0.8 then 0.85 else m.c end as confidence from b)
select p_partkey as id, coalesce(label, case when contains(p_type, 'BRASS') then 'd' when contains(p_type, 'STEEL') then 'e' end) as label, cast(coalesce(confidence, case when contains(p_type, 'BRASS') then 0.4 when contains(p_type, 'STEEL') then 0.3 end) as double) as confidence from f""")
def category_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """The surest keyword rule, then a rule under a bar, then rules by another column for rows that have no label yet."""
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("contract_name"), "p_type")
    found = enrichment.category(p, [(["small", "ring"], "a", 0.7), (["red"], "b", 0.9)], [("gear|ring", "c", 0.85, 0.8)])
    rest = [(F.contains("p_type", F.lit("BRASS")), "d", 0.4), (F.contains("p_type", F.lit("STEEL")), "e", 0.3)]
    return enrichment.org_fallback(found.join(p.select("id", "p_type"), "id"), rest).select("id", "label", "confidence")


@query("""with n as (select s_nationkey, s_suppkey, s_name, count(*) over (partition by s_nationkey) as c from supplier), v as (select c_nationkey, c_mktsegment, count(*) as votes, min(c_custkey) as first from customer group by 1, 2),
m as (select c_nationkey, c_mktsegment, row_number() over (partition by c_nationkey order by votes desc, first) as r from v)
select s_suppkey as id, case when c = 1 then 'only' when c_mktsegment is not null then 'majority' else 'default' end as source, case when c = 1 then s_name else coalesce(c_mktsegment, 'none') end as org,
    case when c = 1 then 0.9 when c_mktsegment is not null then 0.5 else 0.3 end::double as confidence from n left join m on m.c_nationkey = s_nationkey and r = 1""")
def majority_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """A key's only name, else the majority among its neighbours, else a default."""
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("vendor"), F.col("s_name").alias("org"))
    voters = table(spark, sf, "customer").select(F.col("c_nationkey").alias("vendor"), F.col("c_mktsegment").alias("org"), F.col("c_custkey").alias("seq"))
    return enrichment.majority_cascade(s, voters, "only", "majority", "none")


@query("""with l as (select doc_id, quality from labels), p as (select doc_id, case when length(text) > 200 then 1 else 0 end as q from documents) select count(*) as rows, round(avg((q = quality)::int), 6) as accuracy from l join p using (doc_id)""")
def label_agreement(spark: SparkSession, sf: str) -> DataFrame:
    predicted = table(spark, sf, "documents").select("doc_id", (F.length("text") > 200).cast("int").alias("label"))
    return enrichment.agreement(predicted, table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id")


@query("""with e as (select user_id, event_type, row_number() over (partition by user_id, event_type order by event_id) as dup_ordinal, event_id as payload, count(*) over (partition by user_id, event_type) as rows,
    min(event_id) over (partition by user_id, event_type) <> max(event_id) over (partition by user_id, event_type) as differ from events),
i as (select user_id, event_type, list(event_id order by event_id) as ids from events where event_type <> 'view' group by 1, 2),
j as (select e.*, ids, coalesce(len(ids), 0) as n from e left join i using (user_id, event_type))
select user_id, event_type, dup_ordinal, payload, case when n = 0 then 'unmatched' else 'matched' end as status, case when n > 0 then ids[dup_ordinal] end as id from j""")
def relinked_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Events found again by natural keys and an ordinal; the views have no id left."""
    e = table(spark, sf, "events")
    keyed = linkage.with_ordinals(e.select("user_id", "event_type", F.col("event_id").alias("payload")), ["user_id", "event_type"], "payload").select("user_id", "event_type", F.col("dup_ordinal").cast("long").alias("dup_ordinal"), "payload")
    return linkage.relinked(keyed, e.where("event_type <> 'view'").select("user_id", "event_type", F.col("event_id").alias("id")), ["user_id", "event_type"], "payload")


@query("""select p_brand, p_partkey, case when lag(p_partkey) over w is null then -1.0 else (p_partkey + lag(p_partkey) over w) / 2.0 end::double as lo, case when lead(p_partkey) over w is null then 1e12 else (p_partkey + lead(p_partkey) over w) / 2.0 end::double as hi from part window w as (partition by p_brand order by p_partkey)""")
def bands(spark: SparkSession, sf: str) -> DataFrame:
    b = windows.midpoint_bands(table(spark, sf, "part").select("p_brand", "p_partkey"), ["p_brand"], "p_partkey")
    return b.withColumns({"lo": F.greatest("lo", F.lit(-1.0)), "hi": F.least("hi", F.lit(1e12))})


@query("""with s as (select o_custkey, case when month(o_orderdate) >= 4 then year(o_orderdate) else year(o_orderdate) - 1 end as fy, min(o_orderdate) as a, max(o_orderdate) as b from orders group by 1, 2)
select o_custkey, fy::int as fiscal_year, month(m)::int as month from (select o_custkey, fy, unnest(generate_series(date_trunc('month', a), date_trunc('month', b), interval 1 month)) as m from s where date_diff('day', a, b) >= 60)""")
def rolling_months_of_files(spark: SparkSession, sf: str) -> DataFrame:
    """Months that a customer's orders of a fiscal year span, where they span sixty days."""
    o = table(spark, sf, "orders").withColumn("fiscal_year", dates.fiscal_year(F.col("o_orderdate")))
    files = o.groupBy("o_custkey", "fiscal_year").agg(F.min("o_orderdate").cast("date").alias("first"), F.max("o_orderdate").cast("date").alias("last"))
    files = files.select(F.concat(F.lit("f"), F.col("o_custkey").cast("string"), F.lit("x")).alias("file"), F.col("o_custkey").alias("agency"), "fiscal_year", "first", "last")
    return coverage.rolling_cells(files).select(F.col("agency").alias("o_custkey"), "fiscal_year", "month")


@query("""with r as (select p_partkey as rule, p_name, p_type as label, round(p_size / 100, 2)::double as confidence from part), k as (select rule, unnest(string_split(p_name, ' ')) as keyword, generate_subscripts(string_split(p_name, ' '), 1) as place, label, confidence from r)
select rule, place::int as place, keyword, label, confidence, count(distinct rule) over (partition by keyword) as rules from k""")
def rule_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Part names as rules of alternatives."""
    rules = table(spark, sf, "part").select(F.col("p_partkey").alias("rule"), "p_name", "p_type", F.round(F.col("p_size") / 100, 2).alias("confidence"))
    return enrichment.catalogue(rules, "p_name", "p_type", " ")


#: The rules of `requesting_orgs`; its SQL states them again.
ORGS = {"ECONOMY": "GSDF", "SMALL": "MSDF", "MEDIUM": "ASDF", "PROMO": "JOINT"}


@query("""with item as (select l_orderkey, min(l_partkey) as p_partkey from lineitem group by 1),
c as (select o_orderkey as id, case o_custkey % 10 when 0 then 'nda' when 1 then 'zzz' when 2 then 'ATLA_x' else 'atla' end as agency, 'V' || o_custkey as vendor, month(o_orderdate) as m, year(o_orderdate - interval 3 month) as fy,
  case o_orderkey % 3 when 0 then p_name || ' ' || p_size when 1 then lower(p_brand) || ' ' || p_size || ' spare' else lower(p_brand) || ' ' || substr(o_orderpriority, 3) end as name from orders join item on l_orderkey = o_orderkey join part using (p_partkey)),
pl as (select p_partkey as id, case p_type when 'ECONOMY' then 'GSDF' when 'SMALL' then 'MSDF' when 'MEDIUM' then 'ASDF' when 'PROMO' then 'JOINT' else 'ATLA' end as org, case when p_partkey % 4 = 0 then lower(p_brand) || ' ' || p_size else p_name || ' ' || p_size end as name, 1992 + p_partkey % 8 as fy, 4 + p_partkey % 12 as month from part),
g as (select name, min(org) as lo, max(org) as hi, min(id) as ref, list(distinct fy) as years from pl group by 1),
n as (select distinct name from c), nr as (select n.name, g.lo as org, g.ref, g.years, row_number() over (partition by n.name order by length(g.name) desc, g.ref) as k from n join g on g.lo = g.hi and ((contains(n.name, g.name) and length(g.name) >= 4) or (contains(g.name, n.name) and length(n.name) >= 4))),
v as (select name, org, count(*) as k, min(id) as ref from pl group by 1, 2), mj as (select name, org, ref, row_number() over (partition by name order by k desc, ref) as r from v where name in (select name from g where lo <> hi)),
mo as (select name, month, case when min(org) = max(org) then min(org) end as org, min(id) as ref from pl where name in (select name from g where lo <> hi) group by 1, 2),
e as (select l_orderkey as id, case p_size when 10 then 'GSDF' when 20 then 'MSDF' when 30 then 'ASDF' when 40 then 'GSDF' end as branch, l_linenumber * 1000000 + l_partkey as seq, case p_size when 3 then 'J1' when 4 then 'J2' when 13 then 'J1' end as joint from lineitem join part on p_partkey = l_partkey),
eb as (select id, branch, row_number() over (partition by id order by count(*) desc, min(seq)) as r from e where branch is not null group by id, branch),
ej as (select id, min(joint) as org from e where joint is not null group by 1 having min(joint) = max(joint)),
x as (select c.*, g.lo as exact_org, g.ref as exact_ref, nr.org as near_org, nr.ref as near_ref, list_min(list_transform(nr.years, lambda y: abs(y - c.fy))) as apart, mj.org as most_org, mj.ref as most_ref, coalesce(f.name, p.name) as in_month,
  case when f.name is not null then f.org else p.org end as month_org, case when f.name is not null then f.ref else p.ref end as month_ref, eb.branch, ej.org as joint
  from c left join g on g.name = c.name and g.lo = g.hi left join nr on nr.name = c.name and nr.k = 1 left join mj on mj.name = c.name and mj.r = 1
  left join mo f on f.name = c.name and f.month = case when c.m >= 4 then c.m else c.m + 12 end left join mo p on p.name = c.name and p.month = c.m left join eb on eb.id = c.id and eb.r = 1 left join ej on ej.id = c.id),
z as (select id, case when agency = 'nda' then {'o': 'NDA', 's': 'agency', 'c': 1.0, 'r': null::bigint} when agency = 'zzz' then {'o': 'ATLA', 's': 'fallback', 'c': 0.3, 'r': null::bigint} when agency = 'ATLA_x' then {'o': 'ATLA', 's': 'sub_agency', 'c': 0.5, 'r': null::bigint}
  when exact_org is not null then {'o': exact_org, 's': 'exact', 'c': 0.9, 'r': exact_ref} when near_org is not null then {'o': near_org, 's': 'contained', 'c': case apart when 0 then 0.9 when 1 then 0.8 else 0.65 end, 'r': near_ref}
  when contains(name, 'gizmo 4') then {'o': 'MSDF', 's': 'override', 'c': 0.85, 'r': null::bigint} when month_org is not null then {'o': month_org, 's': 'month', 'c': 0.7, 'r': month_ref} when most_org is not null then {'o': most_org, 's': 'majority', 'c': 0.5, 'r': most_ref}
  when branch is not null then {'o': branch, 's': 'branch', 'c': 0.7, 'r': null::bigint} when starts_with(vendor, 'V12') then {'o': 'FMS', 's': 'vendor', 'c': 0.5, 'r': null::bigint} when contains(name, 'brand#13') then {'o': 'GSDF', 's': 'keyword', 'c': 0.75, 'r': null::bigint}
  when contains(name, 'urgent') or contains(name, 'URGENT') then {'o': 'MSDF', 's': 'inferred', 'c': 0.5, 'r': null::bigint} when joint is not null then {'o': joint, 's': 'inferred', 'c': 0.5, 'r': null::bigint} else {'o': 'ATLA', 's': 'fallback', 'c': 0.3, 'r': null::bigint} end as a from x)
select id, a.o as org, a.s as source, a.c::double as confidence, a.r as ref from z""")
def requesting_orgs(spark: SparkSession, sf: str) -> DataFrame:
    """The whole cascade over every order: names of parts, planned items by part, equipment by item."""
    part, line = table(spark, sf, "part"), table(spark, sf, "lineitem")
    item = line.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_partkey").alias("p_partkey"))
    size, brand = F.col("p_size").cast("string"), F.lower("p_brand")
    which = F.col("o_orderkey") % 3
    name = F.when(which == 0, F.concat_ws(" ", "p_name", size)).when(which == 1, F.concat_ws(" ", brand, size, F.lit("spare"))).otherwise(F.concat_ws(" ", brand, F.substring("o_orderpriority", 3, 100)))
    agency = F.when(F.col("o_custkey") % 10 == 0, "nda").when(F.col("o_custkey") % 10 == 1, "zzz").when(F.col("o_custkey") % 10 == 2, "ATLA_x").otherwise("atla")
    day = F.col("o_orderdate").cast("date")
    contracts_ = table(spark, sf, "orders").join(item, "o_orderkey").join(part, "p_partkey").select(F.col("o_orderkey").alias("id"), agency.alias("agency_id"), name.alias("contract_name"), name.alias("name_norm"), F.concat(F.lit("V"), "o_custkey").alias("vendor_name"), F.date_format(day, "yyyyMMdd").alias("contract_date"), dates.fiscal_year(day).alias("fiscal_year"))
    org = F.coalesce(*(F.when(F.col("p_type") == t, F.lit(o)) for t, o in ORGS.items()), F.lit("ATLA"))
    plan = part.select(F.col("p_partkey").alias("id"), org.alias("org"), F.when(F.col("p_partkey") % 4 == 0, F.concat_ws(" ", brand, size)).otherwise(F.concat_ws(" ", "p_name", size)).alias("name_norm"), (1992 + F.col("p_partkey") % 8).cast("int").alias("fiscal_year"), (4 + F.col("p_partkey") % 12).cast("int").alias("month"))
    links = line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("id"), (F.col("l_linenumber") * 1_000_000 + F.col("l_partkey")).alias("seq"), "p_size")
    branch = F.when(F.col("p_size").isin(10, 40), "GSDF").when(F.col("p_size") == 20, "MSDF").when(F.col("p_size") == 30, "ASDF")
    branches = links.select("id", branch.alias("branch"), "seq").where("branch is not null")
    joint = links.select("id", F.when(F.col("p_size").isin(3, 13), "J1").when(F.col("p_size") == 4, "J2").alias("org")).where("org is not null")
    return enrichment.requesting_org(contracts_, plan, [("nda", "NDA")], [("gizmo 4", "MSDF")], [("urgent|URGENT", "MSDF")], [("V12", "FMS")], "ATLA", [("brand#13", "GSDF")], branches, joint)


@query("""with i as (select date_diff('day', date '1970-01-01', l_shipdate::date) as a, date_diff('day', date '1970-01-01', l_shipdate::date) + l_quantity::int * case when l_linenumber = 7 then 30 else 1 end as b, l_quantity::int as q from lineitem),
d as (select distinct date_diff('day', date '1970-01-01', o_orderdate::date) as day from orders), n as (select day, count(*) as items, sum(q) as quantity from d join i on day between a and b group by 1)
select o_orderkey, coalesce(items, 0)::bigint as items, coalesce(quantity, 0)::bigint as quantity from orders left join n on day = date_diff('day', date '1970-01-01', o_orderdate::date)""")
def items_in_transit(spark: SparkSession, sf: str) -> DataFrame:
    """For each order, the items under way on its date, some of them for years: a range join without a nested loop."""
    day = lambda c: F.unix_date(F.col(c).cast("date"))
    long = F.when(F.col("l_linenumber") == 7, 30).otherwise(1)
    under_way = table(spark, sf, "lineitem").select(day("l_shipdate").alias("a"), F.col("l_quantity").cast("int").alias("q"), long.alias("by")).select("a", (F.col("a") + F.col("q") * F.col("by")).alias("b"), "q")
    orders = table(spark, sf, "orders").select("o_orderkey", day("o_orderdate").alias("day"))
    both = under_way.groupBy("a", "b").agg(F.count("*").alias("n"), F.sum("q").alias("q"))
    out = intervals.counted(intervals.counted(orders, both, "day", ("a", "b"), "items", "n"), both, "day", ("a", "b"), "quantity", "q")
    return out.select("o_orderkey", F.col("items").cast("long").alias("items"), F.col("quantity").cast("long").alias("quantity"))


@query("""select x.o_custkey, count(*) as pairs, min(date_diff('day', x.o_orderdate::date, y.o_orderdate::date)) as nearest from orders x join orders y on x.o_custkey = y.o_custkey and x.o_orderkey <> y.o_orderkey
and y.o_orderdate::date between x.o_orderdate::date and x.o_orderdate::date + interval 90 day group by 1""")
def orders_soon_after(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of a customer's orders of which one follows the other within 90 days: a range join within a key."""
    o = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("x"), F.unix_date(F.col("o_orderdate").cast("date")).alias("a"))
    later = o.select("o_custkey", F.col("x").alias("y"), F.col("a").alias("p"))
    pairs = intervals.overlapping(o.withColumn("b", F.col("a") + 90), later, ("a", "b"), ("p", "p"), ["o_custkey"]).where("x <> y")
    return pairs.groupBy("o_custkey").agg(F.count("*").alias("pairs"), F.min(F.col("p") - F.col("a")).cast("long").alias("nearest"))
