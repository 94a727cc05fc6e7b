"""Queries over the ledger view: trends, hierarchies, rankings, shares, windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.functions import dates
from tallybrook.operators import merge, verify, votes, windows
from tallybrook.sources.ledger import CONTRACTS_SQL, contracts, equipment_links, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql.replace("{contracts}", CONTRACTS_SQL)
        return f

    return add


#: Splits the events in two sides; the same moment stands in the SQL.
HALF = "2024-01-16 00:00:00"


def money(c: Column | str) -> Column:
    return F.sum(c).cast("double")


@query("with {contracts} select fiscal_year, count(*) as n, cast(sum(amount) as double) as total from contracts where fiscal_year is not null group by fiscal_year")
def fy_trend(spark: SparkSession, sf: str) -> DataFrame:
    return contracts(spark, sf).where("fiscal_year is not null").groupBy("fiscal_year").agg(F.count("*").alias("n"), money("amount").alias("total"))


@query("with {contracts} select category, agency, bid_method, count(*) as n, cast(sum(amount) as double) as total from contracts group by rollup (category, agency, bid_method)")
def hierarchy_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return contracts(spark, sf).rollup("category", "agency", "bid_method").agg(F.count("*").alias("n"), money("amount").alias("total"))


@query("with {contracts}, g as (select category, agency, sum(amount) as t from contracts group by 1, 2) select category, agency, cast(t as double) as total, round(cast(t as double) / cast(sum(t) over (partition by category) as double), 6) as share from g")
def share_of_parent(spark: SparkSession, sf: str) -> DataFrame:
    return windows.share_of(contracts(spark, sf).groupBy("category", "agency").agg(money("amount").alias("total")), ["category"], "total", "share")


@query("with {contracts} select vendor, count(*) as n, cast(sum(amount) as double) as total from contracts group by vendor_id, vendor order by total desc, vendor limit 20")
def top_vendors(spark: SparkSession, sf: str) -> DataFrame:
    return contracts(spark, sf).groupBy("vendor_id", "vendor").agg(F.count("*").alias("n"), money("amount").alias("total")).orderBy(F.desc("total"), "vendor").limit(20).select("vendor", "n", "total")


@query("with {contracts}, raw as (select vendor, sum(amount) as t from contracts group by vendor order by t desc, vendor limit 50) select right(vendor, 2) as name, cast(sum(t) as double) as total from raw group by 1 order by total desc, name limit 10")
def two_stage_top(spark: SparkSession, sf: str) -> DataFrame:
    raw = contracts(spark, sf).groupBy("vendor").agg(F.sum("amount").alias("t")).orderBy(F.desc("t"), "vendor").limit(50)
    return raw.groupBy(F.expr("right(vendor, 2)").alias("name")).agg(money("t").alias("total")).orderBy(F.desc("total"), "name").limit(10)


@query("with {contracts} select right(vendor, 2) as name, cast(sum(amount) as double) as total from contracts group by 1 order by total desc, name limit 10")
def exact_regrouped_top(spark: SparkSession, sf: str) -> DataFrame:
    return contracts(spark, sf).groupBy(F.expr("right(vendor, 2)").alias("name")).agg(money("amount").alias("total")).orderBy(F.desc("total"), "name").limit(10)


@query("with {contracts} select case when amount >= 400000 then 'large' when amount >= 100000 then 'medium' when amount > 0 then 'small' else 'none' end as size, count(*) as n from contracts group by 1")
def case_group(spark: SparkSession, sf: str) -> DataFrame:
    a = F.col("amount")
    return contracts(spark, sf).groupBy(F.when(a >= 400_000, "large").when(a >= 100_000, "medium").when(a > 0, "small").otherwise("none").alias("size")).agg(F.count("*").alias("n"))


@query("with {contracts} select count(*) as n, cast(coalesce(sum(amount), 0) as double) as total, count(distinct vendor_id) as vendors, cast(min(amount) as double) as low, cast(max(amount) as double) as high, round(cast(sum(amount) as double) / count(*), 4) as mean from contracts")
def kpi_totals(spark: SparkSession, sf: str) -> DataFrame:
    return contracts(spark, sf).agg(F.count("*").alias("n"), F.coalesce(money("amount"), F.lit(0.0)).alias("total"), F.count_distinct("vendor_id").alias("vendors"), F.min("amount").cast("double").alias("low"), F.max("amount").cast("double").alias("high"), F.round(money("amount") / F.count("*"), 4).alias("mean"))


@query("with {contracts} select agency, count(case when status = 'F' then 1 end) as done, cast(coalesce(sum(case when status = 'O' then amount end), 0) as double) as open_total, max(case when status = 'P' then contract_date end) as last_pending from contracts group by agency")
def conditional_counts(spark: SparkSession, sf: str) -> DataFrame:
    s, a = F.col("status"), F.col("amount")
    return contracts(spark, sf).groupBy("agency").agg(F.count_if(s == "F").alias("done"), F.coalesce(money(F.when(s == "O", a)), F.lit(0.0)).alias("open_total"), F.max(F.when(s == "P", F.col("contract_date"))).alias("last_pending"))


BEST_SQL = """e as (select l_orderkey as id, l_partkey as equipment_id, cast(1 - l_discount as decimal(4,2)) as confidence, l_returnflag as match_source from lineitem),
best as (select id, equipment_id, confidence from (select *, row_number() over (partition by id order by confidence desc, equipment_id) as k from e) where k = 1)"""


def _best(spark: SparkSession, sf: str) -> DataFrame:
    top = F.min_by(F.struct("equipment_id", "confidence"), F.struct(-F.col("confidence"), "equipment_id"))
    return equipment_links(spark, sf).groupBy("id").agg(top.alias("b")).select("id", "b.*")


@query("with {contracts}, " + BEST_SQL + " select c.id, c.agency, p_name as equipment, cast(confidence as double) as confidence from contracts c left join best on best.id = c.id left join part on p_partkey = equipment_id")
def best_match_per_key(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("equipment_id"), F.col("p_name").alias("equipment"))
    return contracts(spark, sf).select("id", "agency").join(_best(spark, sf), "id", "left").join(part, "equipment_id", "left").select("id", "agency", "equipment", F.col("confidence").cast("double"))


@query("select id, match_source, cast(confidence as double) as confidence from (select l_orderkey as id, l_returnflag as match_source, cast(1 - l_discount as decimal(4,2)) as confidence, row_number() over (partition by l_orderkey order by cast(1 - l_discount as decimal(4,2)) desc, l_returnflag, l_linenumber) as k from lineitem) where k = 1")
def best_row_number(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("id").orderBy(F.desc("confidence"), "match_source")
    return equipment_links(spark, sf).withColumn("k", F.row_number().over(w)).where("k = 1").select("id", "match_source", F.col("confidence").cast("double"))


@query("select l_orderkey as id, string_agg(distinct l_returnflag, ',' order by l_returnflag) as sources from lineitem group by 1")
def concat_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return equipment_links(spark, sf).groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("match_source")), ",").alias("sources"))


@query("with {contracts}, g as (select nullif(priority, '5-LOW') as priority, count(*) as n from contracts group by 1) select priority, n, round(cast(n as double) / sum(n) over (), 6) as share from g")
def group_null_share(spark: SparkSession, sf: str) -> DataFrame:
    grouped = contracts(spark, sf).groupBy(F.nullif("priority", F.lit("5-LOW")).alias("priority")).agg(F.count("*").alias("n"))
    return windows.share_of(grouped, [], "n", "share")


@query("with {contracts}, g as (select bid_method, fiscal_year, count(*) as n from contracts group by 1, 2), m as (select distinct bid_method from g), y as (select distinct fiscal_year from g) select m.bid_method, y.fiscal_year, coalesce(g.n, 0) as n from m cross join y left join g on g.bid_method is not distinct from m.bid_method and g.fiscal_year is not distinct from y.fiscal_year")
def method_pivot_all(spark: SparkSession, sf: str) -> DataFrame:
    """A row for each method and year that the contracts hold."""
    g = contracts(spark, sf).groupBy("bid_method", "fiscal_year").agg(F.count("*").alias("n"))
    grid = g.select("bid_method").distinct().crossJoin(g.select("fiscal_year").distinct()).alias("k")  # methods x years: the grid itself
    g = g.alias("g")
    same = F.col("k.bid_method").eqNullSafe(F.col("g.bid_method")) & F.col("k.fiscal_year").eqNullSafe(F.col("g.fiscal_year"))
    return grid.join(g, same, "left").select("k.bid_method", "k.fiscal_year", F.coalesce("g.n", F.lit(0)).alias("n"))


BUDGET = [(y, 5.0e8 + 1.0e7 * (y - 1995)) for y in range(1994, 2003)]


@query("with {contracts}, budget(fiscal_year, base) as (values " + ", ".join(f"({y}, {b})" for y, b in BUDGET) + "), t as (select fiscal_year, sum(amount) as t from contracts group by 1) select b.fiscal_year, cast(coalesce(t, 0) as double) as total, round(cast(coalesce(t, 0) as double) / base, 6) as coverage, round(greatest(0.0, cast(base - cast(coalesce(t, 0) as double) as double)), 2) as missing from budget b left join t on t.fiscal_year = b.fiscal_year")
def coverage_vs_budget(spark: SparkSession, sf: str) -> DataFrame:
    budget = spark.createDataFrame(BUDGET, "fiscal_year int, base double")
    totals = contracts(spark, sf).groupBy("fiscal_year").agg(money("amount").alias("total"))
    total = F.coalesce("total", F.lit(0.0))
    return budget.join(totals, "fiscal_year", "left").select("fiscal_year", total.alias("total"), F.round(total / F.col("base"), 6).alias("coverage"), F.round(F.greatest(F.lit(0.0), F.col("base") - total), 2).alias("missing"))


@query("with {contracts}, p as (select agency, avg(cast(amount as double)) as m from contracts group by 1) select vendor, count(distinct c.agency) as agencies, count(*) as n, cast(sum(amount) as double) as total from contracts c join p on p.agency = c.agency where m > 0 and amount <= 1.5 * m group by vendor order by total desc, vendor limit 20")
def payee_multi_agg(spark: SparkSession, sf: str) -> DataFrame:
    c = contracts(spark, sf)
    mean = c.groupBy("agency").agg(F.avg(F.col("amount").cast("double")).alias("m"))
    kept = c.join(mean, "agency").where((F.col("m") > 0) & (F.col("amount") <= 1.5 * F.col("m")))
    return kept.groupBy("vendor").agg(F.count_distinct("agency").alias("agencies"), F.count("*").alias("n"), money("amount").alias("total")).orderBy(F.desc("total"), "vendor").limit(20)


@query("with {contracts} select agency, fiscal_year, try_cast(substr(contract_date, 5, 2) as integer) as month, count(*) as n from contracts group by 1, 2, 3")
def url_month_counts(spark: SparkSession, sf: str) -> DataFrame:
    return contracts(spark, sf).groupBy("agency", "fiscal_year", dates.month_of_text(F.col("contract_date")).alias("month")).agg(F.count("*").alias("n"))


@query("with {contracts}, s as (select agency, fiscal_year, min(contract_date) as first, max(contract_date) as last from contracts group by 1, 2) select agency, fiscal_year, first, last, cast(date_diff('day', cast(strptime(first, '%Y%m%d') as date), cast(strptime(last, '%Y%m%d') as date)) as integer) as days from s")
def date_span(spark: SparkSession, sf: str) -> DataFrame:
    s = contracts(spark, sf).groupBy("agency", "fiscal_year").agg(F.min("contract_date").alias("first"), F.max("contract_date").alias("last"))
    return s.withColumn("days", F.datediff(F.to_date("last", "yyyyMMdd"), F.to_date("first", "yyyyMMdd")))


@query("with {contracts}, v as (select agency, bid_method, count(*) as votes, min(id) as first from contracts group by 1, 2) select agency, bid_method, votes from (select *, row_number() over (partition by agency order by votes desc, first) as k from v) where k = 1")
def majority_vote(spark: SparkSession, sf: str) -> DataFrame:
    return votes.majority(contracts(spark, sf), "agency", "bid_method", "id")


@query("with {contracts} select vendor_id, min(status) as status from contracts group by 1 having count(distinct status) = 1")
def unanimity(spark: SparkSession, sf: str) -> DataFrame:
    return votes.unanimous(contracts(spark, sf), "vendor_id", "status")


@query("with {contracts}, v as (select vendor_id, status, count(*) as votes from contracts group by 1, 2), r as (select *, row_number() over (partition by vendor_id order by votes desc, status) as k, lead(votes) over (partition by vendor_id order by votes desc, status) as n2 from v) select vendor_id, status, votes from r where k = 1 and coalesce(n2, 0) < votes")
def plurality_vote(spark: SparkSession, sf: str) -> DataFrame:
    return votes.plurality(contracts(spark, sf), "vendor_id", "status")


@query("with {contracts} select vendor_id, id, contract_date from (select *, row_number() over (partition by vendor_id order by contract_date desc, id desc) as k from contracts) where k = 1")
def latest_per_name(spark: SparkSession, sf: str) -> DataFrame:
    return contracts(spark, sf).groupBy("vendor_id").agg(F.max_by(F.struct("id", "contract_date"), F.struct("contract_date", "id")).alias("r")).select("vendor_id", "r.*")


@query("select user_id, event_type, event_id from (select *, row_number() over (partition by user_id order by ts desc, (event_type <> 'error') desc, event_id) as k from events) where k = 1")
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    return merge.first_of(table(spark, sf, "events"), ["user_id"], F.desc("ts"), (F.col("event_type") != "error").desc(), F.col("event_id")).select("user_id", "event_type", "event_id")


@query("select count(*) as rows, count(distinct (user_id, event_type)) as keys, count(*) - count(distinct (user_id, event_type)) as duplicates from events")
def dup_diagnosis(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return e.agg(F.sum("n").alias("rows"), F.count("*").alias("keys"), (F.sum("n") - F.count("*")).alias("duplicates"))


@query("select event_id, cast(row_number() over (partition by user_id, event_type order by event_id) as integer) as dup_ordinal from events")
def dup_ordinal(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("user_id", "event_type").orderBy("event_id")
    return table(spark, sf, "events").select("event_id", F.row_number().over(w).alias("dup_ordinal"))


@query("""with {contracts}, t as (select agency, fiscal_year, cast(sum(case when status = 'P' and agency <> 'NATION_3' then amount end) as double) as total from contracts group by 1, 2),
f as (select agency, fiscal_year, total, last_value(total ignore nulls) over (partition by agency order by fiscal_year rows between unbounded preceding and current row) as p from t)
select agency, fiscal_year, total, round((p / nullif(lag(p) over (partition by agency order by fiscal_year), 0) - 1) * 100, 6) as change from f""")
def yoy_change(spark: SparkSession, sf: str) -> DataFrame:
    t = contracts(spark, sf).groupBy("agency", "fiscal_year").agg(money(F.when((F.col("status") == "P") & (F.col("agency") != "NATION_3"), F.col("amount"))).alias("total"))
    return windows.change_percent(t, ["agency"], "fiscal_year", "total", "change").withColumn("change", F.round("change", 6))


@query("select conv_id, turn, last_value(case when role = 'user' then length(text) end ignore nulls) over (partition by conv_id order by turn, role, text rows between unbounded preceding and current row) as asked from conversations")
def carry_forward(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    asked = F.last(F.when(F.col("role") == "user", F.length("text").cast("long")), ignorenulls=True).over(w)
    return table(spark, sf, "conversations").select("conv_id", "turn", asked.alias("asked"))


@query("select event_id, lag(event_type) over (partition by user_id order by ts, event_id) as before, lead(event_type) over (partition by user_id order by ts, event_id) as after, coalesce(event_type <> lag(event_type) over (partition by user_id order by ts, event_id), true) as breaks from events")
def neighbour(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    before = F.lag("event_type").over(w)
    return table(spark, sf, "events").select("event_id", before.alias("before"), F.lead("event_type").over(w).alias("after"), F.coalesce(F.col("event_type") != before, F.lit(True)).alias("breaks"))


@query("with {contracts}, t as (select category, bid_method, sum(amount) as s from contracts group by 1, 2) select category, bid_method, cast(s as double) as step, cast(sum(s) over (partition by category order by bid_method rows unbounded preceding) as double) as level from t")
def waterfall(spark: SparkSession, sf: str) -> DataFrame:
    t = contracts(spark, sf).groupBy("category", "bid_method").agg(F.sum("amount").alias("s"))
    return windows.running_total(t, ["category"], "bid_method", "s", "level").select("category", "bid_method", F.col("s").cast("double").alias("step"), F.col("level").cast("double").alias("level"))


@query("""with {contracts}, t as (select fiscal_year, vendor, sum(amount) as s from contracts group by 1, 2), r as (select *, row_number() over (partition by fiscal_year order by s desc, vendor) as rank from t)
select k.rank, y.fiscal_year, coalesce(r.vendor, '-') as vendor from (select unnest(range(1, 21)) as rank) k cross join (select distinct fiscal_year from t) y left join r on r.rank = k.rank and r.fiscal_year is not distinct from y.fiscal_year""")
def rank_matrix_all(spark: SparkSession, sf: str) -> DataFrame:
    """A row for each of 20 ranks and each year that the contracts hold."""
    t = contracts(spark, sf).groupBy("fiscal_year", "vendor").agg(F.sum("amount").alias("s"))
    r = t.withColumn("rank", F.row_number().over(Window.partitionBy("fiscal_year").orderBy(F.desc("s"), "vendor"))).where("rank <= 20").alias("r")
    grid = spark.range(1, 21).select(F.col("id").alias("rank")).crossJoin(t.select("fiscal_year").distinct()).alias("k")  # ranks x years: the matrix itself
    same = (F.col("k.rank") == F.col("r.rank")) & F.col("k.fiscal_year").eqNullSafe(F.col("r.fiscal_year"))
    return grid.join(r, same, "left").select("k.rank", "k.fiscal_year", F.coalesce("r.vendor", F.lit("-")).alias("vendor"))


@query("with {contracts}, t as (select agency, sum(case when fiscal_year = 1996 then amount end) as a, sum(case when fiscal_year = 2000 then amount end) as b from contracts group by 1) select agency, round(cast(b as double) / nullif(cast(a as double), 0), 6) as growth from t")
def growth_ratio(spark: SparkSession, sf: str) -> DataFrame:
    of = lambda y: money(F.when(F.col("fiscal_year") == y, F.col("amount")))
    return contracts(spark, sf).groupBy("agency").agg(F.round(F.try_divide(of(2000), of(1996)), 6).alias("growth"))


@query("select l_orderkey as id, l_linenumber as line, round(l_extendedprice * (1 - l_discount) / nullif(l_extendedprice, 0) * 100, 4) as ratio, p_name as equipment from lineitem left join part on p_partkey = l_partkey where l_extendedprice > 0 and l_extendedprice * (1 - l_discount) / l_extendedprice < 0.93")
def low_price_ratio(spark: SparkSession, sf: str) -> DataFrame:
    e, d = F.col("l_extendedprice"), F.col("l_discount")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("equipment"))
    low = table(spark, sf, "lineitem").where((e > 0) & (F.try_divide(e * (1 - d), e) < 0.93))
    return low.join(part, "l_partkey", "left").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.round(F.try_divide(e * (1 - d), e) * 100, 4).alias("ratio"), "equipment")


@query("with {contracts} select id, vendor, cast(amount as double) as amount from contracts where amount > 0 and amount <= 5000")
def small_contracts(spark: SparkSession, sf: str) -> DataFrame:
    return contracts(spark, sf).where((F.col("amount") > 0) & (F.col("amount") <= 5000)).select("id", "vendor", F.col("amount").cast("double"))


@query("with {contracts} select id, agency, cast(amount as double) as amount, row_number() over (order by amount desc nulls last, id) as no from contracts order by amount desc nulls last, id limit 50")
def ranked_contracts(spark: SparkSession, sf: str) -> DataFrame:
    top = contracts(spark, sf).orderBy(F.desc_nulls_last("amount"), "id").limit(50)
    w = Window.orderBy(F.desc_nulls_last("amount"), "id")  # 50 rows
    return top.select("id", "agency", F.col("amount").cast("double"), F.row_number().over(w).cast("long").alias("no"))


@query("with {contracts} select category, fiscal_year, count(*) as n, cast(round(sum(amount) / 1000000, 1) as double) as millions from contracts group by 1, 2")
def category_year_summary(spark: SparkSession, sf: str) -> DataFrame:
    return contracts(spark, sf).groupBy("category", "fiscal_year").agg(F.count("*").alias("n"), F.round(F.sum("amount") / 1_000_000, 1).cast("double").alias("millions"))


@query("with {contracts} select fiscal_year, cast(sum(case when status <> 'P' then amount else 0 end) as double) as classified, cast(sum(amount) as double) as total, round(cast(sum(case when status <> 'P' then amount else 0 end) as double) / cast(sum(amount) as double), 6) as coverage from contracts group by 1")
def classified_coverage(spark: SparkSession, sf: str) -> DataFrame:
    done = money(F.when(F.col("status") != "P", F.col("amount")).otherwise(0))
    return contracts(spark, sf).groupBy("fiscal_year").agg(done.alias("classified"), money("amount").alias("total"), F.round(done / money("amount"), 6).alias("coverage"))


@query("select p_partkey as equipment_id, count(l_orderkey) as hits, cast(coalesce(sum(cast(l_quantity as decimal(18,2))), 0) as double) as total, round(avg(cast(cast(1 - l_discount as decimal(4,2)) as double)), 6) as confidence from part left join lineitem on l_partkey = p_partkey group by 1")
def equipment_hits(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("equipment_id"))
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("equipment_id"), F.col("l_quantity").cast("decimal(18,2)").alias("q"), (1 - F.col("l_discount")).cast("decimal(4,2)").cast("double").alias("c"))
    hits = lines.groupBy("equipment_id").agg(F.count("*").alias("hits"), money("q").alias("total"), F.round(F.avg("c"), 6).alias("confidence"))
    return part.join(hits, "equipment_id", "left").select("equipment_id", F.coalesce("hits", F.lit(0)).alias("hits"), F.coalesce("total", F.lit(0.0)).alias("total"), "confidence")


@query("select event_type, list_sort(list(distinct month(ts) * 100 + day(ts))) as days, min(value) as low from events group by 1")
def set_union_per_key_all(spark: SparkSession, sf: str) -> DataFrame:
    """Every day of each type: 366 at most."""
    day = (F.month("ts") * 100 + F.dayofmonth("ts")).cast("long")
    return table(spark, sf, "events").groupBy("event_type").agg(F.array_sort(F.collect_set(day)).alias("days"), F.min("value").alias("low"))


@query("""with d as (select distinct event_type from events), k as (select distinct cast(ts as date) as day from events), g as (select event_type, cast(ts as date) as day, count(*) as n from events group by 1, 2)
select d.event_type, k.day, coalesce(g.n, 0) as n, case when g.n is null then 'dash' when g.n > 60 then 'filled' else 'pending' end as state from d cross join k left join g on g.event_type = d.event_type and g.day = k.day""")
def dense_grid(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_type", F.col("ts").cast("date").alias("day"))
    counts = e.groupBy("event_type", "day").agg(F.count("*").alias("n"))
    grid = counts.select("event_type").distinct().crossJoin(counts.select("day").distinct())  # kinds x days: the grid itself
    n = F.col("n")
    return grid.join(counts, ["event_type", "day"], "left").select("event_type", "day", F.coalesce(n, F.lit(0)).alias("n"), F.when(n.isNull(), "dash").when(n > 60, "filled").otherwise("pending").alias("state"))


@query("with {contracts}, e as (select agency, fiscal_year, count(*) as n from contracts group by 1, 2), a as (select agency, fiscal_year, count(*) as n from contracts where id % 97 <> 0 group by 1, 2) select e.agency, e.fiscal_year, e.n as n, coalesce(a.n, 0) as actual, coalesce(a.n, 0) - e.n as difference, abs(coalesce(a.n, 0) - e.n) <= e.n * 0.01 as ok from e left join a on a.agency = e.agency and a.fiscal_year = e.fiscal_year")
def reconcile_cells(spark: SparkSession, sf: str) -> DataFrame:
    c = contracts(spark, sf)
    count = lambda d: d.groupBy("agency", "fiscal_year").agg(F.count("*").alias("n"))
    return verify.reconcile(count(c), count(c.where("id % 97 <> 0")), ["agency", "fiscal_year"], "n", verify.TOLERANCE["rows"])


@query("with {contracts} select count(*) as rows, count(*) - count(distinct (vendor_id, contract_date)) as duplicates, sum(case when vendor is null then 1 else 0 end)::bigint as null_vendor, sum(case when amount is null then 1 else 0 end)::bigint as null_amount from contracts")
def quality_counters(spark: SparkSession, sf: str) -> DataFrame:
    return verify.quality_counts(contracts(spark, sf), ["vendor_id", "contract_date"], ["vendor", "amount"])


@query("with a as (select user_id, event_type, value, event_id, nullif(event_id % 5, 0) as k from events where event_id % 2 = 0), b as (select user_id, event_type, value, event_id, nullif(event_id % 5, 0) as k from events where event_id % 2 = 1), n as (select *, row_number() over (partition by user_id, event_type, k order by event_id) as r from b) select event_id, user_id, event_type, k from n where k is null or (r = 1 and not exists (select 1 from a where a.user_id = n.user_id and a.event_type = n.event_type and a.k = n.k))")
def insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.nullif(F.col("event_id") % 5, F.lit(0)).alias("k"))
    return merge.insert_if_absent(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), ["user_id", "event_type", "k"], "event_id")


@query("with a as (select user_id, event_id, event_type from events where ts < timestamp '2024-01-16' qualify row_number() over (partition by user_id order by event_id) = 1), b as (select user_id, event_id, event_type from events where ts >= timestamp '2024-01-16' qualify row_number() over (partition by user_id order by event_id desc) = 1) select * from b union all select * from a where user_id not in (select user_id from b)")
def upsert_last_all(spark: SparkSession, sf: str) -> DataFrame:
    """Every event is on one side: those before HALF are the table, those from then on the new rows."""
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    old = merge.first_of(e.where(F.col("ts") < HALF), ["user_id"], F.col("event_id")).drop("ts")
    return merge.upsert(old, e.where(F.col("ts") >= HALF), ["user_id"], "event_id")


@query("with {contracts}, c as (select id, fiscal_year, status from contracts), n as (select id + 1000000 as id, fiscal_year, 'N' as status from contracts where fiscal_year = 1998) select * from c where fiscal_year <> 1998 union all select * from n")
def replace_year(spark: SparkSession, sf: str) -> DataFrame:
    c = contracts(spark, sf).select("id", "fiscal_year", "status")
    new = c.where("fiscal_year = 1998").select((F.col("id") + 1_000_000).alias("id"), "fiscal_year", F.lit("N").alias("status"))
    return merge.replace_partition(c, new, "fiscal_year")


@query("with {contracts} select id, case when status = 'P' and id % 7 = 0 then 'F' else status end as status from contracts")
def guarded_patch(spark: SparkSession, sf: str) -> DataFrame:
    c = contracts(spark, sf).select("id", "status")
    changes = c.where("id % 7 = 0").select("id", F.lit("F").alias("status"))
    return merge.patch(c, changes, "id", ["status"], F.col("status") == "P")


@query("select l_orderkey, l_linenumber from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F')")
def without_orphans(spark: SparkSession, sf: str) -> DataFrame:
    parent = table(spark, sf, "orders").where("o_orderstatus = 'F'")
    return merge.without_orphans(table(spark, sf, "lineitem"), parent, "l_orderkey", "o_orderkey").select("l_orderkey", "l_linenumber")


@query("with {contracts}, s as (select vendor_id, sum(amount) as t from contracts group by 1) select id, case when amount > 0.6 * t then null else cast(amount as double) end as amount from contracts join s using (vendor_id)")
def null_above_share(spark: SparkSession, sf: str) -> DataFrame:
    c = contracts(spark, sf).select("id", "vendor_id", F.col("amount").cast("double").alias("amount"), F.col("amount").alias("exact"))
    totals = c.groupBy("vendor_id").agg(F.sum("exact").alias("t"))
    return merge.null_above_share(c, totals, "vendor_id", "exact", "t").select("id", F.col("exact").cast("double").alias("amount"))


@query("with {contracts} select fiscal_year, agency, count(distinct l_orderkey) as linked from contracts join lineitem on l_orderkey = id where l_discount >= 0.09 group by 1, 2")
def fan_out_join(spark: SparkSession, sf: str) -> DataFrame:
    hit = table(spark, sf, "lineitem").where("l_discount >= 0.09").select(F.col("l_orderkey").alias("id"))
    return contracts(spark, sf).join(hit, "id").groupBy("fiscal_year", "agency").agg(F.count_distinct("id").alias("linked"))


@query("with {contracts} select agency, count(*) as n from contracts c where not exists (select 1 from lineitem where l_orderkey = c.id and l_returnflag = 'R') group by 1")
def anti_join(spark: SparkSession, sf: str) -> DataFrame:
    returned = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    return contracts(spark, sf).join(returned, "id", "left_anti").groupBy("agency").agg(F.count("*").alias("n"))


@query("with a as (select event_id, nullif(user_id % 10, 0) as u, event_type from events where ts < timestamp '2024-01-16'), b as (select nullif(user_id % 10, 0) as u, event_type, count(*) as n from events where ts >= timestamp '2024-01-16' group by 1, 2) select event_id, n from a join b on a.u is not distinct from b.u and a.event_type = b.event_type")
def null_safe_join_all(spark: SparkSession, sf: str) -> DataFrame:
    """Every event is on one side of HALF; the later side is counted by key first, so no pairs are made."""
    e = table(spark, sf, "events").select("event_id", F.nullif(F.col("user_id") % 10, F.lit(0)).alias("u"), "event_type", "ts")
    a = e.where(F.col("ts") < HALF).alias("a")
    b = e.where(F.col("ts") >= HALF).groupBy("u", "event_type").agg(F.count("*").alias("n")).alias("b")
    return a.join(b, F.col("a.u").eqNullSafe(F.col("b.u")) & (F.col("a.event_type") == F.col("b.event_type"))).select("a.event_id", "b.n")


@query("with {contracts}, t as (select fiscal_year, month, count(*) as n from (select fiscal_year, try_cast(substr(contract_date, 5, 2) as integer) as month from contracts) group by 1, 2) select fiscal_year, month, n, row_number() over (partition by fiscal_year order by (month + 8) % 12) as place from t")
def fiscal_month_order(spark: SparkSession, sf: str) -> DataFrame:
    t = contracts(spark, sf).groupBy("fiscal_year", dates.month_of_text(F.col("contract_date")).alias("month")).agg(F.count("*").alias("n"))
    return t.withColumn("place", F.row_number().over(Window.partitionBy("fiscal_year").orderBy(dates.fiscal_order(F.col("month")))).cast("long"))


@query("with {contracts} select vendor_id, status from contracts where fiscal_year is not null qualify row_number() over (partition by vendor_id order by fiscal_year, status) = 1")
def first_wins_union(spark: SparkSession, sf: str) -> DataFrame:
    """Every year's vendors with their status; of a vendor in several years the first year's row wins."""
    yearly = contracts(spark, sf).where("fiscal_year is not null").groupBy("fiscal_year", "vendor_id").agg(F.min("status").alias("status"))
    return merge.first_of(yearly, ["vendor_id"], F.col("fiscal_year"), F.col("status")).select("vendor_id", "status")


#: Both names of a query stand for the one that reads its whole table.
for _name in ("method_pivot", "rank_matrix", "set_union_per_key", "upsert_last", "null_safe_join"):
    QUERIES[_name], SQL[_name] = QUERIES[f"{_name}_all"], SQL[f"{_name}_all"]
