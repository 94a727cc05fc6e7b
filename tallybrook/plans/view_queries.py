"""Queries behind views: search, drill-down, bands, orders, samples, spans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.operators import linkage, merge, windows
from tallybrook.plans import search
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


SPEC = search.SearchSpec("customer#0000000_1", [1996, 1997, 1998], ["ASIA", "EUROPE"], [], 100)
SPEC_WHERE = "fiscal_year in (1996, 1997, 1998) and category in ('ASIA', 'EUROPE') and vendor ilike '%customer#0000000_1%'"


@query("with {contracts} select id, vendor, cast(amount as double) as amount from contracts where " + SPEC_WHERE + " order by amount desc nulls last, id limit 100")
def search_rows(spark: SparkSession, sf: str) -> DataFrame:
    return search.search(contracts(spark, sf), SPEC)[0].select("id", "vendor", F.col("amount").cast("double"))


@query("with {contracts} select count(*) as total from contracts where " + SPEC_WHERE)
def search_total(spark: SparkSession, sf: str) -> DataFrame:
    return search.search(contracts(spark, sf), SPEC)[1]


@query("with {contracts} select id, contract_date from contracts where category = 'ASIA' and agency = 'NATION_2' and bid_method = 'BUILDING'")
def drill_down(spark: SparkSession, sf: str) -> DataFrame:
    return search.drill(contracts(spark, sf), {"category": "ASIA", "agency": "NATION_2", "bid_method": "BUILDING"}).select("id", "contract_date")


@query("with {contracts} select distinct bid_method from contracts where bid_method is not null order by bid_method")
def facet_values(spark: SparkSession, sf: str) -> DataFrame:
    return search.facet_values(contracts(spark, sf), "bid_method")


@query("select case when r < 92 then 'red' when r < 96 then 'yellow' else 'none' end as band, count(*) as n from (select l_extendedprice * (1 - l_discount) / nullif(l_extendedprice, 0) * 100 as r from lineitem) group by 1")
def ratio_bands(spark: SparkSession, sf: str) -> DataFrame:
    r = F.try_divide(F.col("l_extendedprice") * (1 - F.col("l_discount")), F.col("l_extendedprice")) * 100
    return table(spark, sf, "lineitem").groupBy(F.when(r < 92, "red").when(r < 96, "yellow").otherwise("none").alias("band")).agg(F.count("*").alias("n"))


@query("with {contracts}, t as (select priority, count(*) as n from contracts group by 1) select priority, n, row_number() over (order by case priority when '5-LOW' then 1 when '1-URGENT' then 2 else 99 end, priority) as place from t")
def custom_order(spark: SparkSession, sf: str) -> DataFrame:
    t = contracts(spark, sf).groupBy("priority").agg(F.count("*").alias("n"))
    order = F.coalesce(F.try_element_at(F.create_map(F.lit("5-LOW"), F.lit(1), F.lit("1-URGENT"), F.lit(2)), F.col("priority")), F.lit(99))
    return t.withColumn("place", F.row_number().over(Window.orderBy(order, "priority")).cast("long"))  # a handful of values


@query("with {contracts} select category, id from contracts qualify row_number() over (partition by category order by id) <= 5")
def sample_per_category(spark: SparkSession, sf: str) -> DataFrame:
    """The first five of each category: a limit that is the feature. Spark keeps five of a task before it shuffles."""
    w = Window.partitionBy("category").orderBy("id")
    return contracts(spark, sf).withColumn("k", F.row_number().over(w)).where("k <= 5").select("category", "id")


@query("with {contracts} select id, case when length(vendor) > 12 then substr(vendor, 1, 12) || '…' else vendor end as short, '/x?id=' || id as link, substr(contract_date, 1, 4) || '/' || substr(contract_date, 5, 2) || '/' || substr(contract_date, 7, 2) as shown from contracts")
def display_columns_all(spark: SparkSession, sf: str) -> DataFrame:
    """Every contract."""
    from tallybrook.functions import dates, text

    return contracts(spark, sf).select("id", text.truncated(F.col("vendor"), 12).alias("short"), F.concat(F.lit("/x?id="), F.col("id")).alias("link"), dates.display(F.col("contract_date")).alias("shown"))


@query("select l_orderkey as id, count(distinct l_partkey) as parts from lineitem group by 1 having count(distinct l_partkey) <> count(*)")
def duplicate_links(spark: SparkSession, sf: str) -> DataFrame:
    grouped = equipment_links(spark, sf).groupBy("id").agg(F.count_distinct("equipment_id").alias("parts"), F.count("*").alias("n"))
    return grouped.where("parts <> n").select("id", "parts")


@query("with e as (select event_id, ts, cast(date_trunc('hour', ts) as timestamp) as hour, event_type, value from events) select event_type, hour(hour) as hour, count(*) as n from e group by 1, 2")
def hourly_windows(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy("event_type", F.hour(F.window("ts", "1 hour")["start"]).cast("long").alias("hour")).agg(F.count("*").alias("n"))


@query("with s as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) <= interval 30 minute then 0 else 1 end as begins from events) select user_id, cast(sum(begins) as bigint) as sessions from s group by 1")
def user_sessions(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    return e.groupBy("user_id", F.session_window("ts", "1800 seconds 1 microsecond")).agg(F.count("*").alias("n")).groupBy("user_id").agg(F.count("*").alias("sessions"))


@query("with {contracts}, k as (select agency, contract_date, id, row_number() over (partition by agency, contract_date order by id) as dup_ordinal from contracts) select a.id, b.id as other from k a join k b on a.agency = b.agency and a.contract_date = b.contract_date and a.dup_ordinal = 1 and b.dup_ordinal = 2")
def positional_join(spark: SparkSession, sf: str) -> DataFrame:
    k = linkage.with_ordinals(contracts(spark, sf).select("agency", "contract_date", "id"), ["agency", "contract_date"], "id")
    second = k.where("dup_ordinal = 2").select("agency", "contract_date", F.col("id").alias("other"))
    return k.where("dup_ordinal = 1").join(second, ["agency", "contract_date"]).select("id", "other")


@query("with a as (select event_type, count(*) as n from events group by 1), b as (select case when event_type = 'click' then 'view' else event_type end as event_type, count(*) as m from events group by 1) select coalesce(a.event_type, b.event_type) as event_type, coalesce(n, 0) as n, coalesce(m, 0) as m from a full join b on a.event_type = b.event_type")
def before_after(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    a = e.groupBy("event_type").agg(F.count("*").alias("n"))
    b = e.groupBy(F.when(F.col("event_type") == "click", "view").otherwise(F.col("event_type")).alias("event_type")).agg(F.count("*").alias("m"))
    return a.join(b, "event_type", "full").select("event_type", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("m", F.lit(0)).alias("m"))


@query("with d as (select event_type, cast(ts as date) as day, count(*) as n from events group by 1, 2), c as (select event_type, day + 366 as day, 0 as n from d where day = date '2024-01-05') select * from d union all select * from c")
def cloned_grid(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "events").groupBy("event_type", F.to_date(F.col("ts").cast("timestamp")).alias("day")).agg(F.count("*").alias("n"))
    text = d.withColumn("day", F.col("day").cast("string"))
    return merge.cloned_grid(text, "day", "2024-01-05", ["2025-01-05"], {"n": 0}).withColumn("day", F.to_date("day"))


@query("with {contracts}, m as (select vendor_id, min(amount) as lo, max(amount) as hi from contracts group by 1) select vendor_id, cast(hi - lo as double) as spread, case when hi > 2 * lo then 'wide' else 'narrow' end as kind from m")
def vendor_spread(spark: SparkSession, sf: str) -> DataFrame:
    m = contracts(spark, sf).groupBy("vendor_id").agg(F.min("amount").alias("lo"), F.max("amount").alias("hi"))
    return m.select("vendor_id", (F.col("hi") - F.col("lo")).cast("double").alias("spread"), F.when(F.col("hi") > 2 * F.col("lo"), "wide").otherwise("narrow").alias("kind"))


@query("select conv_id, turn, cast(count(*) over (partition by conv_id order by turn, role rows unbounded preceding) as bigint) as level from (select distinct conv_id, turn, role from conversations)")
def running_turns(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "conversations").select("conv_id", "turn", "role").distinct().withColumns({"one": F.lit(1), "at": F.struct("turn", "role")})
    return windows.running_total(t, ["conv_id"], "at", "one", "level").select("conv_id", "turn", "level")


#: Both names of a query stand for the one that reads its whole table.
for _name in ("display_columns",):
    QUERIES[_name], SQL[_name] = QUERIES[f"{_name}_all"], SQL[f"{_name}_all"]
