"""Ledger views over the star schema: one row per contract, with its hierarchy and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions import dates


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, fiscal_year, contract_date (text), amount, vendor, agency, category, bid_method, status, priority.

    Dimensions are joined without hints: Catalyst broadcasts those under its threshold and shuffles larger ones.
    """
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    day = F.col("o_orderdate").cast("date")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("o_orderkey").alias("id"), dates.fiscal_year(day).alias("fiscal_year"), F.date_format(day, "yyyyMMdd").alias("contract_date"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
            F.col("c_custkey").alias("vendor_id"), F.col("c_name").alias("vendor"), F.col("n_name").alias("agency"), F.col("r_name").alias("category"), F.col("c_mktsegment").alias("bid_method"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        )
    )


#: The same view for the SQL side.
CONTRACTS_SQL = """contracts as (select o_orderkey as id, year(o_orderdate - interval 3 month) as fiscal_year, strftime(o_orderdate, '%Y%m%d') as contract_date,
 cast(o_totalprice as decimal(18,2)) as amount, c_custkey as vendor_id, c_name as vendor, n_name as agency, r_name as category, c_mktsegment as bid_method, o_orderstatus as status, o_orderpriority as priority
 from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""


def equipment_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract x equipment with a confidence: N to M."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("equipment_id"), (F.lit(1) - F.col("l_discount")).cast("decimal(4,2)").alias("confidence"), F.col("l_returnflag").alias("match_source"))
