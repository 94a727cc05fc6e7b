"""Ordered rows: carried values, changes, shares, running totals and matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def carried(df: DataFrame, keys: list[str], order: str, value: Column, out: str) -> DataFrame:
    """The last value that is not NULL, up to this row."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))


def change_percent(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """Change against the row before, in percent; NULLs first take the value before them."""
    w = Window.partitionBy(*keys).orderBy(order)
    padded = df.withColumn("_p", F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return padded.withColumn(out, (F.try_divide(F.col("_p"), F.lag("_p").over(w)) - 1) * 100).drop("_p")


def share_of(df: DataFrame, keys: list[str], value: str, out: str, digits: int = 6) -> DataFrame:
    """Share of the keys' total: a grouped sum joined back, so no window holds a large group."""
    if not keys:
        return df.crossJoin(df.agg(F.sum(value).alias("_t"))).withColumn(out, F.round(F.try_divide(F.col(value), F.col("_t")), digits)).drop("_t")  # one row
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_t"))
    return df.join(totals, keys).withColumn(out, F.round(F.try_divide(F.col(value), F.col("_t")), digits)).drop("_t")


def running_total(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(w))


def midpoint_bands(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    """lo and hi half-way to the neighbours: the band that each anchor owns."""
    w = Window.partitionBy(*keys).orderBy(at)
    return df.withColumns({"lo": F.coalesce((F.col(at) + F.lag(at).over(w)) / 2, F.lit(float("-inf"))), "hi": F.coalesce((F.col(at) + F.lead(at).over(w)) / 2, F.lit(float("inf")))})


def rank_matrix(df: DataFrame, group: str, rank: str, cell: str, ranks: int, groups: list, default: str = "-") -> DataFrame:
    """rank x group, with a default for cells that have no row."""
    rows = df.sparkSession.range(1, ranks + 1).select(F.col("id").alias(rank))
    wide = df.groupBy(rank).pivot(group, groups).agg(F.first(cell))
    return rows.join(wide, rank, "left").na.fill(default, [str(g) for g in groups])


#: Consecutive orders that one window of the functions below holds at most.
RUN = 1024


def carried_far(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """The last value that is not NULL, up to this row, where a key may hold any number of rows: within runs of consecutive
    orders (an integer column), then from run to run, so a window holds a run's rows or one row a run."""
    df = df.withColumn("_run", F.floor(F.col(order) / RUN))
    inner = Window.partitionBy(*keys, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    ends = df.groupBy(*keys, "_run").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_end"))
    ends = ends.select(*keys, "_run", F.last("_end", ignorenulls=True).over(outer).alias("_before"))
    found = df.withColumn(out, F.last(value, ignorenulls=True).over(inner)).join(ends, [*keys, "_run"])
    return found.withColumn(out, F.coalesce(out, "_before")).drop("_run", "_before")


def summed_far(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """The sum of a column over the rows before this one, in the same two steps."""
    df = df.withColumn("_run", F.floor(F.col(order) / RUN))
    inner = Window.partitionBy(*keys, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = df.groupBy(*keys, "_run").agg(F.sum(value).alias("_sum")).select(*keys, "_run", F.coalesce(F.sum("_sum").over(outer), F.lit(0)).alias("_before"))
    found = df.withColumn(out, F.coalesce(F.sum(value).over(inner), F.lit(0))).join(runs, [*keys, "_run"])
    return found.withColumn(out, F.col(out) + F.col("_before")).drop("_run", "_before")
