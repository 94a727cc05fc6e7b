"""Votes within keys: majority, unanimity and plurality, from grouped counts, so a hot key is pre-aggregated."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def majority(df: DataFrame, key: str, value: str, seq: str) -> DataFrame:
    """The most frequent value of each key; of equals, the one seen first."""
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("votes"), F.min(seq).alias("first"))
    best = counts.groupBy(key).agg(F.min_by(F.struct(value, "votes"), F.struct(-F.col("votes"), "first")).alias("b"))
    return best.select(key, f"b.{value}", "b.votes")


def unanimous(df: DataFrame, key: str, value: str) -> DataFrame:
    """The value of each key that has only one."""
    found = df.groupBy(key).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    return found.where(F.col("_low") == F.col("_high")).select(key, F.col("_low").alias(value))


def plurality(df: DataFrame, key: str, value: str, weight: str | None = None) -> DataFrame:
    """The most frequent value of each key, unless another has as many; a row counts once, or as often as its weight says."""
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg((F.sum(weight) if weight else F.count("*")).alias("votes"))
    w = Window.partitionBy(key).orderBy(F.desc("votes"), value)
    ranked = counts.withColumns({"_rank": F.row_number().over(w), "_next": F.lead("votes").over(w)})
    return ranked.where((F.col("_rank") == 1) & (F.coalesce("_next", F.lit(0)) < F.col("votes"))).select(key, value, "votes")
