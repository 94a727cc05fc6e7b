"""Reconciliation of a rebuilt ledger with what was expected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tolerated shares of rows, of amounts, and of enrichment rows (only a shortfall counts).
TOLERANCE = {"rows": 0.01, "amount": 0.005, "enrichment": 0.02}


def reconcile(expected: DataFrame, actual: DataFrame, keys: list[str], value: str, tolerance: float, one_sided: bool = False) -> DataFrame:
    """Every expected cell with what is there (nothing counts as 0), the difference, and whether it is within tolerance."""
    found = expected.join(actual.select(*keys, F.col(value).alias("actual")), keys, "left").withColumn("actual", F.coalesce("actual", F.lit(0)))
    gap = F.col("actual") - F.col(value)
    within = (gap >= -F.col(value) * tolerance) if one_sided else (F.abs(gap) <= F.abs(F.col(value)) * tolerance)
    return found.withColumns({"difference": gap, "ok": within})


def largest_gaps(cells: DataFrame, keys: list[str], most: int = 20) -> DataFrame:
    return cells.where("difference <> 0").orderBy(F.abs("difference").desc(), *keys).limit(most)


def missing(expected: DataFrame, actual: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Expected cells that have less than they should: what a replay must fetch again."""
    return reconcile(expected, actual, keys, value, 0.0).where("difference < 0")


def verdict(checks: list[tuple[str, bool, str]]) -> str:
    """FAIL if a check of level 'fail' is broken, WARN if one of level 'warn' is, else PASS."""
    broken = {level for _, ok, level in checks if not ok}
    return "FAIL" if "fail" in broken else "WARN" if "warn" in broken else "PASS"


def quality_counts(df: DataFrame, key: list[str], required: list[str]) -> DataFrame:
    """Rows, NULLs of each required column, and rows beyond the first of each key, in one pass and one grouping."""
    grouped = df.groupBy(*key).agg(F.count("*").alias("_n"), *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required))
    return grouped.agg(F.sum("_n").alias("rows"), F.sum(F.col("_n") - 1).alias("duplicates"), *(F.sum(f"null_{c}").alias(f"null_{c}") for c in required))
