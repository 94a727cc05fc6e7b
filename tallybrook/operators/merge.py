"""Merges into keyed tables, as DataFrames in and out: writing is the caller's last step."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.operators.versions import Versions


def _all_set(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def first_of(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row of each key, the first by a total order; NULL keys group together."""
    return df.withColumn("_row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_row = 1").drop("_row")


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: list[str], seq: str, null_policy: str = "distinct") -> DataFrame:
    """Rows of `new` that a unique key lets in; the first by `seq` wins.

    null_policy 'distinct': a row with a NULL in its key equals no other and always enters. 'same': NULLs are equal.
    """
    if null_policy == "same":
        fresh = first_of(new, keys, F.col(seq))
        old = existing.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
        return fresh.join(old, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "left_anti")
    keyed = first_of(new.where(_all_set(keys)), keys, F.col(seq)).join(existing.select(keys), keys, "left_anti")
    return keyed.unionByName(new.where(~_all_set(keys)))


def insert_counts(existing: DataFrame, new: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """inserted, duplicate."""
    entered = insert_if_absent(existing, new, keys, seq).agg(F.count("*").alias("inserted"))
    return entered.crossJoin(new.agg(F.count("*").alias("total"))).select("inserted", (F.col("total") - F.col("inserted")).alias("duplicate"))  # one row each


def upsert(existing: DataFrame, new: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The table after the last row of each key by `seq` has replaced what was there."""
    last = first_of(new, keys, F.col(seq).desc())
    return existing.join(last.select(keys), keys, "left_anti").unionByName(last.select(existing.columns))


def replace_partition(existing: DataFrame, new: DataFrame, column: str) -> DataFrame:
    """The table with the values of `column` that `new` holds rebuilt from it."""
    return existing.join(new.select(column).distinct(), column, "left_anti").unionByName(new.select(existing.columns))


def gap_fill(existing: DataFrame, candidates: DataFrame, keys: list[str]) -> DataFrame:
    return existing.unionByName(candidates.join(existing.select(keys), keys, "left_anti").select(existing.columns))


def patch(df: DataFrame, changes: DataFrame, key: str, columns: list[str], guard: Column | None = None) -> DataFrame:
    """df with `columns` taken from `changes` (unique by key) where a change exists and the guard holds."""
    named = changes.select(key, F.lit(True).alias("_hit"), *(F.col(c).alias(f"_new_{c}") for c in columns))
    apply = F.coalesce("_hit", F.lit(False)) & (F.coalesce(guard, F.lit(False)) if guard is not None else F.lit(True))
    out = df.join(named, key, "left").withColumn("_apply", apply)
    return out.select(*((F.when(F.col("_apply"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)) for c in df.columns))


def null_above_share(df: DataFrame, totals: DataFrame, key: str, column: str, total: str, share: float = 0.6) -> DataFrame:
    """NULL where a value is over a share of its group's total; an unknown total changes nothing."""
    joined = df.join(totals.select(key, F.col(total).alias("_total")), key, "left")
    return joined.withColumn(column, F.when(F.coalesce(F.col(column) > F.col("_total") * share, F.lit(False)), None).otherwise(F.col(column))).select(df.columns)


def without_orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    return child.join(parent.select(F.col(parent_key).alias(key)), key, "left_semi")


def replace_unprotected(existing: DataFrame, new: DataFrame, keys: list[str], protected: Column, seq: str) -> DataFrame:
    """Rows under protection stay; all others are replaced by what `new` may insert."""
    kept = existing.where(F.coalesce(protected, F.lit(False)))
    return kept.unionByName(insert_if_absent(kept, new, keys, seq).select(existing.columns))


def cloned_grid(grid: DataFrame, column: str, source: int, targets: list[int], reset: dict[str, object]) -> DataFrame:
    """One year's cells for other years, with their flags reset."""
    rows = grid.where(F.col(column) == source).withColumn(column, F.explode(F.array(*map(F.lit, targets))))
    return grid.unionByName(rows.withColumns({c: F.lit(v).cast(dict(grid.dtypes)[c]) for c, v in reset.items()}))


def with_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds the columns that are absent, as NULLs of the given types."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def protected_swap(versions: Versions, new: DataFrame, keys: list[str], protected: Column, seq: str, amount: str) -> bool:
    """replace_unprotected over the current version, made the current one if the invariants hold."""
    return versions.publish(replace_unprotected(versions.read(), new, keys, protected, seq), amount)
