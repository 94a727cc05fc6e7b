"""Interactive search: a specification in, a frame of rows and a frame with their number out."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions import text


@dataclass(frozen=True)
class SearchSpec:
    keyword: str | None = None
    years: list[int] = field(default_factory=list)
    categories: list[str] = field(default_factory=list)
    agencies: list[str] = field(default_factory=list)
    limit: int = 500


def conditions(spec: SearchSpec, name: str = "vendor") -> Column:
    """The conjunction of what is asked; nothing asked is no filter. % and _ in a keyword are wildcards."""
    parts = [F.col(c).isin(v) for c, v in (("fiscal_year", spec.years), ("category", spec.categories), ("agency", spec.agencies)) if v]
    if spec.keyword:
        parts.append(text.nfkc(F.col(name)).ilike(f"%{spec.keyword}%"))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def search(contracts: DataFrame, spec: SearchSpec, name: str = "vendor") -> tuple[DataFrame, DataFrame]:
    hits = contracts.where(conditions(spec, name))
    return hits.orderBy(F.desc_nulls_last("amount"), "id").limit(spec.limit), hits.agg(F.count("*").alias("total"))


def drill(df: DataFrame, path: dict[str, str]) -> DataFrame:
    """One to three levels of a hierarchy."""
    return reduce(lambda d, kv: d.where(F.col(kv[0]) == kv[1]), path.items(), df)


def facet_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def adaptive(df: DataFrame, wanted: list[str], flags: list[str]) -> DataFrame:
    """The wanted columns that exist; flags that are NULL count as 0."""
    return df.select(*((F.coalesce(F.col(c), F.lit(0)).alias(c) if c in flags else F.col(c)) for c in wanted if c in df.columns))
