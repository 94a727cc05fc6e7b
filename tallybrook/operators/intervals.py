"""Range joins as equi-joins: intervals that overlap, and points in intervals.

Intervals of whole numbers (days, months, places) are laid on a grid of buckets. An interval lives on the finest level whose
buckets are at least as wide as itself, each level FACTOR times as wide as the one below, so it touches two buckets at most
however long it is. Of a pair, the shorter one visits the longer one's level, and the two count in the one bucket that holds the
later of their begins: each pair appears once and nothing needs a distinct. On coarse levels, whose buckets are few and
visited by many, a bucket is dealt over parts by the visitors' fine buckets, and the long intervals stand in each. A bucket has
no more parts than visitors, and none without them, so an interval is copied no more often than it is compared. The sizes that
the planner knows are those before the copies, so the joins are by sorting: nothing goes through the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Width of the finest buckets, the ratio of widths from level to level, and the levels there are.
WIDTH, FACTOR, LEVELS = 16, 4, 24
#: Parts of a bucket on a coarse level at most.
MOST_PARTS = 64


def level_of(lo: Column, hi: Column) -> Column:
    """The finest level whose buckets are as wide as the interval."""
    out = F.lit(LEVELS - 1)
    for k in reversed(range(LEVELS - 1)):
        out = F.when(hi - lo < WIDTH * FACTOR**k, k).otherwise(out)
    return out


def _width(level: Column) -> Column:
    return F.element_at(F.array(*(F.lit(WIDTH * FACTOR**k).cast("decimal(20,0)").cast("long") for k in range(LEVELS))), level + 1)


def _parts(level: Column) -> Column:
    return F.element_at(F.array(*(F.lit(min(FACTOR**k, MOST_PARTS)) for k in range(LEVELS))), level + 1)


def _buckets(df: DataFrame, lo: str, hi: str, level: Column) -> DataFrame:
    """A row for each bucket of the level that the interval touches."""
    df = df.withColumn("_level", level).withColumn("_width", _width(F.col("_level")))
    return df.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(lo) / F.col("_width")), F.floor(F.col(hi) / F.col("_width")))))


def overlapping(left: DataFrame, right: DataFrame, a: tuple[str, str], b: tuple[str, str], keys: list[str] | None = None) -> DataFrame:
    """Rows of both whose intervals (first and last, both inside) share a number, and whose keys are equal; columns of both.

    A point is an interval with one column twice. Rows with a null end, or one that ends before it begins, join nothing.
    Column names other than the keys must differ. Which levels there are is counted first.
    """
    keys = keys or []
    good = lambda df, lo, hi: df.where(F.col(lo) <= F.col(hi)).withColumn("_own", level_of(F.col(lo), F.col(hi)))
    left, right = good(left, *a), good(right, *b)
    here, there = (sorted(df.agg(F.collect_set("_own")).first()[0]) for df in (left, right))  # LEVELS numbers at most

    def met(visitors: DataFrame, owners: DataFrame, v: tuple[str, str], o: tuple[str, str], levels: list[int], same: bool) -> DataFrame:
        """Visitors with owners of coarser levels, or of the same one too."""
        to = F.filter(F.array(*map(F.lit, levels)), lambda k: (k >= F.col("_own")) if same else (k > F.col("_own")))
        come = visitors.withColumn("_at", F.explode(to))
        place = [*keys, "_level", "_bucket"]
        come, stay = _buckets(come, *v, F.col("_at")).drop("_own", "_at", "_width"), _buckets(owners, *o, F.col("_own")).drop("_own")
        crowd = come.groupBy(*place).agg(F.least(F.count("*"), _parts(F.first("_level"))).alias("_parts")).hint("merge")
        come = come.join(crowd, place).withColumn("_part", F.pmod(F.floor(F.col(v[0]) / WIDTH), F.col("_parts"))).drop("_parts")
        stay = stay.join(crowd, place).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).drop("_parts")
        both = come.join(stay.hint("merge"), [*place, "_part"])
        later = F.greatest(F.col(v[0]), F.col(o[0]))
        return both.where((F.col(v[0]) <= F.col(o[1])) & (F.col(o[0]) <= F.col(v[1])) & (F.floor(later / F.col("_width")) == F.col("_bucket")))

    names = [*keys, *(c for c in left.columns if c not in keys and c != "_own"), *(c for c in right.columns if c not in keys and c != "_own")]
    out = []
    if not (here and there) or here[0] <= there[-1]:
        out.append(met(left, right, a, b, there, True).select(names))
    if here and there and here[-1] > there[0]:
        out.append(met(right, left, b, a, here, False).select(names))
    return reduce(DataFrame.unionByName, out)


def counted(points: DataFrame, intervals: DataFrame, point: str, ends: tuple[str, str], out: str, weight: str | None = None) -> DataFrame:
    """Adds to each point how many intervals hold it, or the sum of their weights; equal points and equal intervals meet once."""
    distinct = points.select(point).where(F.col(point).isNotNull()).distinct().select(F.col(point).alias("_p"))
    each = intervals.groupBy(*ends).agg((F.sum(weight) if weight else F.count("*")).alias("_w"))
    sums = overlapping(distinct, each, ("_p", "_p"), ends).groupBy("_p").agg(F.sum("_w").alias(out))
    return points.join(sums, F.col(point) == F.col("_p"), "left").drop("_p").withColumn(out, F.coalesce(out, F.lit(0)))
