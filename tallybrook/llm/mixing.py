"""Mixing sources to target weights (operator 7): Pfair scheduling, in DataFrame operations only.

A source's documents, in an order drawn by hash, are cut into blocks of `block_chars` characters. Weights are whole
numbers of slots in a period; block k of a source with n of W slots may run from floor(k W / n) and must end by
ceil((k + 1) W / n). Of the blocks that may run, each slot takes the one of the earliest deadline, which keeps every
source within less than one block of its share at every slot. The schedule repeats with the period, so one period's
slots (W rows; the sources are few and counted) are laid out once and joined to all blocks by (source, k mod n).

Every document is kept. A source that has run out leaves its slots empty; `on_target` marks the slots before the release
of the first block that is missing, where the shares hold exactly. Prefix sums go by hashed buckets of a source, so a
source with a third of all rows is no single task.

The MOST_SOURCES sources with most characters have slots of their own; where there are more, the others are scheduled on
two levels: sources of one size (within CLASS_STEP of each other) form a pool, which takes its slots by deadlines like
a source of their summed weight, and deals them to its sources in turn, their weights being the same. So a pooled source
too stays within a block and a turn of its share, and the driver holds the pools, of which there are few, not the sources.

Cases: a null source is a source of the name ''; null and empty texts count one character; a text longer than a block
belongs to the one that it begins in; rows of equal doc_id are each
kept; ties of the hashed order go by doc_id and size, of deadlines by the source's name; an empty table gives no rows; other columns are carried by `mixed` and play no part.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._base import prefix_sums, stored, table

BLOCK_CHARS = 32_768
#: Target weight of a source: its characters to this power, so that large sources are held back.
POWER = 0.7
#: Slots of a period; at least four for each source.
SLOTS = 1000
#: Sources that have slots of their own: their list is held by the driver, and broadcast with four slots for each.
MOST_SOURCES = 10_000
#: Ratio of characters within a pool: no more than some 3,000 pools up to 1e18 characters.
CLASS_STEP = 1.0139595
POOL = "\0pool "
BUCKET_ROWS, LEAST_BUCKETS = 10_000, 512


def slots_of(weights: dict[str, float], slots: int = SLOTS) -> dict[str, int]:
    """Whole slots by the largest remainder, one at least."""
    slots, total = max(slots, 4 * len(weights)), sum(weights.values())
    exact = {s: max(w / total, 1 / slots) for s, w in weights.items()}
    scale = slots / sum(exact.values())
    given = {s: max(1, int(x * scale)) for s, x in exact.items()}
    order = sorted(weights, key=lambda s: (given[s] - exact[s] * scale, s))
    for i in range(max(0, slots - sum(given.values()))):
        given[order[i % len(order)]] += 1
    return given


def schedule(given: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, k, slot) of one period: earliest deadline first among released blocks."""
    total, ready, out = sum(given.values()), [], []
    release: dict[int, list[tuple[int, str, int]]] = {}
    for s in sorted(given):
        for k in range(given[s]):
            release.setdefault(k * total // given[s], []).append((-(-(k + 1) * total // given[s]), s, k))
    for slot in range(total):
        for x in release.get(slot, []):
            heapq.heappush(ready, x)
        _, s, k = heapq.heappop(ready)
        out.append((s, k, slot))
    return out


def ranked(sources: DataFrame) -> DataFrame:
    """Sources (mix_source, chars, n) with their pool `_queue`, their turn `_rank` in it and its number of sources `_of`."""
    size = F.floor(F.log(F.col("chars").cast("double")) / F.log(F.lit(CLASS_STEP)))
    sources = sources.withColumn("_queue", F.concat(F.lit(POOL), size.cast("string"))).withColumn("_bucket", F.pmod(F.xxhash64("mix_source"), F.lit(LEAST_BUCKETS)))
    counts = sources.groupBy("_queue", "_bucket").agg(F.count("*").alias("_size"))
    sums = prefix_sums(counts, ["_queue"], "_bucket", "_size", "_before").drop("_size")
    of = counts.groupBy("_queue").agg(F.sum("_size").alias("_of"))
    place = F.row_number().over(Window.partitionBy("_queue", "_bucket").orderBy("mix_source")) - 1
    out = sources.withColumn("_place", place).join(sums, ["_queue", "_bucket"]).join(of, "_queue")
    return out.withColumn("_rank", F.col("_before") + F.col("_place")).drop("_bucket", "_before", "_place")


def mixed(docs: DataFrame, size: Column | None = None, weights: dict[str, float] | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of docs with mix_source, mix_block, mix_slot, mix_start and mix_on_target; (mix_slot, mix_start) is the order."""
    spark = docs.sparkSession
    size = F.greatest(F.coalesce(F.length("text"), F.lit(0)), F.lit(1)) if size is None else size
    docs = docs.withColumns({"mix_source": F.coalesce("source", F.lit("")), "mix_size": size.cast("long")})
    sources = docs.groupBy("mix_source").agg(F.sum("mix_size").alias("chars"), F.count("*").alias("n"))
    most = max(MOST_SOURCES, len(weights or {}))
    named = F.col("mix_source").isin(list(weights)) if weights else F.lit(False)
    stats = sources.orderBy(F.desc(named), F.desc("chars"), "mix_source").limit(most + 1).collect()
    docs, rows_of = docs.withColumns({"_queue": F.col("mix_source"), "_rank": F.lit(0).cast("long"), "_of": F.lit(1).cast("long")}), sum(r.n for r in stats)
    have = {r.mix_source: (r.chars, 1) for r in stats[:most]}  # least characters of a source of the queue, and its sources
    wanted = {s: (weights or {}).get(s, 0.0) if weights else float(c) ** POWER for s, (c, _) in have.items()}
    if len(stats) > most:
        own = F.broadcast(spark.createDataFrame([(s,) for s in have], "mix_source string"))
        pooled = stored(ranked(sources.join(own, "mix_source", "left_anti")), "pooled")
        for r in pooled.groupBy("_queue").agg(F.min("chars").alias("least"), F.count("*").alias("sources"), F.sum("n").alias("n"), F.sum(F.pow("chars", F.lit(POWER))).alias("weight")).collect():
            have[r._queue], wanted[r._queue], rows_of = (r.least, r.sources), 0.0 if weights else r.weight, rows_of + r.n
        small = docs.drop("_queue", "_rank", "_of").join(own, "mix_source", "left_anti").join(pooled.select("mix_source", "_queue", "_rank", "_of"), "mix_source")
        docs = docs.join(own, "mix_source", "left_semi").unionByName(small)
    given = slots_of(wanted) if have else {}
    period = sum(given.values())
    horizon = min((-(-c // block_chars) * k * period // given[s] for s, (c, k) in have.items()), default=0)
    rows = json.dumps([{"_queue": s, "_k": k, "_slot": slot, "_n": given[s]} for s, k, slot in schedule(given)])
    plan = spark.range(1).select(F.inline(F.from_json(F.lit(rows), "array<struct<_queue:string,_k:long,_slot:long,_n:long>>")))
    buckets = max(LEAST_BUCKETS, rows_of // BUCKET_ROWS)
    docs = docs.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "mix_size"), F.lit(buckets)))
    sums = docs.groupBy("mix_source", "_bucket").agg(F.sum("mix_size").alias("_size"))
    sums = prefix_sums(sums, ["mix_source"], "_bucket", "_size", "_before").drop("_size")
    own = Window.partitionBy("mix_source", "_bucket").orderBy(F.xxhash64(F.lit(7), "doc_id"), "doc_id", "mix_size").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("_own", F.coalesce(F.sum("mix_size").over(own), F.lit(0))).join(sums, ["mix_source", "_bucket"])
    docs = docs.withColumn("mix_start", F.col("_before") + F.col("_own")).withColumn("mix_block", F.floor(F.col("mix_start") / block_chars))
    n = F.broadcast(plan.select("_queue", "_n").distinct())
    turn = F.col("mix_block") * F.col("_of") + F.col("_rank")  # the queue's blocks: those of its sources in turn
    docs = docs.join(n, "_queue").withColumn("_turn", turn).withColumn("_k", F.col("_turn") % F.col("_n"))
    docs = docs.join(F.broadcast(plan.drop("_n")), ["_queue", "_k"])
    slot = F.col("_slot") + F.floor(F.col("_turn") / F.col("_n")) * F.lit(period)
    return docs.withColumns({"mix_slot": slot, "mix_on_target": slot < F.lit(horizon)}).drop("_bucket", "_before", "_own", "_n", "_k", "_slot", "_queue", "_rank", "_of", "_turn", "mix_size")


def reordered(docs: DataFrame) -> DataFrame:
    """The documents in mixed order, with their own columns."""
    held = docs.select("doc_id", "source", F.greatest(F.coalesce(F.length("text"), F.lit(0)), F.lit(1)).alias("chars"), F.struct(*docs.columns).alias("row"))
    return mixed(held, F.col("chars")).orderBy("mix_slot", "mix_start", "doc_id").select("row.*")


def op7_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixed(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.col("mix_block").alias("block"), F.col("mix_slot").alias("slot"), F.col("mix_start").alias("start"), F.col("mix_on_target").alias("on_target"))


QUERIES = {"op7_pfair_mixing": op7_pfair_mixing}
SQL: dict[str, str] = {}
