"""Exact top-k search (operator 3): a bit-sliced index.

A block of rows keeps, for each component and each bit of its whole-number value, one bitmap over the rows. A query's
inner product is summed on the bitmaps: each digit of a weight (1 or -1, no two side by side) adds the component's slices or
their complements, shifted, by carry-save addition, which gives the slices of the score. From the most significant slice
down, rows that have the bit are kept while more than k are left; rows still equal after the last slice are the boundary,
taken by smaller id. Every block gives its k best of each query, and the k best of all blocks are the result: nothing is
estimated.

Products of low bits wait: what they can add to a score has a bound, so after the others are summed only rows within that
bound of the k-th best can be among the k best. The scores of these few are checked whole; where they are not few, or
numbers are wide, all products are summed.

Queries go to row blocks as packed blocks, an equi-join on the block's number. It is a merge join: packs are sent once to
each block, which Spark's estimate of their size does not count, so it would broadcast them through the driver.

Rows with a component of WIDE and more after scaling have blocks of their own, of fewer rows, whose slices are cut from
whole numbers of any length; so their scores are exact too.

Cases: vectors that are null, empty, or hold a component that is null or not finite after scaling take no part; vectors
of different lengths are not compared; rows of equal vec_id are each kept, and none is found by its own id; rows without
a vec_id take no part; scores beyond a long are ranked exactly and shown as the nearest long; with fewer than k
candidates all are returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._base import table

SCALE, TOP = 256, 5
BLOCK_ROWS, BLOCK_QUERIES, WIDE_ROWS = 16_384, 512, 256
WORD = 64
#: What products that wait may add to a score, in standard deviations of a block's scores, were its components independent.
LEFT_OUT = 1.0
#: Up to one in so many of a block's rows is checked whole.
MOST_CHECKED = 16
#: Whole numbers below this are held in 64 bits.
WIDE = 2.0**62
MOST_LONG = 2**63 - 1


def narrowed(values: np.ndarray) -> np.ndarray:
    """Whole numbers that stand as doubles, in the smallest type that holds them all."""
    most = np.abs(values).max()
    return values.astype(next((t for t in (np.int8, np.int16, np.int32) if most <= np.iinfo(t).max), np.float64))


def usable(scaled: Column) -> Column:
    return scaled.isNotNull() & (F.size(scaled) > 0) & F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def whole(values: np.ndarray) -> np.ndarray:
    """Whole numbers that stand as doubles: 64 bits where they fit, else Python's."""
    if not values.size or np.abs(values).max() < WIDE:
        return values.astype(np.int64)
    return np.array([int(x) for x in values.ravel().tolist()], object).reshape(values.shape)


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Bitmaps (components, bits, words) of values less each component's smallest, those smallest, and the bits."""
    low = values.min(0)
    up = values - low
    bits = max(1, max(int(x) for x in up.max(0)).bit_length())
    pad = -len(up) % WORD
    if up.dtype == object:
        wide = np.frombuffer(b"".join(x.to_bytes(-(-bits // 8), "little") for x in up.T.ravel()), np.uint8)
        planes = np.unpackbits(wide.reshape(up.shape[1], len(up), -1), axis=2, count=bits, bitorder="little").transpose(0, 2, 1)
        planes = np.concatenate([planes, np.zeros((*planes.shape[:2], pad), np.uint8)], axis=2)
    else:
        up = np.concatenate([up.astype(np.uint64), np.zeros((pad, up.shape[1]), np.uint64)])
        planes = ((up.T[:, None, :] >> np.arange(bits, dtype=np.uint64)[None, :, None]) & np.uint64(1)).astype(np.uint8)
    packed = np.ascontiguousarray(np.packbits(planes, axis=2, bitorder="little"))
    return packed.view(np.uint64), low, bits


def digits(weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each power of two, the components whose weight has it as a digit 1 and those with a digit -1, no two digits side by side."""
    weights = weights if weights.dtype == object or not weights.size or np.abs(weights).max() < WIDE / 4 else weights.astype(object)
    size, negative = np.abs(weights), weights < 0
    changed = size ^ 3 * size
    plus, minus = (changed & 3 * size) >> 1, (changed & size) >> 1
    plus, minus = np.where(negative, minus, plus), np.where(negative, plus, minus)
    return [(np.flatnonzero(plus >> j & 1), np.flatnonzero(minus >> j & 1)) for j in range(max((int(x) for x in plus | minus), default=0).bit_length())]


def left_out(parts: list[tuple[np.ndarray, np.ndarray]], bits: int, cut: int) -> int:
    """The most that products below the bit `cut` add to a score."""
    return sum((len(p) + len(m)) * ((1 << min(cut, j + bits)) - (1 << j)) for j, (p, m) in enumerate(parts[:cut]))


def score_slices(planes: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]], cut: int = 0) -> list[np.ndarray]:
    """Slices of the sum of weights times values from the bit `cut` on, low bit first, without what lower bits add up to; digits -1 take complements."""
    dims, bits, words = planes.shape[0] // 2, planes.shape[1], planes.shape[2]
    columns: dict[int, list[np.ndarray]] = {}
    for j, (plus, minus) in enumerate(parts):
        rows = np.concatenate([plus, minus + dims])
        for b in range(max(0, cut - j), bits if len(rows) else 0):
            columns.setdefault(j + b, []).append(rows * bits + b)
    flat, out, carried, k = planes.reshape(-1, words), [], [], cut
    while k <= max(columns, default=-1) or carried:
        own = np.concatenate(columns[k]) if k in columns else np.empty(0, np.int64)
        items = np.empty((len(own) + sum(map(len, carried)), words), np.uint64)
        np.take(flat, own, axis=0, out=items[: len(own)], mode="clip")
        np.concatenate([items[:0], *carried], out=items[len(own) :])
        carried = []
        while len(items) > 1:  # each third of the rows becomes sums, kept in its last part, and carries in its first
            m = len(items) // 3
            if not m:
                carried.append((items[0] & items[1])[None])
                items = (items[0] ^ items[1])[None]
                break
            a, b, c = items[:m], items[m : 2 * m], items[2 * m : 3 * m]
            half = a ^ b
            a &= b
            np.bitwise_and(c, half, out=b)
            a |= b
            c ^= half
            carried.append(a)
            items = items[2 * m :]
        out.append(items[0] if len(items) else np.zeros(words, np.uint64))
        k += 1
    return out


def places(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_rows(slices: list[np.ndarray], rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest rows among the bitmap `rows`; among equals, the lower places."""
    sure, maybe = np.zeros_like(rows), rows
    for s in reversed(slices):
        have = maybe & s
        n = int(np.bitwise_count(sure | have).sum())
        if n > k:
            maybe = have
        else:
            sure, maybe = sure | have, maybe & ~s
            if n == k:
                maybe = np.zeros_like(rows)
                break
    found = places(sure)
    return np.concatenate([found, places(maybe)[: k - len(found)]])


def at_least(slices: list[np.ndarray], rows: np.ndarray, bound: int) -> np.ndarray:
    """Of the bitmap `rows`, those whose slices make up `bound` or more."""
    if bound <= 0 or bound >> len(slices):
        return rows if bound <= 0 else np.zeros_like(rows)
    above, equal = np.zeros_like(rows), rows
    for b in reversed(range(len(slices))):
        if bound >> b & 1:
            equal = equal & slices[b]
        else:
            above, equal = above | equal & slices[b], equal & ~slices[b]
    return above | equal


def value_at(slices: list[np.ndarray], p: int) -> int:
    return sum(1 << b for b, s in enumerate(slices) if int(s[p // WORD]) >> (p % WORD) & 1)


class Block:
    """A block's index: slices, then their complements; each component's smallest value; ids, which ascend."""

    def __init__(self, planes: np.ndarray, low: np.ndarray, ids: np.ndarray) -> None:
        self.planes, self.low, self.ids, self.bits = np.concatenate([planes, ~planes]), low, ids, planes.shape[1]
        self.values = None
        if low.dtype != object and self.bits < 31 and np.abs(low).max() < 1 << 31:
            self.values = np.repeat(low[None], len(ids), 0)
            for b in range(self.bits):
                self.values += np.unpackbits(planes[:, b].view(np.uint8), axis=1, count=len(ids), bitorder="little").T.astype(np.int64) << b
            self.spread, self.most = self.values.var(0), int(np.abs(self.values).max())

    def cut(self, weights: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]]) -> int:
        """The bit below which products may wait: they add little beside what sets rows apart."""
        if self.values is None or weights.dtype == object or sum(map(abs, weights.tolist())) * self.most >= MOST_LONG:
            return 0
        apart, cut = LEFT_OUT * float(np.sqrt(weights.astype(float) ** 2 @ self.spread)), 0
        while cut < len(parts) and left_out(parts, self.bits, cut + 1) <= apart:
            cut += 1
        return cut

    def search(self, query_id: int, weights: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(vec_id, score) of the k best rows that are not the query's.

        First the slices from the cut on are summed. What is left out adds between 0 and a known sum, so rows further
        below the k-th best are out; the others' scores are checked whole. Where too many are left, all slices are summed.
        """
        rows = np.packbits(np.append(self.ids != query_id, np.zeros(-len(self.ids) % WORD, bool)), bitorder="little").view(np.uint64)
        parts = digits(weights)
        cut = self.cut(weights, parts)
        if cut:
            slices = score_slices(self.planes, parts, cut)
            best = top_rows(slices, rows, k)
            if len(best) == k:
                least = min(value_at(slices, p) for p in best.tolist())
                maybe = places(at_least(slices, rows, least - (left_out(parts, self.bits, cut) >> cut)))
                if len(maybe) <= max(k, len(self.ids) // MOST_CHECKED):
                    scores = self.values[maybe] @ weights
                    order = np.lexsort((maybe, -scores))[:k]
                    return list(zip(self.ids[maybe[order]].tolist(), scores[order].tolist(), strict=True))
        slices = score_slices(self.planes, parts)
        more = int(weights.astype(object) @ self.low.astype(object)) - sum(len(m) << j for j, (_, m) in enumerate(parts)) * ((1 << self.bits) - 1)
        return [(int(self.ids[p]), value_at(slices, p) + more) for p in top_rows(slices, rows, k).tolist()]


def top_k(vectors: DataFrame, queries: Column, k: int = TOP, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that `queries` picks, its k best others by inner product of floor(scale * x)."""
    scaled = F.transform("embedding", lambda x: F.lit(float(scale)) * x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v")).where(usable(F.col("v")) & F.col("vec_id").isNotNull())
    rows = rows.withColumns({"dim": F.size("v"), "wide": F.exists("v", lambda x: F.abs(x) >= F.lit(WIDE))})
    n, n_wide, n_queries = rows.agg(F.count_if(~F.col("wide")), F.count_if("wide"), F.count_if(queries)).first()
    narrow, wide, packs = -(-n // BLOCK_ROWS), -(-n_wide // WIDE_ROWS), max(1, -(-n_queries // BLOCK_QUERIES))
    dealt = lambda of, salt: F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(max(1, of))).cast("int")
    block = F.when(F.col("wide"), dealt(wide, 1) + F.lit(narrow)).otherwise(dealt(narrow, 1))

    def matrix(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Ids in order, and the floors of their components as doubles."""
        group = group.sort_by("vec_id")
        flat = group.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return group.column("vec_id").to_numpy(), np.floor(flat).reshape(group.num_rows, -1)

    def index(group: pa.Table) -> pa.Table:
        ids, v = matrix(group)
        planes, _, bits = slices_of(whole(v))
        one = {"block": group.column("block")[0].as_py(), "dim": v.shape[1], "ids": ids.tobytes(), "bits": bits, "low": v.min(0).tobytes(), "slices": planes.tobytes()}
        return pa.Table.from_pylist([one], pa.schema([("block", pa.int32()), ("dim", pa.int32()), ("ids", pa.binary()), ("bits", pa.int32()), ("low", pa.binary()), ("slices", pa.binary())]))

    def packed(group: pa.Table) -> pa.Table:
        ids, v = matrix(group)
        weights = narrowed(v)
        return pa.Table.from_pylist([{"dim": v.shape[1], "query_ids": ids.tobytes(), "kind": weights.dtype.str, "weights": weights.tobytes()}], pa.schema([("dim", pa.int32()), ("query_ids", pa.binary()), ("kind", pa.string()), ("weights", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = block = None
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if held != (r["dim"], r["block"]):
                    held = r["dim"], r["block"]
                    block = Block(np.frombuffer(r["slices"], np.uint64).reshape(r["dim"], r["bits"], -1), whole(np.frombuffer(r["low"])), np.frombuffer(r["ids"], np.int64))
                weights = np.frombuffer(r["weights"], r["kind"]).reshape(-1, r["dim"])
                found = [(q, *x) for q, w in zip(np.frombuffer(r["query_ids"], np.int64).tolist(), weights, strict=True) for x in block.search(q, whole(w), k)]
                shown = [max(-MOST_LONG - 1, min(MOST_LONG, x[2])) for x in found]
                beyond = ["" if x[2] == y else f"{x[2] + (1 << 2300):0576x}" for x, y in zip(found, shown, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()), pa.array(shown, pa.int64()), pa.array(beyond, pa.string())], ["query_id", "vec_id", "score", "beyond"])

    built = rows.withColumn("block", block).groupBy("dim", "block").applyInArrow(index, "block int, dim int, ids binary, bits int, low binary, slices binary")
    asked = rows.where(queries).withColumn("pack", dealt(packs, 2)).groupBy("dim", "pack").applyInArrow(packed, "dim int, query_ids binary, kind string, weights binary")
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(1, narrow + wide) - 1))))
    best = asked.join(built.hint("merge"), ["dim", "block"]).mapInArrow(run, "query_id long, vec_id long, score long, beyond string")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES = {"op3_bit_sliced_top_k": op3_bit_sliced_top_k}
SQL = {
    "op3_bit_sliced_top_k": """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e from embeddings
           where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
      from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 50 = 0),
r as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s)
select query_id, rank, vec_id, score from r where rank <= 5
""",
}
