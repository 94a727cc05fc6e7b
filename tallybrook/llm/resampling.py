"""Target-distribution importance resampling (operator 11).

Every run of words falls in a bucket by its bytes' crc32. Counts of the buckets over all documents and all target texts give
each bucket a gain, an array that the tasks look up; a document's weight is the mean of its words' gains, and Gumbel noise
drawn from its id makes the highest scores a weighted draw without replacement.

Each scoring task writes its eligible rows as sorted runs. The exact cut follows from the counts of scores, which are whole
numbers of a small range, so only rows at or above the cut move: to ranges of the full order, each merged from its stretches
of runs by a tournament tree, and the ranges' sizes turn places into ranks. Rows equal in score and doc_id are told apart by
run and place, so equal rows do not gather in one range.

Bounds: BUCKETS counts and the counts of distinct scores reach the driver; both are fixed in size, since a gain lies within
1000 * ln(1e19) of 0 and the noise within 30,000. A task holds RUN rows of five numbers; a merge about RANGE rows.

Cases: a null or empty text, or one without words, has no features, weight 0, and is never eligible; a null doc_id is hashed
as an empty one and comes before others of its score; equal doc_ids are rows of their own with noise in common; ties of score
go to the smaller doc_id, then fewer features. Texts of any length are read whole, in pieces of CHUNK_BYTES cut between words. An
empty table gives no rows; without target texts all gains follow from T = 0; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._base import CHUNK_BYTES, begins_of, bytes_of, pieces, stored, table

BUCKETS, SEED, LEAST_WORDS, PERCENT = 10_000, 2024, 20, 10
#: Rows of a sorted run, and about how many rows a merge takes.
RUN, RANGE = 1 << 20, 1 << 17
#: Bytes of a word that are hashed for all words at once; longer words are hashed one by one.
SHORT = 24

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _table() -> np.ndarray:
    """The 256 steps of crc32 by a byte, by the polynomial's definition."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & np.uint32(1), (step >> np.uint32(1)) ^ np.uint32(0xEDB88320), step >> np.uint32(1))
    return step


CRC = _table()


def carried(crc: np.ndarray, raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """crc32 of what `crc` stands for followed by each word's bytes."""
    reg = ~crc
    live = np.flatnonzero(length <= SHORT)
    for k in range(SHORT):
        live = live[length[live] > k]
        if not len(live):
            break
        reg[live] = CRC[(reg[live] ^ raw[start[live] + k]) & np.uint32(255)] ^ (reg[live] >> np.uint32(8))
    out = ~reg
    for i in np.flatnonzero(length > SHORT):
        out[i] = zlib.crc32(raw[start[i] : start[i] + length[i]].tobytes(), int(crc[i]))
    return out


def _cuts(raw: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of about CHUNK_BYTES; within a text only where no word is."""
    at, edges = 0, set(off.tolist())
    while at < len(raw):
        end = min(at + CHUNK_BYTES, len(raw))
        while end < len(raw) and end not in edges and WORD[raw[end - 1]] and WORD[raw[end]]:
            rest = np.flatnonzero(~WORD[raw[end : end + CHUNK_BYTES]])
            ends = off[np.searchsorted(off, end, "right")] - end
            end += int(min(rest[0] if len(rest) else CHUNK_BYTES, ends))
        yield at, end
        at = end


def buckets_of(texts: pa.Array, longest: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features of each text in turn (runs of one word, then of two and so on), how many features each text has, and how many words."""
    raw, off = bytes_of(texts)
    raw = LOWER[raw]
    starts, lengths = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for a, b in _cuts(raw, off):
        inside = off[(off > a) & (off < b)] - a
        part = WORD[raw[a:b]]
        start = begins_of(part, np.concatenate([[0], inside, [b - a]]))
        kept = np.flatnonzero(part)
        rank = np.searchsorted(kept, start)
        starts.append(start + a)
        lengths.append(np.diff(np.append(rank, len(kept))))
    start, length = np.concatenate(starts), np.concatenate(lengths)
    counts = np.searchsorted(start, off)
    words = np.diff(counts)
    text = np.repeat(np.arange(len(words)), words)
    crc, found, owner = np.zeros(len(start), np.uint32), [], []
    for n in range(longest):
        left = len(start) - n
        if left <= 0:
            break
        if n:
            inside = text[:left] == text[n:]
            crc = carried(crc[:left], np.full(1, 32, np.uint8), np.zeros(left, np.int64), np.ones(left, np.int64))
        crc = carried(crc, raw, start[n:], length[n:])
        found.append((crc if not n else crc[inside]) % np.uint32(BUCKETS))
        owner.append(text if not n else text[:left][inside])
    if longest > 1 and found:
        order = np.argsort(np.concatenate(owner), kind="stable")
        found, owner = [np.concatenate(found)[order]], [np.concatenate(owner)[order]]
    bucket = found[0].astype(np.int64) if found else np.empty(0, np.int64)
    return bucket, np.bincount(owner[0], minlength=len(words)) if found else np.zeros(len(words), np.int64), words


def counted(docs: DataFrame, longest: int = 1) -> np.ndarray:
    """How often each bucket occurs in all texts; a task gives at most BUCKETS rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for piece in pieces(batch, "text"):
                total += np.bincount(buckets_of(piece.column("text"), longest)[0], minlength=BUCKETS)
        has = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(total[has])], ["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for r in docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains_of(have: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log ratio of smoothed shares, by the C library's logarithm."""
    s, t = float(have.sum()) + BUCKETS, float(want.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((float(b) + 1) * s / ((float(a) + 1) * t))) for a, b in zip(have, want, strict=True)], np.int64)


def noise_of(doc_id: int | None, seed: int = SEED) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


SCORED = "doc_id long, n_features long, n_words long, weight long, score long, run long, place long"


def scored(docs: DataFrame, gains: np.ndarray, longest: int = 1, least: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """Each document's weight and score. Eligible rows come as sorted runs (run, place); others have no run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, rows, made = TaskContext.get().partitionId(), [], 0, 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                bucket, n, words = buckets_of(piece.column("text"), longest)
                sums = np.concatenate([[0], np.cumsum(gains[bucket])])
                ends = np.concatenate([[0], np.cumsum(n)])
                weight = (sums[ends[1:]] - sums[ends[:-1]]) // np.maximum(n, 1)
                ids = piece.column("doc_id").to_pylist()
                score = weight + np.array([noise_of(i, seed) for i in ids], np.int64)
                held.append((np.array([i is None for i in ids]), np.array([i or 0 for i in ids], np.int64), n, words, weight, score))
                rows += len(ids)
                if rows >= RUN:
                    yield _run(held, task << 32 | made, least)
                    held, rows, made = [], 0, made + 1
        if rows:
            yield _run(held, task << 32 | made, least)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCORED)


def _run(held: list[tuple], name: int, least: int) -> pa.RecordBatch:
    none, doc, n, words, weight, score = (np.concatenate(c) for c in zip(*held, strict=True))
    out = words < least
    order = np.lexsort((n, doc, ~none, -score, out))
    out, size = out[order], len(order)
    columns = [pa.array(doc[order], mask=none[order]), *(pa.array(c[order].astype(np.int64)) for c in (n, words, weight, score))]
    columns += [pa.array(np.full(size, name), mask=out), pa.array(np.arange(size), mask=out)]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCORED.split(", ")])


class Tournament:
    """A tree of losers over sorted runs: the leader is met in its leaf's path alone after each step."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at, n = runs, [0] * len(runs), len(runs)
        self.n, self.losers = n, [-1] * max(n, 1)
        best = {n + i: i for i in range(n)}  # nodes n and beyond are leaves
        for node in range(n - 1, 0, -1):
            a, b = best[2 * node], best[2 * node + 1]
            best[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.leader = best[1] if n else -1

    def _before(self, a: int, b: int) -> bool:
        """Whether the head of run a comes before that of run b; an ended run comes last."""
        if self.at[a] >= len(self.runs[a]):
            return False
        return self.at[b] >= len(self.runs[b]) or (self.runs[a][self.at[a]], a) < (self.runs[b][self.at[b]], b)

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, place in it) in the order of all runs together."""
        while self.n and self.at[self.leader] < len(self.runs[self.leader]):
            who = self.leader
            yield who, self.at[who]
            self.at[who] += 1
            node = (self.n + who) >> 1
            while node:
                if self._before(self.losers[node], who):
                    who, self.losers[node] = self.losers[node], who
                node >>= 1
            self.leader = who


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a range in order, from the sorted stretches in which they come."""
    task, found = TaskContext.get().partitionId(), [b for b in batches if b.num_rows]
    if not found:
        return
    rows = pa.Table.from_batches(found).combine_chunks()
    cols = {c: rows.column(c).to_pylist() for c in ("score", "doc_id", "n_features", "run", "place")}
    keys = [(-s, d is not None, d or 0, n, r, p) for s, d, n, r, p in zip(*cols.values(), strict=True)]
    cuts = [0, *(i for i in range(1, len(keys)) if keys[i] < keys[i - 1]), len(keys)]
    runs = [keys[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    order = np.fromiter((cuts[run] + at for run, at in Tournament(runs)), np.int64, len(keys))
    rows = rows.take(pa.array(order)).select(["doc_id", "n_features", "weight", "score"])
    rows = rows.append_column("part", pa.array(np.full(len(order), task))).append_column("at", pa.array(np.arange(1, len(order) + 1)))
    yield from rows.to_batches()


def drawn(docs: DataFrame, target: DataFrame, percent: int = PERCENT, longest: int = 1, least: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of docs; target has a column `text`."""
    spark = docs.sparkSession
    rows = stored(scored(docs, gains_of(counted(docs, longest), counted(target, longest)), longest, least, seed), "scores")
    of_score = sorted(((r.score, r.n) for r in rows.where("run is not null").groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    want = percent * sum(n for _, n in of_score) // 100
    cut, above = None, 0
    for score, n in of_score:
        if above >= want:
            break
        cut, above = score, above + n
    told = ["doc_id", "n_features", "weight", "score"]
    if cut is None:
        return rows.select(*told, F.lit(None).cast("long").alias("rank"))
    in_reach = F.coalesce(F.col("run").isNotNull() & (F.col("score") >= cut), F.lit(False))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-above // RANGE))
    ranges = rows.where(in_reach).repartitionByRange(parts, F.col("score").desc(), F.col("doc_id").asc_nulls_first(), "n_features", "run", "place")
    merged = stored(ranges.mapInArrow(_merged, "doc_id long, n_features long, weight long, score long, part long, at long"), "ranges")
    sizes = merged.groupBy("part").agg(F.max("at").alias("size"))
    before = sizes.select("part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # a row for each range
    rank = F.col("before") + F.col("at")
    ranked = merged.join(F.broadcast(before), "part").select(*told, F.when(rank <= want, rank).alias("rank"))
    return ranked.unionByName(rows.where(~in_reach).select(*told, F.lit(None).cast("long").alias("rank")))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drawn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: crc32 by the polynomial's definition: a register shifted bit by bit, then a table of its 256 values taken byte by byte.
CRC_SQL = """
crc_table AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps FROM (SELECT unnest(range(256)) AS i))"""


def crc_sql(text: str) -> str:
    """DuckDB: the unsigned crc32 of a column's UTF-8 bytes; crc_table must be in the query."""
    digits = f"hex(encode({text}))"
    byte = f"('0x' || substr({digits}, 2 * k + 1, 2))::BIGINT"
    return f"xor(list_reduce(list_concat([4294967295], list_transform(range(octet_length(encode({text}))), lambda k: {byte})), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)"


SQL = {
    "op11_importance_resampling": f"""
WITH {CRC_SQL},
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
here AS (SELECT doc_id, unnest(words) AS word FROM d),
there AS (SELECT unnest(words) AS word FROM b),
known AS MATERIALIZED (SELECT word, {crc_sql("word")} % 10000 AS bucket FROM (SELECT word FROM here UNION SELECT word FROM there), crc_table),
have AS (SELECT bucket, count(*) AS s FROM here JOIN known USING (word) GROUP BY bucket),
want AS (SELECT bucket, count(*) AS t FROM there JOIN known USING (word) GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM here) + 10000) / ((s + 1)::DOUBLE * ((SELECT count(*) FROM there) + 10000))))::BIGINT AS gain FROM have LEFT JOIN want USING (bucket)),
weights AS (SELECT doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM here JOIN known USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scores AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (doc_id)),
ranks AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * (SELECT count(*) FROM ranks) // 100 THEN rank END AS rank
FROM scores LEFT JOIN ranks USING (doc_id)"""
}
QUERIES = {"op11_importance_resampling": op11_importance_resampling}
