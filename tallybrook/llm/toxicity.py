"""Toxicity (operator 12): maximum-scoring segments over token log-odds.

A token's score is the log-odds of toxic against other documents, smoothed by a Dirichlet prior whose mean is the odds of the
token's next shorter beginning, and so on down to the corpus's odds: rare words lean on their stems, frequent ones speak for
themselves. Evidence that its own error covers counts as none, a token's k-th stand in a text counts by k (odds are of texts, and a junk
text may repeat one word throughout), and each token costs DRIFT, so a random text's sums fall.
A linear-time scan then finds every maximal segment of a document (the segments of highest sum, none of which can be
extended or joined with gain). How high such sums rise in clean texts follows an extreme-value law, whose rate and size
are fitted to clean training documents scored by a model of the other half; segments beyond it are significant passages,
their excess over what a text of that length shows by chance is summed, and a logistic of it, fitted likewise, is the score.

The model is fitted on about MOST_ROWS labelled rows, those of the lowest hash, and keeps at most MOST_TOKENS tokens, the
most frequent ones; scoring covers every row. Labels, lang, source and doc_id are never inputs of a score.

Cases: null and empty texts have no token and the score of one without passages; whole texts of any length are scanned in one pass; equal doc_ids are scored
each, and the smallest of their texts is learnt from; equal labels count once and contradicting ones each; of segments with equal sums the first and shortest
is found; with no labelled rows, or of one class alone, every score is that class's share (0.5 for none); an empty table
gives no rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._base import ODD, begins_of, bytes_of, drawn, fold, mix, pieces, stored, table

MOST_ROWS, MOST_TOKENS, LEAST_DOCS = 40_000, 1_000_000, 4
#: Lengths in bytes of the beginnings that a token leans on.
STEMS = (2, 3, 4, 5, 6, 8)
PRIOR, ERRORS, DRIFT, MOST_SCORE = 12.0, 2.0, 0.25, 6.0
#: A segment is a passage if a clean text shows one as high with at most this probability.
SIGNIFICANT = 0.05
THRESHOLD = 0.3

#: Bytes that belong to tokens: letters, digits and all beyond ASCII.
INNER = np.zeros(256, bool)
INNER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each token of the lower-cased texts: its hash, its beginnings' hashes (a row for each of STEMS; 0 where it is no longer
    than that), where it starts in its text in bytes and its length; and the number of tokens before each text."""
    raw, off = bytes_of(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    if not len(raw):
        return np.empty(0, np.uint64), np.empty((len(STEMS), 0), np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(off), np.int64)
    inner = INNER[raw]
    start = begins_of(inner, off)
    edge = np.append(np.flatnonzero(~inner), len(raw))
    length = np.minimum(edge[np.searchsorted(edge, start)], off[np.searchsorted(off, start, "right")]) - start
    counts = np.searchsorted(start, off)
    whole = np.zeros(len(start), np.uint64)
    stems = np.zeros((len(STEMS), len(start)), np.uint64)
    live = np.arange(len(start))
    for k in range(int(length.max(initial=0))):
        live = live[length[live] > k]
        if k in STEMS:
            j = STEMS.index(k)
            stems[j, live] = mix(whole[live] + np.uint64(2 * k + 1))
        if len(live) < 64 and k > 64:  # a few very long tokens: the rest of each at once
            for i in live:
                rest = raw[start[i] + k : start[i] + length[i]].astype(np.uint64) + np.uint64(1)
                power = np.cumprod(np.full(len(rest), ODD, np.uint64))
                whole[i : i + 1] = whole[i : i + 1] * power[-1:] + (rest[::-1] * np.append(np.uint64(1), power[:-1])).sum(dtype=np.uint64, keepdims=True)
            break
        whole[live] = whole[live] * ODD + raw[start[live] + k] + np.uint64(1)
    return mix(whole + (length.astype(np.uint64) << np.uint64(32))), stems, start - off[np.repeat(np.arange(len(off) - 1), np.diff(counts))], length, counts


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, sum) of a row of scores, in order, in linear time: stretches of one sign are
    summed at once, and a stack of candidates is joined where a later one tops all that stands before it."""
    n = len(scores)
    if not n:
        return []
    up = scores > 0
    edge = np.concatenate([[0], np.flatnonzero(up[1:] != up[:-1]) + 1, [n]])
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    runs = np.flatnonzero(up[edge[:-1]])
    first, end = edge[runs], edge[runs + 1]
    stack: list[list] = []  # first, end, sum before, sum after, place below of a candidate with a smaller sum before (-1: none)
    for a, b, left, right in zip(first.tolist(), end.tolist(), sums[first].tolist(), sums[end].tolist(), strict=True):
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                break
            a, left = stack[j][0], stack[j][2]
            del stack[j:]
            j = len(stack) - 1
        stack.append([a, b, left, right, j])
    return [(a, b, right - left) for a, b, left, right, _ in stack]


@dataclass
class Model:
    """Token scores by hash, the extreme-value law of clean texts (rate, log of size), and the logistic of the excess."""

    hashes: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    scores: np.ndarray = field(default_factory=lambda: np.empty(0))
    rate: float = 1.0
    size: float = 0.0
    logistic: tuple[float, float] = (0.0, 0.0)

    def of(self, whole: np.ndarray, stems: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Scores less DRIFT: of the longest form that the model knows, for a token's k-th stand in its text by k if it speaks for toxic."""
        out = np.zeros(len(whole))
        if not len(self.hashes):
            return out - DRIFT
        distinct, at, back = np.unique(whole, return_index=True, return_inverse=True)
        value, open_ = np.zeros(len(distinct)), np.ones(len(distinct), bool)
        for form in (distinct, *stems[::-1, at]):
            place = np.minimum(np.searchsorted(self.hashes, form), len(self.hashes) - 1)
            known = open_ & (self.hashes[place] == form) & (form != 0)
            value[known] = self.scores[place[known]]
            open_ &= ~known
        out = value[back]
        up = np.flatnonzero(out > 0)
        doc = np.searchsorted(counts, up, "right")
        order = np.lexsort((back[up], doc))
        new = np.ones(len(up), bool)
        new[1:] = (back[up][order][1:] != back[up][order][:-1]) | (doc[order][1:] != doc[order][:-1])
        first = np.flatnonzero(new)
        out[up[order]] /= np.arange(len(up)) - np.repeat(first, np.diff(np.append(first, len(up)))) + 1
        return out - DRIFT

    def excess(self, total: np.ndarray | float, tokens: int) -> np.ndarray | float:
        """By how much a segment's sum, in units of the law, tops what a clean text of so many tokens shows once."""
        return self.rate * total - np.log(max(tokens, 1)) - self.size

    def judged(self, found: list[tuple[int, int, float]], tokens: int) -> tuple[float, list[tuple[int, int, float, float]]]:
        """The summed excess of the segments that stand out, and the significant ones with their probabilities in clean texts."""
        out, total = [], 0.0
        for a, b, s in found:
            e = self.excess(s, tokens)
            total += max(e, 0.0)
            p = -np.expm1(-np.exp(-e))
            if p <= SIGNIFICANT:
                out.append((a, b, s, float(p)))
        return total, out

    def score(self, total: float) -> float:
        a, b = self.logistic
        return float(1 / (1 + np.exp(-(a + b * np.log1p(total)))))


def odds(hashes: np.ndarray, parents: np.ndarray, level: np.ndarray, toxic: np.ndarray, other: np.ndarray, totals: tuple[float, float]) -> np.ndarray:
    """Log-odds of each token, each level's prior mean being the share of its parent; insignificant ones are 0."""
    share = totals[0] / max(sum(totals), 1)
    if not 0 < share < 1:
        return np.zeros(len(hashes))
    order = np.argsort(hashes)
    posterior = np.full(len(hashes), share)
    out = np.zeros(len(hashes))
    for k in range(len(STEMS) + 1):
        mine = np.flatnonzero(level == k)
        if not len(mine):
            continue
        place = order[np.minimum(np.searchsorted(hashes, parents[mine], sorter=order), len(order) - 1)]
        mean = np.where(hashes[place] == parents[mine], posterior[place], share)
        a, b = toxic[mine] + PRIOR * mean, other[mine] + PRIOR * (1 - mean)
        posterior[mine] = a / (a + b)
        value = np.log(a / b) - np.log(share / (1 - share))
        error = np.sqrt(1 / np.maximum(a, 0.5) + 1 / np.maximum(b, 0.5))  # half a document at least: a sure parent is no doubt
        out[mine] = np.where(np.abs(value) >= ERRORS * error, np.clip(value, -MOST_SCORE, MOST_SCORE), 0)
    return out


def fitted_law(best: np.ndarray, tokens: np.ndarray) -> tuple[float, float]:
    """Rate and log size of P(best of n tokens < x) = exp(-size * n * exp(-rate * x)), by most likelihood over clean texts."""
    keep = tokens > 0
    x, n = best[keep], tokens[keep].astype(float)
    if len(x) < 20 or x.std() < 1e-9:
        return 1.0, 0.0
    best_of = (-np.inf, 1.0, 0.0)
    for rate in np.geomspace(0.05, 5, 120):
        k = len(x) / (n * np.exp(-rate * x)).sum()
        told = len(x) * np.log(rate * k) - rate * x.sum() - len(x)
        best_of = max(best_of, (told, rate, np.log(k)))
    return float(best_of[1]), float(best_of[2])


def fitted_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton's method with a small ridge."""
    m, w = np.stack([np.ones(len(x)), x], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(m @ w, -30, 30)))
        g = m.T @ (y - p) - 1e-2 * w
        w = w + np.linalg.solve((m * (p * (1 - p))[:, None]).T @ m + 1e-2 * np.eye(2), g)
    return float(w[0]), float(max(w[1], 0.0))


def _counted(rows: DataFrame) -> DataFrame:
    """Of each form of a token, in how many documents of each half and class it stands. A task adds up what it has before it sends it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                whole, stems, _, _, counts = tokens_of(piece.column("text"))
                doc = np.repeat(np.arange(len(counts) - 1), np.diff(counts))
                kind = (piece.column("half").to_numpy(zero_copy_only=False) * 2 + piece.column("toxic").to_numpy(zero_copy_only=False)).astype(np.int64)
                forms = [*stems, whole]
                hashes, parents, levels, owners = [], [], [], []
                longest = np.zeros(len(whole), np.uint64)
                for k, form in enumerate(forms):
                    has = form != 0
                    order = np.lexsort((form[has], doc[has]))
                    h, o, p = form[has][order], doc[has][order], longest[has][order]
                    new = np.ones(len(h), bool)
                    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
                    hashes.append(h[new]), parents.append(p[new]), owners.append(o[new])
                    levels.append(np.full(int(new.sum()), k))
                    longest[has] = form[has]
                h, p, v, o = (np.concatenate(c) for c in (hashes, parents, levels, owners))
                distinct, at, back = np.unique(h, return_index=True, return_inverse=True)
                n = np.bincount(back * 4 + kind[o], minlength=len(distinct) * 4).reshape(-1, 4)
                columns = [distinct.view(np.int64), p[at].view(np.int64), v[at], *n.T]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["hash", "parent", "level", "n0", "n1", "n2", "n3"])

    names = ", ".join(f"{c} long" for c in ("hash", "parent", "level", "n0", "n1", "n2", "n3"))
    seen = rows.select("text", "half", "toxic").mapInArrow(run, names).groupBy("hash").agg(F.min("parent").alias("parent"), F.max("level").alias("level"), *(F.sum(f"n{i}").alias(f"n{i}") for i in range(4)))
    return seen.withColumn("n", F.col("n0") + F.col("n1") + F.col("n2") + F.col("n3")).where(F.col("n") >= LEAST_DOCS)


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> Model:
    """Fits on labelled documents outside the held-out fold, about `most`, those of the lowest hash."""
    labels = labels.where(F.col("toxic").isNotNull() & (fold(F.col("doc_id"), 4) != 2)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).distinct()
    labels = stored(drawn(labels, "doc_id", labels.count(), most, 31).withColumn("half", F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(2))), "labels")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(labels.select("doc_id").distinct()), "doc_id", "left_semi")  # about MOST_ROWS ids
    rows = texts.groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")).join(F.broadcast(labels), "doc_id")
    rows = stored(rows.select("text", "half", "toxic"), "sample")
    size = {(r.half, r.toxic): r.n for r in rows.groupBy("half", "toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = (sum(n for (_, y), n in size.items() if (y == 1) == t) for t in (True, False))
    if not toxic or not clean:
        share = (toxic + 1) / (toxic + clean + 2) if toxic + clean else 0.5
        return Model(logistic=(float(np.log(share / (1 - share))), 0.0))
    seen = _counted(rows.withColumn("toxic", (F.col("toxic") == 1).cast("int")))
    seen = stored(seen, "tokens")
    bar = 0
    if seen.count() > MOST_TOKENS:  # the most frequent, by the counts' own distribution; ties at the bar go together
        left = 0
        for r in sorted(seen.groupBy("n").agg(F.count("*").alias("c")).collect(), reverse=True):
            left += r.c
            bar = r.n + 1 if left > MOST_TOKENS else bar
            if bar:
                break
    pdf = seen.where(F.col("n") >= bar).toPandas().sort_values("hash")
    h, p = (pdf[c].to_numpy(np.int64).view(np.uint64) for c in ("hash", "parent"))
    level, n = pdf.level.to_numpy(), pdf[["n0", "n1", "n2", "n3"]].to_numpy(float)
    place = np.argsort(h)

    def model(halves: tuple[int, ...]) -> Model:
        y, x = (sum(n[:, 2 * i + c] for i in halves) for c in (1, 0))
        totals = y[level == 0].sum(), x[level == 0].sum()
        return Model(h[place], odds(h, p, level, y, x, totals)[place])

    crossed = (model((1,)), model((0,)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                whole, stems, _, _, counts = tokens_of(piece.column("text"))
                half = piece.column("half").to_pylist()
                both = [m.of(whole, stems, counts) for m in crossed]
                found = [[s for _, _, s in segments(both[k][a:b])] for k, a, b in zip(half, counts[:-1], counts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([piece.column("toxic"), pa.array(np.diff(counts)), pa.array([sorted(f, reverse=True)[:64] for f in found], pa.list_(pa.float64()))], ["toxic", "tokens", "sums"])

    told = rows.mapInArrow(run, "toxic int, tokens long, sums array<double>").toPandas()
    y = (told.toxic == 1).to_numpy(float)
    tokens = told.tokens.to_numpy()
    best = np.array([s[0] if len(s) else 0.0 for s in told.sums])
    full = model((0, 1))
    full.rate, full.size = fitted_law(best[y == 0], tokens[y == 0])
    totals = np.array([sum(max(full.excess(x, t), 0.0) for x in s) for s, t in zip(told.sums, tokens, strict=True)])
    full.logistic = fitted_logistic(np.log1p(totals), y)
    return full


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted and how many significant passages each document has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                whole, stems, _, _, counts = tokens_of(piece.column("text"))
                values, out = model.of(whole, stems, counts), []
                for a, b in zip(counts[:-1], counts[1:], strict=True):
                    total, found = model.judged(segments(values[a:b]), b - a)
                    score = model.score(total)
                    out.append((score, int(score >= THRESHOLD), len(found)))
                score, predicted, n = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(score), pa.array(predicted, pa.int32()), pa.array(n, pa.int64())], ["doc_id", "score", "predicted", "n_passages"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int, n_passages long")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted", "n_passages")


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """Every significant toxic passage: doc_id, first and end token, its sum, its probability in clean texts, and its words in lower case."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                whole, stems, start, length, counts = tokens_of(piece.column("text"))
                values, out = model.of(whole, stems, counts), []
                for i, (doc, text) in enumerate(zip(piece.column("doc_id").to_pylist(), pc.utf8_lower(piece.column("text")).to_pylist(), strict=True)):
                    a, b = counts[i], counts[i + 1]
                    for first, end, s, p in model.judged(segments(values[a:b]), b - a)[1]:
                        cut = (text or "").encode()[start[a + first] : start[a + end - 1] + length[a + end - 1]]
                        out.append((doc, int(first), int(end), float(s), p, cut.decode()))
                columns = list(zip(*out, strict=True)) or [()] * 6
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "first", "end", "sum", "chance", "passage"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, first long, end long, sum double, chance double, passage string")


def op12_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, train(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op12_toxic_segments": op12_toxic_segments}
SQL: dict[str, str] = {}
