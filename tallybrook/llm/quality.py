"""Quality classifier (operator 4): a generalised additive model with pairwise interactions.

Each text becomes a few numbers (shares of capitals, symbols, repeated words and so on), each number a bin. Training goes
round the features again and again: a shallow tree on the one feature's bins takes a small step against the current error
and is added to that feature's lookup table; then the pairs that explain most of what is left get tables of their own in
the same way. A score is the logistic of the sum of the tables' entries.

The model is fitted on about MOST_ROWS labelled rows, those of the lowest hash; scoring covers every row. Labels, lang,
source and doc_id are never inputs of a score.

Cases: null and empty texts have all numbers 0 and are scored like any; very long texts are described whole; of cuts with equal gain the first counts; equal doc_ids are scored each, and the smallest of
their texts is learnt from; with no labelled
rows every score is 0.5; an empty table gives no rows; other columns play no part in scores and are kept by `kept`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._base import SPACE, bytes_of, drawn, fold, pieces, stored, table, words_of

MOST_ROWS = 40_000
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, STEP, RIDGE = 48, 8, 6, 120, 60, 0.15, 4.0
THRESHOLD = 0.3
FEATURES = ["log_words", "word_length", "capitals", "shouted", "symbols", "log_symbols", "pipes", "bangs", "digits", "repeats", "log_repeats", "distinct", "stops", "lines", "long_words", "non_ascii"]
CLASSES = 9


def _classes() -> np.ndarray:
    kind = np.zeros(256, np.uint8)
    kind[[*range(ord("a"), ord("z") + 1)]] = 1
    kind[[*range(ord("A"), ord("Z") + 1)]] = 2
    kind[[*range(ord("0"), ord("9") + 1)]] = 3
    kind[[*b"#$%&*^~<>{}[]\\/=+_@"]] = 4
    kind[ord("|")] = 5
    kind[ord("!")] = 6
    kind[[*b".,;:?"]] = 7
    kind[128:] = 8
    return kind


KIND = _classes()


def features_of(texts: pa.Array) -> np.ndarray:
    """(rows, FEATURES); whole texts."""
    raw, off = bytes_of(texts)
    n = len(off) - 1
    kind = KIND[raw]
    doc = np.repeat(np.arange(n), np.diff(off))
    by = np.bincount(doc * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES).astype(float)
    total = np.maximum(by.sum(1), 1)
    letters = np.maximum(by[:, 1] + by[:, 2], 1)
    lines = np.bincount(doc[raw == 10], minlength=n)
    words, length, counts = words_of(raw, off)
    per = np.diff(counts)
    of = np.repeat(np.arange(n), per)
    most = np.maximum(per, 1)
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
    repeats = np.bincount(of[same], minlength=n)
    order = np.lexsort((words, of))
    w, o = words[order], of[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (o[1:] != o[:-1])
    distinct = np.bincount(o[new], minlength=n)
    inner = np.flatnonzero(~SPACE[raw])
    start = np.cumsum(length) - length
    if len(start):
        upper = np.add.reduceat((kind[inner] == 2).astype(np.int64), start)
        lower = np.add.reduceat((kind[inner] == 1).astype(np.int64), start)
        shouted = np.bincount(of[(upper >= 2) & (lower == 0)], minlength=n)
    else:
        shouted = np.zeros(n)
    symbols = by[:, 4] + by[:, 5]
    return np.stack([
        np.log1p(per), np.bincount(of, length, n) / most, by[:, 2] / letters, shouted / most, symbols / total, np.log1p(symbols), by[:, 5] / total, by[:, 6] / total,
        by[:, 3] / total, repeats / most, np.log1p(repeats), distinct / most, by[:, 7] / most, lines / most, np.bincount(of[length > 20], minlength=n) / most, by[:, 8] / total,
    ], 1)


@dataclass
class Additive:
    """Lookup tables: `edges` cut each feature into bins; a pair's table is over coarse bins of both."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            z += t[np.searchsorted(self.edges[j], x[:, j], "right")]
        for a, b, t in self.pairs:
            z += t[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-z))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _best(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins."""
    if len(g) < 2:
        return 0.0, 0
    a, b = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = a**2 / (b + RIDGE) + (g.sum() - a) ** 2 / (h.sum() - b + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
    """A tree of up to `leaves` leaves over a row of bins: its step for each bin."""
    cuts = [0, len(g)]
    for _ in range(leaves - 1):
        options = [(*_best(g[a:b], h[a:b]), a) for a, b in zip(cuts, cuts[1:], strict=False)]
        gain, k, a = max(options)
        if gain <= 1e-9:
            break
        cuts = sorted([*cuts, a + k])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:], strict=False):
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The better of cutting by rows, then each half by columns, or the other way round."""
    best = (-1.0, np.zeros_like(g))
    for turn in (False, True):
        p, q = (g.T, h.T) if turn else (g, h)
        _, k = _best(p.sum(1), q.sum(1))
        step, gain = np.zeros_like(p), 0.0
        for rows in (slice(0, k), slice(k, len(p))):
            u, v = p[rows].sum(0), q[rows].sum(0)
            step[rows] = _tree(u, v, 2)
            gain += max(0.0, -(step[rows][0] * u).sum()) if step[rows].size else 0.0
        if gain > best[0]:
            best = gain, step.T if turn else step
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    model = Additive(edges=[_edges(c, BINS) for c in x.T], coarse=[_edges(c, PAIR_BINS) for c in x.T])
    rate = (y.sum() + 1) / (len(y) + 2)
    model.base = float(np.log(rate / (1 - rate)))
    bins = [np.searchsorted(e, c, "right") for e, c in zip(model.edges, x.T, strict=True)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    z = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for j, b in enumerate(bins):
            g, h = slopes()
            step = STEP * _tree(np.bincount(b, g, len(model.tables[j])), np.bincount(b, h, len(model.tables[j])))
            model.tables[j] += step
            z += step[b]
    coarse = [np.searchsorted(e, c, "right") for e, c in zip(model.coarse, x.T, strict=True)]
    size = [len(e) + 1 for e in model.coarse]

    def grid(a: int, b: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[a] * size[b] + coarse[b], v, size[a] * size[b]).reshape(size[a], size[b])

    g, h = slopes()
    ranked = sorted(((_pair_tree(grid(a, b, g), grid(a, b, h))[0], a, b) for a in range(len(bins)) for b in range(a)), reverse=True)
    model.pairs = [(a, b, np.zeros((size[a], size[b]))) for _, a, b in ranked[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for a, b, t in model.pairs:
            g, h = slopes()
            step = STEP * _pair_tree(grid(a, b, g), grid(a, b, h))[1]
            t += step
            z += step[coarse[a], coarse[b]]
    return model


def featured(docs: DataFrame) -> DataFrame:
    """doc_id and f0.. of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                x = features_of(piece.column("text"))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id").cast(pa.int64()), *(pa.array(c) for c in x.T)], names)

    names = ["doc_id", *(f"f{j}" for j in range(len(FEATURES)))]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ", ".join(f"{n} {'long' if n == 'doc_id' else 'double'}" for n in names))


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> Additive:
    """Fits on labelled documents outside the held-out fold, about `most`, those of the lowest hash; only their texts are described."""
    labels = labels.where(F.col("quality").isNotNull() & (fold(F.col("doc_id"), 5) != 0)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    labels = labels.distinct()
    labels = stored(drawn(labels, "doc_id", labels.count(), most, 13), "labels")
    columns = [f"f{j}" for j in range(len(FEATURES))]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(labels.select("doc_id").distinct()), "doc_id", "left_semi")  # about MOST_ROWS ids
    rows = featured(texts.groupBy("doc_id").agg(F.min("text").alias("text"))).join(F.broadcast(labels), "doc_id").toPandas().sort_values(["doc_id", "quality", *columns])
    if not len(rows):
        return Additive()
    return fit(rows[columns].to_numpy(), (rows.quality == 1).to_numpy(float))


def scored(docs: DataFrame, model: Additive) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                score = model.scores(features_of(piece.column("text")))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], ["doc_id", "score", "predicted"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def kept(docs: DataFrame, model: Additive) -> DataFrame:
    """The rows of docs that the model does not reject, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                yield piece.filter(pa.array(model.scores(features_of(piece.column("text"))) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def op4_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, train(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op4_additive_quality": op4_additive_quality}
SQL: dict[str, str] = {}
