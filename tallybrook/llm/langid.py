"""Language ID (operator 10): sparse multinomial logistic regression on TF-IDF character n-grams.

Lower-cased texts are cut into n-grams of one to three characters, hashed to BUCKETS buckets; a text's value in a bucket
is SCALE times the bucket's share of the text's n-grams, times its inverse document frequency, counted over all learning documents.
Weights are learnt by follow-the-regularised-leader with L1 and L2 penalties, then one temperature is fitted on a tenth
of the sample that training left out.

Fitted on about MOST_A_LANG documents of each language, those of the lowest hash, and about MOST_ROWS in all; the frequencies and the
predictions cover every document. lang, source and doc_id are never inputs of a prediction. A model tells MOST_LANGS languages
apart. Where there are more, the most frequent ones (of equally many, the first by name) share a model with one class for all
others, which a next model tells apart in the same way, and so on: each language has its class, and a model's size is bounded.

Cases: a text that is null or has no letter is `und` with score 0; very long texts are read whole; of equally likely
languages the first by name counts; with no learning rows every text is `und`; equal
doc_ids are predicted each; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._base import fold, pieces, table

BUCKETS, SCALE = 1 << 14, 20.0
MOST_A_LANG, MOST_LANGS, MOST_ROWS, EPOCHS = 1000, 500, 40_000, 3
#: The class of all languages of the models after this one.
OTHERS = "\0others"
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.002
NONE = "und"
GAP = 2


def grams_of(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets of the 1-, 2- and 3-grams that begin at each place of the joined texts, and where each text begins there.

    Texts stand GAP zeros apart, so no n-gram has characters of two texts."""
    lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    size = pc.utf8_length(lower).to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(size + GAP)])
    code = np.frombuffer(("\0" * GAP).join([*lower.to_pylist(), ""]).encode("utf-32-le", "replace"), np.uint32)
    mul, shift = np.uint32(0x9E3779B1), np.uint32(32 - BUCKETS.bit_length() + 1)
    one = code * mul
    two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + one[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(0xC2B2AE3D) + one[2:]
    out = []
    for k, h in enumerate((one, two, three)):
        h = ((h ^ (h >> np.uint32(16))) * np.uint32(0x7FEB352D + 2 * k)) >> shift
        out.append(np.append(h, np.zeros(k, np.uint32)))
    return out, at


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # (BUCKETS, langs), with the inverse document frequencies multiplied in
    bias: np.ndarray
    temperature: float = 1.0
    rest: Model | None = None

    def logits(self, texts: pa.Array) -> np.ndarray:
        grams, at = grams_of(texts)
        n = np.diff(at) - GAP
        bounds = np.stack([at[:-1], at[1:] - GAP], 1).ravel()
        out = np.empty((len(n), len(self.langs)))
        for c in range(len(self.langs)):
            w = np.ascontiguousarray(self.weights[:, c], np.float32)
            value = w[grams[0]]
            value += w[grams[1]]
            value += w[grams[2]]
            sums = np.add.reduceat(value, bounds, dtype=np.float64)[::2] if len(n) else np.empty(0)
            out[:, c] = SCALE * np.where(n > 0, sums, 0) / (3 * np.maximum(n, 1)) + self.bias[c]
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not self.langs:
            return [NONE] * len(texts), np.zeros(len(texts))
        p = _softmax(self.logits(texts) / self.temperature)
        best = p.argmax(1)
        names, score = [self.langs[b] if ok else NONE for b, ok in zip(best, letters, strict=True)], np.where(letters, p.max(1), 0.0)
        if self.rest is not None:
            further = [i for i, name in enumerate(names) if name == OTHERS]
            if further:
                told, sure = self.rest.predict(texts.take(pa.array(further)))
                score[further] *= sure
                for i, name in zip(further, told, strict=True):
                    names[i] = name
        return names, score


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def sparse(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and their shares of each text."""
    grams, at = grams_of(texts)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        own = np.sort(np.concatenate([g[a : max(a, b - GAP)] for g in grams]))
        first = np.flatnonzero(np.diff(own, prepend=own[:1] + 1))  # whatever stands before the first differs from it
        yield own[first].astype(np.int64), np.diff(first, append=len(own)) / max(3 * (b - GAP - a), 1)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_langs: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Follow-the-regularised-leader, each bucket with a step size of its own; rows in the order given."""
    z, n = np.zeros((BUCKETS + 1, n_langs)), np.zeros((BUCKETS + 1, n_langs))

    def weights(at: np.ndarray) -> np.ndarray:
        zz = z[at]
        return np.where(np.abs(zz) <= L1, 0.0, -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for (idx, val), label in zip(rows, y, strict=True):
            at, x = np.append(idx, BUCKETS), np.append(val, 1.0)
            w = weights(at)
            p = _softmax(x @ w)
            p[label] -= 1
            g = x[:, None] * p[None]
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    w = weights(np.arange(BUCKETS + 1))
    return w[:-1], w[-1]


def temperature_of(logits: np.ndarray, y: np.ndarray) -> float:
    if not len(y):
        return 1.0
    options = np.exp(np.linspace(np.log(0.05), np.log(5), 60))
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in options]
    return float(options[int(np.argmin(loss))])


def train(docs: DataFrame, most_a_lang: int = MOST_A_LANG) -> Model:
    docs = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.coalesce(fold(F.col("doc_id"), 4), F.lit(0)) != 2)).select("doc_id", "text", "lang")
    counts = docs.groupBy("lang").agg(F.count("*").alias("n"))
    total = counts.count()
    if not total:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                for idx, _ in sparse(piece.column("text")):
                    total[idx] += 1
                    n += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(BUCKETS), -1)), pa.array(np.append(total, n))], ["bucket", "docs"])

    df = docs.select("text").mapInArrow(frequencies, "bucket long, docs long").groupBy("bucket").agg(F.sum("docs").alias("docs")).toPandas()
    seen = np.zeros(BUCKETS + 1)
    seen[df.bucket.to_numpy()] = df.docs.to_numpy()
    idf = np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1

    models: list[Model] = []
    left, n = docs, total
    while n:
        own = MOST_LANGS if n <= MOST_LANGS else MOST_LANGS - 1
        top = counts.orderBy(F.desc("n"), "lang").limit(own).collect()
        sizes = {r.lang: r.n for r in top}
        n -= len(sizes)
        held = F.broadcast(docs.sparkSession.createDataFrame(list(sizes.items()), "lang string, _n long"))
        counts = counts.join(held, "lang", "left_anti")
        known = left.join(held, "lang")
        if n:
            left = left.join(held, "lang", "left_anti")
            sizes[OTHERS] = counts.agg(F.sum("n")).first()[0]
            known = known.unionByName(left.select("doc_id", "text", F.lit(OTHERS).alias("lang"), F.lit(sizes[OTHERS]).alias("_n")))
        models.append(_trained(known, sorted(sizes), min(most_a_lang, max(1, MOST_ROWS // len(sizes))), idf))
    for a, b in zip(models, models[1:], strict=False):
        a.rest = b
    return models[0]


def _trained(docs: DataFrame, langs: list[str], most_a_lang: int, idf: np.ndarray) -> Model:
    """One model; docs: doc_id, text, lang and how many documents the language has."""
    draw = F.pmod(F.xxhash64(F.lit(11), "doc_id", "text"), F.lit(1_000_000)) / 1_000_000
    picked = docs.where(draw < F.lit(float(most_a_lang)) / F.col("_n"))

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = list(sparse(piece.column("text")))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id").cast(pa.int64()), piece.column("lang"), pa.array([i.astype(np.uint16).tobytes() for i, _ in found], pa.binary()), pa.array([v.astype(np.float32).tobytes() for _, v in found], pa.binary())], ["doc_id", "lang", "idx", "val"])

    rows = picked.mapInArrow(shares, "doc_id long, lang string, idx binary, val binary").toPandas()
    rows = rows.sort_values(["doc_id", "lang", "idx"]).sample(frac=1, random_state=7)  # languages must not come in runs
    number = {lang: k for k, lang in enumerate(langs)}
    y = rows.lang.map(number).to_numpy()
    data = [(i := np.frombuffer(a, np.uint16).astype(np.int64), SCALE * np.frombuffer(v, np.float32) * idf[i]) for a, v in zip(rows.idx, rows.val, strict=True)]
    aside = np.arange(len(y)) % 10 == 9
    w, bias = fit([d for d, a in zip(data, aside, strict=True) if not a], y[~aside], len(langs))
    logits = np.array([v @ w[i] + bias for (i, v), a in zip(data, aside, strict=True) if a]).reshape(-1, len(langs))
    return Model(langs, w * idf[:, None], bias, temperature_of(logits, y[aside]))


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                lang, score = model.predict(piece.column("text"))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id").cast(pa.int64()), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_ngram_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predicted(docs, train(docs))


QUERIES = {"op10_ngram_langid": op10_ngram_langid}
SQL: dict[str, str] = {}
