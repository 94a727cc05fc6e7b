"""The best entry of a corpus by the token-set ratio, scoring only pairs that can still win.

The score takes both texts as sets of words: 100 if one holds the other, else the best of the ratios between what they share,
with and without the rest of either. A ratio is 200 times the longest common subsequence over the sum of lengths.

Candidates are exact at LEAST_CUTOFF and above: a pair shares a word, or two neighbouring characters of its sorted words, or is
one of two and one of three characters that differ by the middle one. Counts of what is shared bound the score from above; pairs
bounded below the cutoff are never scored, and of the rest each text's most promising one is scored first, then those whose
bound reaches its score.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tallybrook.lineage import cut

#: Below it, texts without a shared word or bigram could be wanted.
LEAST_CUTOFF = 78.0


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for c in b:
        m = row & places.get(c, 0)
        row = ((row + m) | (row - m)) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    return 100.0 if not a and not b else 200.0 * _lcs(a, b) / (len(a) + len(b))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not left or not right):
        return 100.0
    base = " ".join(both)
    one, two = " ".join([*both, *left]), " ".join([*both, *right])
    scores = [indel_ratio(one, two)]
    if both:
        scores += [indel_ratio(base, one), indel_ratio(base, two)]
    return max(scores)


@F.pandas_udf(DoubleType())
def token_set_score(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else token_set_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def _words(text: Column) -> Column:
    """The distinct words in order, by the white space that Python's split knows."""
    space = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
    return F.array_sort(F.array_distinct(F.filter(F.split(text, space), lambda w: w != "")))


def _described(df: DataFrame, text: str, mark: str) -> DataFrame:
    """text, its words, their number and the length of all of them joined."""
    out = df.select(F.col(text).alias(mark), _words(F.col(text)).alias(f"{mark}_words")).where(F.size(f"{mark}_words") > 0)
    return out.withColumns({f"{mark}_n": F.size(f"{mark}_words"), f"{mark}_all": F.array_join(f"{mark}_words", " ")})


def _grams(df: DataFrame, mark: str) -> DataFrame:
    """(text, gram, how often) of neighbouring characters; three characters also give their first and last."""
    t = F.col(f"{mark}_all")
    n = F.char_length(t)
    pairs = F.when(n >= 2, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(t, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    pairs = F.when(n == 3, F.array_append(pairs, F.concat(F.substring(t, 1, 1), F.substring(t, 3, 1)))).otherwise(pairs)
    return df.select(mark, n.alias(f"{mark}_len"), F.explode(pairs).alias("gram")).groupBy(mark, f"{mark}_len", "gram").agg(F.count("*").alias(f"{mark}_c"))


def candidates(texts: DataFrame, names: DataFrame, text: str, name: str, cutoff: float) -> DataFrame:
    """(a, b, bound) of the distinct texts a and names b whose score may reach the cutoff. Both sides hold each value once."""
    x, y = _described(texts, text, "a"), _described(names, name, "b")
    least = cutoff / 100
    words = lambda df, m: df.select(m, F.explode(f"{m}_words").alias("word"))
    by_word = words(x, "a").join(words(y, "b"), "word").groupBy("a", "b").agg(F.count("*").alias("k"), F.sum(F.char_length("word")).alias("chars")).withColumn("shared", F.lit(0).cast("long"))
    near = 2 * F.least("a_len", "b_len") >= least * (F.col("a_len") + F.col("b_len"))
    by_gram = _grams(x, "a").join(_grams(y, "b"), "gram").where(near).groupBy("a", "b").agg(F.sum(F.least("a_c", "b_c")).alias("shared"))
    both = by_word.unionByName(by_gram.withColumns({"k": F.lit(0).cast("long"), "chars": F.lit(0).cast("long")}))
    both = both.groupBy("a", "b").agg(*(F.max(c).alias(c) for c in ("k", "chars", "shared")))
    both = both.join(x.select("a", "a_n", F.char_length("a_all").alias("a_len")), "a").join(y.select("b", "b_n", F.char_length("b_all").alias("b_len")), "b")
    k, base = F.col("k"), F.col("chars") + F.col("k") - 1
    one, two = F.col("a_len"), F.col("b_len")  # what is shared and the rest are all the words again
    total = (one + two).cast("double")
    # the shared words stand first in both; then the shorter rest may be a subsequence of the longer
    with_words = F.when((F.col("a_n") == k) | (F.col("b_n") == k), F.lit(100.0)).otherwise(F.greatest(200 * F.least(one, two) / total, 200 * base / (base + one), 200 * base / (base + two)))
    # each character that is in one text alone breaks three bigrams of both at most
    lost = F.greatest(F.abs(one - two).cast("double"), (total - 2 * F.col("shared") - 2) / 3)
    bound = F.when(k > 0, with_words).otherwise(100 * (1 - lost / total))
    return both.select("a", "b", bound.alias("bound")).where(F.col("bound") >= cutoff - 1e-9)


def scored(texts: DataFrame, corpus: DataFrame, text: str, name: str, seq: str, cutoff: float = LEAST_CUTOFF) -> DataFrame:
    """(a, b, seq, bound, score) of the pairs that had to be scored."""
    if cutoff < LEAST_CUTOFF:
        raise ValueError(f"the cutoff must be {LEAST_CUTOFF} or more")
    names = corpus.where(F.col(name).isNotNull()).groupBy(name).agg(F.min(seq).alias("seq"))
    pairs = candidates(texts.select(text).distinct(), names.select(name), text, name, cutoff)
    pairs = cut(pairs.join(names.select(F.col(name).alias("b"), "seq"), "b"))
    first = pairs.groupBy("a").agg(F.min_by(F.struct("b", "seq", "bound"), F.struct(-F.col("bound"), "seq")).alias("r")).select("a", "r.*")
    first = cut(first.withColumn("score", token_set_score("a", "b")))
    rest = pairs.join(first.select("a", F.col("b").alias("_b"), F.col("score").alias("_s")), "a").where((F.col("b") != F.col("_b")) & (F.col("bound") >= F.col("_s") - 1e-9)).drop("_b", "_s")
    return first.unionByName(rest.withColumn("score", token_set_score("a", "b")).select(first.columns))


def best(df: DataFrame, corpus: DataFrame, key: str, text: str, name: str, seq: str, cutoff: float = LEAST_CUTOFF) -> DataFrame:
    """(key, name, confidence: score / 100) of the best corpus entry at or over the cutoff; of equals, the first by seq."""
    won = scored(df.where(F.col(text).isNotNull()), corpus, text, name, seq, cutoff).where(F.col("score") >= cutoff)
    won = won.groupBy("a").agg(F.min_by(F.struct(F.col("b").alias(name), F.round(F.col("score") / 100, 3).alias("confidence")), F.struct(-F.col("score"), "seq")).alias("r"))
    return df.select(key, F.col(text).alias("a")).join(won, "a").select(key, "r.*")
