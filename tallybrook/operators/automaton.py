"""Many keywords in long texts by one automaton: each text is read once, whatever the number of keywords.

The keywords' first characters form a trie with failure links (a library's), which goes to the tasks with the keywords; where
it ends, the rest of the keyword is compared in place. A text is not copied for places that do not match.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: First characters of a keyword that are in the automaton.
HEAD = 24
#: Bytes of keywords that one pass over the texts takes; more keywords are more passes.
MOST_OCTETS = 1 << 24


def built(words: list[str]):
    """The automaton over the heads of words, each with the places of its words."""
    import ahocorasick

    heads: dict[str, list[int]] = {}
    for i, word in enumerate(words):
        heads.setdefault(word[:HEAD], []).append(i)
    found = ahocorasick.Automaton()
    for head, places in heads.items():
        found.add_word(head, (len(head), places))
    found.make_automaton()
    return found


def begins(text: str, at: int) -> bool:
    """Whether no ASCII letter or digit stands left of the place."""
    return at == 0 or not (text[at - 1].isascii() and text[at - 1].isalnum())


def hits(df: DataFrame, text: str, words: DataFrame, word: str, bounded: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Rows of df (its columns, or those to `keep`) with each distinct word that their text holds, as column `word`.

    bounded: a boolean column of words that must not follow an ASCII letter or digit. Null and empty words are in no text.
    The words are counted by bytes first and collected in groups of MOST_OCTETS, each of which is one pass over the texts.
    """
    flag = F.coalesce(F.col(bounded), F.lit(False)) if bounded else F.lit(False)
    each = words.where(F.col(word) != "").groupBy(F.col(word).alias("w"), flag.alias("b")).agg(F.octet_length(F.first(word)).alias("n"))
    groups = max(1, -(-(each.agg(F.sum("n")).first()[0] or 0) // MOST_OCTETS))
    keep = keep or df.columns
    schema = df.select(*keep, F.lit("").alias(word)).schema
    out = None
    for g in range(groups):
        mine = (each if groups == 1 else each.where(F.pmod(F.xxhash64("w"), F.lit(groups)) == g)).select("w", "b").collect()
        sent = df.sparkSession.sparkContext.broadcast(([r.w for r in mine], [r.b for r in mine]))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            parts, edges = sent.value
            machine = built(parts) if parts else None
            for batch in batches:
                rows, which = [], []
                for i, t in enumerate(batch.column(text).to_pylist()) if machine is not None else ():
                    if t:
                        seen = set()
                        for end, (size, places) in machine.iter(t):
                            at = end - size + 1
                            for p in places:
                                if parts[p] not in seen and (len(parts[p]) <= size or t.startswith(parts[p], at)) and (not edges[p] or begins(t, at)):
                                    seen.add(parts[p])
                        rows.extend([i] * len(seen))
                        which.extend(sorted(seen))
                kept = batch.select(keep).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(which, pa.string())], [*keep, word])

        found = df.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out
