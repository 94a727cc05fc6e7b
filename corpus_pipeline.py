"""Corpus pipeline: documents in, packed pieces out. Each stage's rows are written and read again by the next.

Rejected documents go, one of each group of near copies stays, personal data is replaced in the texts, documents are put
in the order of the mix, and the mix is packed in that order: sequence ids follow it, by groups of sequences. Null and empty texts pass through as documents; equal doc_ids are each
judged; an empty table gives no rows; columns beyond those of documents are carried up to the packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybrook.llm import chosen_path, mixing, packing, pii, quality
from tallybrook.llm._base import stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chosen_path.one_of_each(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.reordered(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # files are not read in the order they were written: the slots, which follow from the rows, are laid out anew
    return packing.pack_documents(mixing.reordered(docs.select("doc_id", "source", "text")))


STAGES = [("quality classifier", keep_good), ("n-gram Jaccard join", keep_one), ("PII", redact), ("mixing", mix), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs


#: Not expressible: learned models, sampled recursion and a tokenizer.
ORACLE_SQL = None
