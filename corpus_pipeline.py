"""The corpus pipeline: five stages over ``documents``, each written before the next reads it.

language: documents whose language is rejected go. near_duplicates: one of each
group stays. decontamination: documents that hold a window of a benchmark item
go. secrets: what looks like a credential is masked in the text. tokens: each
text becomes byte-level BPE ids, checked by decoding. All stages but the last
return the columns of ``documents``; nulls, empty tables and extra columns are
treated as the operators' docstrings say, and extra columns are carried along.
Each stage first has the executors give back the heap that the one before grew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, langid, minhash, secrets
from tessera.llm.common import Scratch, collect_heaps, read_table
from tessera.llm.queries import vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model learns from the training folds of the documents it gets."""
    collect_heaps(spark)
    return langid.keep_known(docs, langid.fit(langid.training(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    collect_heaps(spark)
    return minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A training document that holds a window of even one item is affected; the
    two items of op10's column ``contaminated`` are the bound of that report."""
    collect_heaps(spark)
    return decontaminate.remove(docs, read_table(spark, sf_dir, "benchmark"), least_items=1)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    collect_heaps(spark)
    return secrets.mask(docs, "text", "n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, ids, n_tokens, round_trip): ids as little-endian
    unsigned 32-bit integers; round_trip says that they decode to the text."""
    collect_heaps(spark)
    made = bpe.encoded(docs.select("doc_id", "lang", "source", "text"), *vocabulary())
    return made.select("doc_id", "lang", "source", "ids", (F.length("ids") / 4).cast("long").alias("n_tokens"), "round_trip")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secret_scan),
    ("tokens", tokens),
]

#: Languages are told and tokens made by models, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scratch, before = Scratch(spark, "pipeline"), None
    for _, stage in STAGES:
        docs, path = scratch.write(stage(spark, docs, sf_dir))
        if before:
            scratch.drop(before)
        before = path
    return docs
