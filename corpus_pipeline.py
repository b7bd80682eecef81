"""The corpus pipeline: a document table through five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept. All but the last return the columns of documents.

1. toxicity: documents that score as toxic go.
2. near_dedup: one document of each group of near-duplicates stays (five-word
   shingles, similarity 0.8; the least doc_id).
3. decontaminate: documents that hold a copy of a benchmark item go.
4. secrets: secrets in texts are replaced by their kind.
5. pack: tokenised documents packed into sequences.

Defined cases: a null or empty text is not toxic, no copy of anything and holds
no secret, so its row stays and is packed as the end token alone; very long texts
are worked on whole; of near-duplicates with equal standing the least doc_id
stays; rows that repeat a doc_id are one document and one row of them stays, rows
without doc_id are all kept; an empty table gives no sequences; further columns
pass through all stages but the last, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.llm import decontaminate, packing, secrets, toxicity
from roadloom.llm.base import cut, table, unused
from roadloom.llm.minhash import near_duplicates
from roadloom.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id isn't among ``ids``; rows without one stay."""
    name = unused(docs, "_gone")
    gone = ids.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lexicon = toxicity.learn(toxicity.fit_sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.reject(docs, lexicon)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = near_duplicates(docs, k=5, percent=80)
    kept = _without(docs, found.filter("not kept").select("doc_id"))
    # A doc_id that is there several times is one document.
    name = unused(docs, "_again")
    counts = docs.select("doc_id").groupBy("doc_id").agg(F.count("*").alias(name))
    again = counts.filter((F.col(name) > 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias(name))
    if again.isEmpty():
        return kept
    once = kept.join(again, F.col("doc_id") == F.col(name), "left_semi").dropDuplicates(["doc_id"])
    return kept.join(again, F.col("doc_id") == F.col(name), "left_anti").unionByName(once)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(spark, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("secrets", redact_secrets),
    ("pack", pack_sequences),
]

# Learned scores, signatures and tokens can't be written in SQL: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
