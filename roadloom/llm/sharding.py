"""Sharding by rendezvous hashing over weighted shards.

A record's shard is the one with the highest score -weight / ln(u), where u in
(0, 1) comes from a hash of the record's key and the shard's number. A new
shard takes records only into itself; a removed one gives away its own only.

Everything is column expressions. Slots (gapless places within a shard) come
from two levels: rows are numbered within (shard, bucket) and lifted by the
number of rows in the shard's earlier buckets, so that no task orders a whole
shard. A bucket comes from a hash of key and content. The table of bucket counts has shards x buckets rows at most.

Defined cases: a null key is the key ''; a null text has no bytes and CRC 0;
repeated rows get the same shard and different slots; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets are named by this many digits of a hash: 16 ** 2 of them.
BUCKET_DIGITS = 2


def unit_hash(*parts: Column) -> Column:
    """A double in (0, 1) from the first 52 bits of the MD5 of the parts, joined by ':'."""
    head = F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double")
    return (head + 0.5) / F.lit(float(2**52))


def rendezvous(key: Column, weights: list[float], among: list[Column] | None = None) -> Column:
    """The number (from 0) of the shard with the highest score; a tie goes to the lower number. ``among`` leaves only some shards in the contest.

    With equal weights the scores' order is the order of the hashes, so those
    are compared as they are.
    """
    name = F.coalesce(key.cast("string"), F.lit(""))
    if len(set(weights)) == 1:
        scores = [F.struct(F.substring(F.md5(F.concat_ws(":", name, i.cast("string"))), 1, 13).alias("s"), (-i).alias("i")) for i in among or map(F.lit, range(len(weights)))]
    else:
        weight = lambda i: F.element_at(F.lit([float(w) for w in weights]), i + 1)
        some = among or [F.lit(i) for i, w in enumerate(weights) if w > 0]
        scores = [F.struct((-weight(i) / F.log(unit_hash(name, i.cast("string")))).alias("s"), (-i).alias("i")) for i in some]
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return (-best["i"]).cast("int")


def slots(rows: DataFrame, shard: str, order: list[str], digits: int = BUCKET_DIGITS) -> DataFrame:
    """Adds ``slot``: gapless places from 0 within each shard, ordered by bucket and then by ``order``."""
    spread = rows.withColumn("_bucket", F.substring(F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in order[:2]])), 1, digits))
    counts = spread.groupBy(shard, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    lifted = counts.select(F.col(shard).alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_lift"))
    inside = F.row_number().over(Window.partitionBy(shard, "_bucket").orderBy(*order)) - 1
    ranked = spread.withColumn("_rank", inside)
    joined = ranked.join(F.broadcast(lifted), (F.col(shard) == F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    return joined.withColumn("slot", (F.col("_rank") + F.col("_lift")).cast("long")).drop("_bucket", "_s", "_b", "_rank", "_lift")


def shard_documents(docs: DataFrame, weights: list[float], grown: list[float] | None = None, digits: int = BUCKET_DIGITS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, grown_shard: ``grown`` are the weights after a change of the shard count."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = rows.withColumn("shard", rendezvous(F.col("doc_id"), weights))
    after = F.lit(None).cast("int") if not grown else rendezvous(F.col("doc_id"), grown)
    if grown and grown[: len(weights)] == weights:
        # The old shards' scores stand, so only the old winner and the new shards are compared.
        after = rendezvous(F.col("doc_id"), grown, [F.col("shard"), *map(F.lit, range(len(weights), len(grown)))])
    placed = slots(rows, "shard", ["doc_id", "text_crc32", "size"], digits)
    return placed.withColumn("grown_shard", after)
