"""Sharding: weighted rendezvous hashing of record keys.

Every shard scores a record from a hash of (key, shard) alone and the best
score wins, so a further shard can only take records into itself and all other
records stay. DataFrame functions only; the text never leaves its scan task.

Records equal in every result column are numbered as one row with a count, so
a key that many equal records share fills no slice of its own; a key with many
different texts is spread by their CRC.

Defined cases: a null key is a key like any other (all such records go to one
shard, still numbered in slices); equal keys share a shard; equal rows take
neighbouring slots; a null text has 0 bytes and CRC 0; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stockweave.llm import common as C

SHARDS = 24
ROW_OVERHEAD = 8


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the largest -weight / ln(u), u a hash of key and shard in (0, 1)."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    scores = [
        F.struct(
            (F.lit(-float(w)) / F.ln(C.unit(F.xxhash64(key, F.lit(s))) + F.lit(2.0**-54))).alias("score"),
            F.lit(s).alias("shard"),
        )
        for s, w in enumerate(weights)
    ]
    return F.greatest(*scores)["shard"] if len(scores) > 1 else F.lit(0)


def shard(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, grown_weight: float = 1.0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per record: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``slot`` numbers the records of a shard from 0 without gaps, ``grown_shard``
    is the shard after one more of ``grown_weight`` has been added.
    """
    spread = F.xxhash64(F.col(key), F.crc32(F.col(text)), F.lit("slot"))
    records = docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text)), F.lit(0)).cast("long").alias("text_crc32"),
        rendezvous(F.col(key), weights).alias("shard"),
        rendezvous(F.col(key), [*weights, grown_weight]).alias("grown_shard"),
        spread.alias("__spread"),
    )
    rows = C.staged(records.groupBy(*records.columns).agg(F.count(F.lit(1)).alias("__copies")), "shards")
    sliced = C.slices(rows.withColumn("__at", C.unit(F.col("__spread"))), "shard", "__at")
    starts = C.slice_starts(sliced, "shard", F.col("__copies"))
    order = ["__at", "__spread", "doc_id", "text_crc32", "size"]
    numbered = C.running(sliced, starts, "shard", order, F.col("__copies"), "__upto")
    # Numbers within a run of copies are counted down from its end, in blocks that other tasks can take.
    return C.repeated(numbered, "__copies", "__nth").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("__upto") - 1 - F.col("__nth")).alias("slot"), "grown_shard"
    )
