"""The corpus pipeline over ``documents``: language, near copies, repeated passages, source mix, piece ids.

Every stage works on all that the one before it kept, and its result is
written as Parquet and read again as the next one's ``docs``. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockweave.llm import jaccard, langid, mixing, pieces, substrings
from stockweave.llm.common import collected, discard, staged, table

_STAGED: list[str] = []


def stage(function):
    """Drop the tables staged by the stage before, whose result is written by now; note those of this one."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _STAGED)
        with collected() as made:
            out = function(spark, docs, sf_dir)
        _STAGED[:] = made
        return out

    return run_stage


@stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents but those of undetermined language: only a null text or one without letters goes."""
    return langid.accepted(docs)


@stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group linked at 0.8 on shingles of five words."""
    return jaccard.one_of_each(docs, k=5, percent=80)


@stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand elsewhere too; only changed texts get a new n_chars."""
    before = docs.withColumn("__before", F.xxhash64("text"))
    after = substrings.deduplicated(before).withColumn("__same", F.xxhash64("text") == F.col("__before"))
    return after.withColumn("n_chars", F.when(F.col("__same"), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))).select(
        *docs.columns
    )


@stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


@stage
def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and whether decoding the ids gives the text back."""
    rows = docs.select("doc_id", "lang", "source", F.xxhash64("text").alias("__before"), F.col("text").alias("__in"))
    back = pieces.encode(rows, text="__in", decoded="__out")
    return back.select(
        "doc_id", "lang", "source", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids",
        (F.col("__before") == F.xxhash64("__out")).alias("round_trip"),
    )


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_copies),
    ("substring dedup", repeated_passages),
    ("mixing sources", source_mix),
    ("SentencePiece", piece_ids),
]

#: SQL expresses neither the language models nor the piece encoder; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = staged(step(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
