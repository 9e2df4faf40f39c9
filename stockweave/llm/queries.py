"""Registered queries of the operators: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stockweave.llm import (
    fingerprints, jaccard, langid, licenses, mixing, negatives, phrases, pieces, quality, sharding, substrings, tokens, warc,
)
from stockweave.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_sharding(spark, sf):
    return sharding.shard(table(spark, sf, "documents"))


@query
def op2_mixing(spark, sf):
    return mixing.report(table(spark, sf, "documents"))


@query
def op8_quality(spark, sf):
    return quality.judge(table(spark, sf, "documents"))


@query
def op9_langid(spark, sf):
    return langid.identify(table(spark, sf, "documents"))


@query
def op10_sentencepiece(spark, sf):
    return pieces.round_trip(table(spark, sf, "documents"))


@query
def op4_warc(spark, sf):
    return warc.archived(table(spark, sf, "pages"))


@query
def op6_licenses(spark, sf):
    return licenses.scan(table(spark, sf, "documents"))


@query
def op3_substrings(spark, sf):
    return substrings.report(table(spark, sf, "documents"))


@query
def op5_jaccard(spark, sf):
    return jaccard.report(table(spark, sf, "documents"))


@query
def op7_fingerprints(spark, sf):
    return fingerprints.compare(table(spark, sf, "documents"))


@query
def op11_negatives(spark, sf):
    return negatives.report(table(spark, sf, "embeddings"))


@query
def op12_phrases(spark, sf):
    return phrases.report(table(spark, sf, "documents"))


@query
def op13_tokens(spark, sf):
    return tokens.count(table(spark, sf, "documents")).select("doc_id", "n_bytes", "n_tokens", "over_limit")
