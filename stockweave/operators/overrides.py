"""Merchandiser notes: one table holds SKU notes and style notes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stockweave.functions.text import norm
from stockweave.operators.dedup import keep_first

NOTES = ("Style Re-order Status", "Reorder Status")


def split_overrides(raw: DataFrame, row_order: str = "row_seq") -> tuple[DataFrame, DataFrame]:
    """(by_sku, by_style): a row with a SKU speaks for it, any other for its style."""
    notes = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in NOTES]
    base = raw.select(
        F.coalesce(F.col("`Sku Code`"), F.lit("")).alias("sku"),
        F.coalesce(F.col("`Item Name`"), F.lit("")).alias("style"),
        *notes, F.col(row_order).alias("row_seq"),
    ).filter(" or ".join(f"trim(`{c}`) <> ''" for c in NOTES))

    def pick(column: str, keep) -> DataFrame:
        keyed = base.filter(keep).withColumn("key", norm(column)).filter("key is not null")
        return keep_first(keyed, ["key"], ["row_seq"]).select("key", *NOTES)

    has_sku = F.trim("sku") != ""
    return pick("sku", has_sku), pick("style", ~has_sku)


def apply_overrides(skus: DataFrame, by_sku: DataFrame, by_style: DataFrame) -> DataFrame:
    """SKU note wins; a blank one falls through to the style note."""
    own = by_sku.select(F.col("key").alias("_k1"), *[F.col(f"`{c}`").alias(f"_own{i}") for i, c in enumerate(NOTES)])
    style = by_style.select(F.col("key").alias("_k2"), *[F.col(f"`{c}`").alias(f"_sty{i}") for i, c in enumerate(NOTES)])
    joined = skus.join(own, F.col("Sku Code") == F.col("_k1"), "left").join(
        style, F.col("Item Name") == F.col("_k2"), "left"
    )
    return joined.withColumns({
        c: F.coalesce(F.nullif(F.col(f"_own{i}"), F.lit("")), F.col(f"_sty{i}"), F.lit(""))
        for i, c in enumerate(NOTES)
    }).drop("_k1", "_k2", *[f"_{p}{i}" for p in ("own", "sty") for i in range(len(NOTES))])


def lift_overrides(skus: DataFrame) -> DataFrame:
    """The most common SKU-level style note per style, ties to the smallest text.

    Counted per (style, note) first, so a huge style never sits in one task.
    """
    counts = (
        skus.filter("`Item Name` is not null and `Style Re-order Status` <> ''")
        .groupBy("Item Name", "Style Re-order Status")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("Item Name").agg(
        F.min_by("Style Re-order Status", F.struct(-F.col("n"), F.col("`Style Re-order Status`"))).alias("lifted_note")
    )
