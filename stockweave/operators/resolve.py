"""Identifier resolution: every channel's product id to one master SKU.

The whole ladder (declared type, ten fallback types, style level) is folded
into one lookup row per identifier value, so a fact table of any size meets it
in exactly one equi-join. Catalyst broadcasts the lookup when its size allows;
otherwise AQE splits the partitions of identifiers that are hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stockweave import schemas as S
from stockweave.functions.text import norm_id
from stockweave.operators.dedup import keep_first

NO_MATCH = "identifier not present in master mapping table"


def spread_nulls(key: str | Column, *spread: str, ways: int = 4096) -> Column:
    """A join key that scatters null keys: they can match nothing, wherever they go.

    Without it all rows with a null key hash to the same task. The masked hash
    makes the key provably non-null, so no null test is pushed below the join,
    where it would evaluate the key expression a second time. ``ways`` is a
    power of two.
    """
    k = F.col(key) if isinstance(key, str) else key
    bucket = F.xxhash64(*spread).bitwiseAND(F.lit(ways - 1))
    return F.coalesce(k, F.concat(F.lit("\u0001null-"), bucket.cast("string")))


def id_text(df: DataFrame, column: str) -> Column:
    """Identifier text; numeric identifiers lose their fraction."""
    if df.schema[column].dataType.simpleString() in ("float", "double") or df.schema[
        column
    ].dataType.simpleString().startswith("decimal"):
        return F.col(f"`{column}`").cast("decimal(38,0)").cast("string")
    return F.col(f"`{column}`").cast("string")


def _exploded_ids(master: DataFrame, id_columns: dict[str, str], row_order: str, attribute_names=()) -> DataFrame:
    """One row per identifier a master row carries; null ones are dropped."""
    present = {c: t for c, t in id_columns.items() if c in master.columns}
    ids = F.array(*[
        F.struct(F.lit(kind).alias("identifier_type"), norm_id(id_text(master, column)).alias("identifier_value"))
        for column, kind in present.items()
    ])
    return master.select(
        F.explode(ids).alias("id"),
        norm_id("Sku Code").alias("master_sku"),
        norm_id("Item Name").alias("style_code"),
        F.col(row_order).alias("row_seq"),
        *attribute_names,
    ).select("id.*", "master_sku", "style_code", "row_seq", *attribute_names).filter(
        "identifier_value is not null and master_sku is not null"
    )


def build_bridge(
    master: DataFrame,
    id_columns: dict[str, str] = S.MASTER_ID_COLUMNS,
    row_order: str = "row_seq"
) -> DataFrame:
    """Wide master to (identifier_type, identifier_value, master_sku, style_code, row_seq).

    One explode instead of one scan per id column; the first master row wins
    per (type, value, sku).
    """
    long = _exploded_ids(master, id_columns, row_order)
    return long.groupBy("identifier_type", "identifier_value", "master_sku").agg(
        F.min_by("style_code", "row_seq").alias("style_code"), F.min("row_seq").alias("row_seq")
    )


def build_lookup(
    master: DataFrame,
    id_columns: dict[str, str] = S.MASTER_ID_COLUMNS,
    fallback: Sequence[str] = S.FALLBACK_ID_TYPES,
    row_order: str = "row_seq",
    attributes: DataFrame | None = None,
    attribute_names: Sequence[str] = ()
) -> DataFrame:
    """One row per identifier value with everything a fact row may need.

    ``by_type``  hit per identifier type (16 entries at most),
    ``fallback`` the hit of the first type in the fallback order,
    ``is_style`` whether the value names a style.

    A single aggregation on the value does it all: per type the earliest master
    row, merged map-side, so a placeholder id shared by many rows stays cheap.
    SKU attributes such as the list price ride along in the hit, which saves
    the fact table a second join.
    """
    rows = master
    if attributes is not None:
        keyed = attributes.select(F.col("master_sku").alias("_sku"), *attribute_names)
        # The key is a column of its own: a join condition must not normalise text itself.
        rows = rows.withColumn("_own", norm_id("Sku Code")).join(keyed, F.col("_own") == F.col("_sku"), "left").drop("_own", "_sku")
    long = _exploded_ids(rows, id_columns, row_order, attribute_names)
    kinds = [t for c, t in id_columns.items() if c in master.columns and t != "style_code"]
    hit = F.struct("master_sku", "style_code", *attribute_names)
    found = long.groupBy("identifier_value").agg(
        *[F.min_by(hit, F.when(F.col("identifier_type") == t, F.col("row_seq"))).alias(f"hit_{t}") for t in kinds],
        F.bool_or(F.col("identifier_type") == "style_code").alias("is_style"),
    )
    entry = [
        F.when(F.col(f"hit_{t}").isNotNull(), F.struct(F.lit(t).alias("identifier_type"), F.col(f"hit_{t}").alias("hit")))
        for t in fallback if t in kinds
    ]
    return found.select(
        "identifier_value",
        F.map_from_arrays(F.array(*[F.lit(t) for t in kinds]), F.array(*[F.col(f"hit_{t}") for t in kinds])).alias("by_type"),
        F.coalesce(*entry).alias("fallback"),
        "is_style",
    )


def resolve(
    facts: DataFrame,
    lookup: DataFrame,
    attribute_names: Sequence[str] = (),
    id_column: str = "external_id",
    type_column: str = "external_id_type"
) -> DataFrame:
    """Add matched_via, master_sku, style_code; always one row out per row in."""
    left = facts.withColumn(id_column, norm_id(id_column))
    spread = [c for c in left.columns if c.startswith(("qty", "period", "source", "location"))] or left.columns[:3]
    left = left.withColumn("_key", spread_nulls(id_column, *spread))
    # One lookup row per value: a partition's share of it fits a hash table, so the facts, far more rows, are not sorted.
    joined = left.join(lookup.hint("shuffle_hash"), F.col("_key") == F.col("identifier_value"), "left")
    declared = F.try_element_at(F.col("by_type"), F.col(type_column))
    ladder = F.col("fallback.hit")
    style_hit = F.col("is_style") & declared.isNull() & ladder.isNull()
    via = (
        F.when(declared.isNotNull(), F.col(type_column))
        .when(ladder.isNotNull(), F.col("fallback.identifier_type"))
        .when(style_hit, F.lit("style_code"))
    )
    hit = F.coalesce(declared, ladder)
    drop = {"_key", "identifier_value", "by_type", "fallback", "is_style", "matched_via", "master_sku", "style_code"}
    kept = [F.col(c) for c in facts.columns if c not in drop | {id_column}]
    return joined.select(
        *kept, id_column,
        via.alias("matched_via"),
        hit["master_sku"].alias("master_sku"),
        F.when(style_hit, F.col("identifier_value")).otherwise(hit["style_code"]).alias("style_code"),
        *[hit[a].alias(a) for a in attribute_names],
    )


def unresolved(resolved: DataFrame, qty: str, value: str) -> DataFrame:
    """Rows no ladder step could place; a null identifier is one of them."""
    return resolved.filter("matched_via is null").select(
        "source_file", "external_id", F.col("external_id_type").alias("declared_id_type"),
        F.lit(NO_MATCH).alias("reason"), F.col(qty).alias("qty"), F.col(value).alias("value"),
    )


def load_master(raw: DataFrame, row_order: str = "row_seq") -> tuple[DataFrame, DataFrame]:
    """(master, duplicated SKUs): the first row of each SKU is the one kept."""
    keyed = raw.withColumn("Sku Code", norm_id("Sku Code"))
    if "Item Name" in raw.columns:
        keyed = keyed.withColumn("Item Name", norm_id("Item Name"))
    keyed = keyed.filter("`Sku Code` is not null")
    copies = keyed.groupBy("Sku Code").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    return keep_first(keyed, ["Sku Code"], [row_order]), copies
