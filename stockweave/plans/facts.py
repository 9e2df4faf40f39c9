"""Adapter output to canonical fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stockweave import schemas as S
from stockweave.operators.facts import conform, map_ledger, value_basis
from stockweave.operators.resolve import build_lookup, resolve


def lookup_for(master: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """The resolve lookup, carrying the SKU list price when a price table is given."""
    if prices is None:
        return build_lookup(master)
    return build_lookup(master, attributes=prices, attribute_names=["mrp"])


def price_list(stock_rows: DataFrame, sku: str, price: str, row_order: str = "row_seq") -> DataFrame:
    """SKU to list price; of several rows for one SKU the last counts."""
    return (
        stock_rows.filter(F.col(sku).isNotNull())
        .groupBy(F.col(sku).alias("master_sku"))
        .agg(F.max_by(F.col(price), F.col(row_order)).alias("mrp"))
    )


def sales_rows(
    extract: DataFrame, lookup: DataFrame, channel_map: dict = S.CHANNEL_MAP
) -> DataFrame:
    """Extract rows with channel, flow, SKU and list price, before the value cascade."""
    placed = map_ledger(extract, channel_map) if "ledger" in extract.columns else extract
    priced = "mrp" in lookup.schema["fallback"].dataType["hit"].dataType.names
    out = resolve(placed, lookup, ["mrp"] if priced else [])
    return out if priced else out.withColumn("mrp", F.lit(None).cast("double"))


def fact_sales(
    extract: DataFrame, lookup: DataFrame, channel_map: dict = S.CHANNEL_MAP
) -> DataFrame:
    return conform(value_basis(sales_rows(extract, lookup, channel_map)), S.FACT_SALES)


def fact_inventory(extract: DataFrame, lookup: DataFrame) -> DataFrame:
    return conform(resolve(extract, lookup), S.FACT_INVENTORY)


def fact_purchase(extract: DataFrame, lookup: DataFrame) -> DataFrame:
    return conform(resolve(extract, lookup), S.FACT_PURCHASE)


def resolved_extract(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Adapter output of mixed id types to resolved rows; rows without an id type stay unresolved."""
    priced = "mrp" in lookup.schema["fallback"].dataType["hit"].dataType.names
    out = resolve(rows.drop("matched_via", "master_sku", "style_code"), lookup, ["mrp"] if priced else [])
    return out if priced else out.withColumn("mrp", F.lit(None).cast("double"))
