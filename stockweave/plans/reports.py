"""Report tables over the three facts.

Every report is one aggregation over one scan; measures of different flows
come from conditional aggregates, never from one scan per measure. Sums of
money are exact, so results do not depend on task order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stockweave import schemas as S
from stockweave.functions.numbers import (
    EXACT, exact_sum, money_if, money_sum, percent, ratio, round_half_even, sum_if, unit_sum,
)
from stockweave.operators.facts import mapped
from stockweave.operators.resolve import unresolved


def rows() -> Column:
    return F.count(F.lit(1))


def channel(sales: DataFrame) -> DataFrame:
    return mapped(sales).groupBy("flow", "channel_type", "channel").agg(
        F.countDistinct("master_sku").alias("skus"),
        unit_sum("qty_sold").alias("units"),
        money_sum("net_value").alias("net_value"),
        money_sum("gross_value").alias("gross_value"),
    ).orderBy(F.asc("flow"), F.desc_nulls_last("net_value"), "channel")


def store(sales: DataFrame, inventory: DataFrame) -> DataFrame:
    """Stores by flow. A flow a store never had stays null; a flow nobody had is 0."""
    stores = mapped(sales).filter(F.col("channel_type") == S.STORE_TYPE)
    flows = ("sell_in", "sell_out")
    sums = stores.groupBy("channel", "location").agg(
        *[F.sum(F.when(F.col("flow") == f, F.coalesce("qty_sold", F.lit(0.0)))).alias(f"qty_sold_{f}") for f in flows],
        *[
            exact_sum(F.when(F.col("flow") == f, F.coalesce("net_value", F.lit(0.0))))
            .alias(f"net_value_{f}") for f in flows
        ],
    )
    # A store without a flow has no sum for it, so the few summed rows tell which flows occur.
    seen = sums.agg(*[F.coalesce(F.bool_or(F.col(f"qty_sold_{f}").isNotNull()), F.lit(False)).alias(f"_{f}") for f in flows])
    stock = (
        inventory.filter((F.col("channel_type") == S.STORE_TYPE) & F.col("channel").isNotNull() & F.col("location").isNotNull())
        .groupBy("channel", "location").agg(unit_sum("qty_on_hand").alias("closing_stock"))
    )
    out = sums.join(stock, ["channel", "location"], "left").crossJoin(F.broadcast(seen))  # seen is one row
    return out.select(
        "channel", "location", "closing_stock",
        *[
            F.when(~F.col(f"_{f}"), F.lit(0.0)).otherwise(F.col(f"{m}_{f}")).alias(f"{m}_{f}")
            for m in ("qty_sold", "net_value") for f in flows
        ],
    ).orderBy(F.desc_nulls_last("qty_sold_sell_out"), "channel", "location")


def sku(sales: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row per sold SKU. Sales and stock meet in one aggregation, not in a join."""
    sold = mapped(sales).select(
        "master_sku", "style_code", "flow", "channel", "qty_sold", "net_value",
        F.lit(None).cast("double").alias("qty_on_hand"),
    )
    held = inventory.filter("master_sku is not null").select(
        "master_sku", "style_code", F.lit(None).cast("string").alias("flow"), F.lit(None).cast("string").alias("channel"),
        F.lit(None).cast("double").alias("qty_sold"), F.lit(None).cast("double").alias("net_value"), "qty_on_hand",
    )
    # Channels are counted by pre-grouping on them, so no second distinct pass is needed. The style is grouped by
    # as well: a largest text among the sums would have Spark sort all rows instead of hashing them.
    by_channel = sold.unionByName(held).groupBy("master_sku", "style_code", "flow", "channel").agg(
        F.sum("qty_sold").alias("qty"),
        F.try_sum(F.col("net_value").try_cast(EXACT)).alias("net"), F.sum("qty_on_hand").alias("stock"),
    )
    out = by_channel.groupBy("master_sku").agg(
        F.max("style_code").alias("style_code"),
        F.countDistinct("channel").alias("channels"),
        F.max(F.col("flow").isNotNull()).alias("_sold"),
        *[sum_if(F.col("flow") == f, "qty").alias(f"qty_sold_{f}") for f in ("sell_in", "sell_out")],
        *[
            F.coalesce(F.sum(F.when(F.col("flow") == f, F.col("net"))).cast("double"), F.lit(0.0)).alias(f"net_value_{f}")
            for f in ("sell_in", "sell_out")
        ],
        unit_sum("stock").alias("stock_on_hand"),
    ).filter("_sold")
    return out.select(
        "master_sku", "style_code", "channels", "qty_sold_sell_in", "qty_sold_sell_out",
        "net_value_sell_in", "net_value_sell_out", "stock_on_hand",
        percent("qty_sold_sell_out", F.col("qty_sold_sell_out") + F.col("stock_on_hand")).alias("sell_through_pct"),
    ).orderBy(F.desc_nulls_last("net_value_sell_out"), "master_sku")


def open_po_lines(purchases: DataFrame) -> DataFrame:
    closed = F.upper("po_status").isin(*S.CLOSED_PO)
    return purchases.filter(~F.coalesce(closed, F.lit(False)) & (F.col("qty_pending") > 0)).orderBy(
        F.desc_nulls_last("qty_pending"), "po_code", "external_id"
    )


def po_vendor(purchases: DataFrame) -> DataFrame:
    out = purchases.groupBy("vendor", "po_status").agg(
        F.countDistinct("po_code").alias("pos"), rows().alias("lines"),
        unit_sum("qty_ordered").alias("ordered"), unit_sum("qty_received").alias("received"),
        unit_sum("qty_pending").alias("pending"), unit_sum("qty_rejected").alias("rejected"),
        money_sum("total").alias("value"),
        round_half_even(ratio(F.sum("ageing_days"), F.count("ageing_days")), 1).alias("avg_ageing_days"),
    )
    return out.withColumn("fill_rate_pct", percent("received", "ordered")).orderBy(F.desc_nulls_last("pending"), "vendor", "po_status")


def po_sku(purchases: DataFrame, inventory: DataFrame, sales: DataFrame) -> DataFrame:
    """Inbound cover per purchased SKU: on order, in stock, selling."""
    double = F.lit(None).cast("double")
    names = ("qty_pending", "qty_ordered", "qty_received", "total", "qty_on_hand", "qty_sold")

    def part(df: DataFrame, *have: str) -> DataFrame:
        return df.filter("master_sku is not null").select(
            "master_sku", "style_code", F.lit("total" in have).alias("_po"),
            *[F.col(n) if n in have else double.alias(n) for n in names],
        )

    stacked = (
        part(purchases, "qty_pending", "qty_ordered", "qty_received", "total")
        .unionByName(part(inventory, "qty_on_hand"))
        .unionByName(part(sales.filter("flow = 'sell_out'"), "qty_sold"))
    )
    # Sums of numbers by SKU and style first: they are hashed, where a largest style would have all rows sorted.
    by_style = stacked.groupBy("master_sku", "style_code").agg(
        F.max("_po").alias("_po"), *[F.sum(n).alias(n) for n in names if n != "total"], F.try_sum(F.col("total").try_cast(EXACT)).alias("total"),
    )
    return (
        by_style.groupBy("master_sku").agg(
            F.max("style_code").alias("style_code"), F.max("_po").alias("_po"),
            unit_sum("qty_pending").alias("on_order"), unit_sum("qty_on_hand").alias("stock_on_hand"),
            unit_sum("qty_sold").alias("sell_out_units"), unit_sum("qty_ordered").alias("ordered_total"),
            unit_sum("qty_received").alias("received_total"), F.coalesce(F.try_sum("total").cast("double"), F.lit(0.0)).alias("po_value"),
        ).filter("_po").drop("_po")
        .withColumn("total_supply", F.col("stock_on_hand") + F.col("on_order"))
        .orderBy(F.desc_nulls_last("on_order"), "master_sku")
    )


def inventory_position(inventory: DataFrame) -> DataFrame:
    return inventory.filter("master_sku is not null").groupBy("channel", "channel_type", "location").agg(
        F.countDistinct("master_sku").alias("skus"), unit_sum("qty_on_hand").alias("units"),
        money_sum("value_on_hand").alias("value"),
    ).orderBy(F.desc_nulls_last("units"), "channel", "location")


def period_coverage(sales: DataFrame) -> DataFrame:
    return sales.groupBy("source_file", "channel").agg(
        F.min("grain").alias("grain"), F.min("flow").alias("flow"),
        F.min("period_start").alias("period_start"), F.max("period_end").alias("period_end"), rows().alias("rows"),
    )


def snapshot_coverage(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("source_file", "channel").agg(
        F.max("snapshot_date").alias("snapshot_date"), rows().alias("rows")
    )


def returns(sales: DataFrame) -> DataFrame:
    return sales.filter(F.coalesce("qty_returned", F.lit(0.0)) != 0).groupBy("channel", "channel_type").agg(
        unit_sum("qty_returned").alias("units_returned"), money_sum("returns_value").alias("returns_value"),
        F.bool_or(F.col("master_sku").isNotNull()).alias("sku_level"),
    ).orderBy(F.desc_nulls_last("units_returned"), "channel")


def value_basis(sales: DataFrame) -> DataFrame:
    return sales.groupBy("value_basis").agg(rows().alias("rows"), money_sum("net_value").alias("value"))


def unknown_ledgers(sales: DataFrame) -> DataFrame:
    return sales.filter("flow = 'unknown' and channel is not null").select("channel").distinct().orderBy("channel")


def exceptions(unresolved_rows: DataFrame) -> DataFrame:
    """Unresolved ids by money. A null id is kept, so this agrees with the audit."""
    return unresolved_rows.groupBy("source_file", "external_id", "declared_id_type", "reason").agg(
        unit_sum("qty").alias("qty"), money_sum("value").alias("value")
    ).orderBy(F.desc_nulls_last("value"), "source_file", "external_id")


def reported_value(sales: DataFrame) -> DataFrame:
    """Facts with net_value as the source sent it: filled-in values were null or 0."""
    as_sent = F.when(F.col("value_basis") == "as_reported", F.col("net_value"))
    return sales.withColumn("net_value", as_sent)


def fact_exceptions(sales: DataFrame, inventory: DataFrame, purchases: DataFrame) -> DataFrame:
    """Exceptions of all three facts, straight from the written tables."""
    tied = reported_value(sales).filter("external_id_type is not null")
    parts = (
        unresolved(tied, "qty_sold", "net_value"), unresolved(inventory, "qty_on_hand", "value_on_hand"),
        unresolved(purchases, "qty_ordered", "total"),
    )
    return exceptions(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def load_audit(resolved: DataFrame, qty: str, value: str, drops: DataFrame | None = None) -> DataFrame:
    out = resolved.groupBy("source_file").agg(
        rows().alias("rows"), F.count("matched_via").alias("matched"),
        unit_sum(qty).alias("qty"), money_sum(value).alias("value"),
    ).withColumn("unmatched", F.col("rows") - F.col("matched")).withColumn("match_pct", percent("matched", "rows"))
    if drops is None:
        return out.withColumn("rows_other_facility", F.lit(0).cast("long"))
    other = drops.select("source_file", F.col("rows_dropped").alias("rows_other_facility"))
    return out.join(other, "source_file", "left").fillna(0, ["rows_other_facility"])


def po_coverage(purchases: DataFrame) -> DataFrame:
    """How much of the purchase ledger reaches a SKU."""
    return purchases.agg(
        rows().alias("lines"), F.count("master_sku").alias("matched"),
        F.countDistinct("master_sku").alias("skus"),
        F.countDistinct(F.when(F.col("master_sku").isNull(), F.col("external_id"))).alias("unknown_ids"),
    ).withColumn("dropped", F.col("lines") - F.col("matched"))


def summary(
    sales: DataFrame, inventory: DataFrame, purchases: DataFrame,
    files_skipped: int = 0, files_superseded: int = 0, facility: str | None = None, rows_dropped: int = 0,
) -> DataFrame:
    """Headline figures as (metric, value_num, value_text).

    Each fact is scanned once for all its figures; the one-row results meet in
    cross joins of single rows.
    """
    real = F.col("master_sku").isNotNull() & F.col("flow").isin("sell_in", "sell_out")
    out, into = real & (F.col("flow") == "sell_out"), real & (F.col("flow") == "sell_in")

    def distinct(name):
        return F.countDistinct(F.when(real, F.col(name))).cast("double")

    s = sales.agg(
        sum_if(out, "qty_sold").alias("m0"), money_if(out, "net_value").alias("m1"),
        sum_if(into, "qty_sold").alias("m2"), money_if(into, "net_value").alias("m3"),
        distinct("channel").alias("m4"), distinct("location").alias("m5"), distinct("master_sku").alias("m6"),
        F.countDistinct(F.when(F.col("flow") == "unknown", F.col("channel"))).cast("double").alias("m13"),
        F.count(F.lit(1)).alias("s_rows"), F.count("matched_via").alias("s_hit"),
    )
    i = inventory.agg(
        unit_sum("qty_on_hand").alias("m7"), F.count(F.lit(1)).alias("i_rows"), F.count("matched_via").alias("i_hit")
    )
    closed = F.coalesce(F.upper("po_status").isin(*S.CLOSED_PO), F.lit(False))
    opened = ~closed & (F.col("qty_pending") > 0)
    p = purchases.agg(
        sum_if(opened, "qty_pending").alias("m8"), money_if(opened, "total").alias("m9"),
        F.count(F.lit(1)).alias("p_rows"), F.count("matched_via").alias("p_hit"),
    )
    ids = [
        d.filter("matched_via is null").select("source_file", "external_id", "external_id_type")
        for d in (sales, inventory, purchases)
    ]
    e = ids[0].unionByName(ids[1]).unionByName(ids[2]).distinct().agg(F.count(F.lit(1)).cast("double").alias("m11"))
    row = s.crossJoin(F.broadcast(i)).crossJoin(F.broadcast(p)).crossJoin(F.broadcast(e))  # one row each
    hit = F.col("s_hit") + F.col("i_hit") + F.col("p_hit")
    total = F.col("s_rows") + F.col("i_rows") + F.col("p_rows")
    number = {
        "Sell-out units (end customers)": F.col("m0"),
        "Sell-out value": F.col("m1"),
        "Sell-in units (invoiced to channels)": F.col("m2"),
        "Sell-in value": F.col("m3"),
        "Channels": F.col("m4"),
        "Locations": F.col("m5"),
        "SKUs with activity": F.col("m6"),
        "Stock on hand (units)": F.col("m7"),
        "Units on order (open POs)": F.col("m8"),
        "Open PO value": F.col("m9"),
        "Identifier match rate %": percent(hit, F.greatest(total, F.lit(1))),
        "Unmapped identifiers": F.col("m11"),
        "Files skipped": F.lit(float(files_skipped)),
        "Unmapped channel ledgers": F.col("m13"),
        "Files superseded (deduped)": F.lit(float(files_superseded)),
        "Rows dropped (other facility)": F.lit(float(rows_dropped)),
    }
    lines = [
        F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value_num"), F.lit(None).cast("string").alias("value_text"))
        for k, v in number.items()
    ]
    lines.append(F.struct(
        F.lit("Facility scope").alias("metric"), F.lit(None).cast("double").alias("value_num"),
        F.lit(facility or "all facilities").alias("value_text"),
    ))
    return row.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def channel_pivot(channel_report: DataFrame) -> DataFrame:
    flows = ("sell_in", "sell_out")
    return channel_report.groupBy("channel").agg(
        *[sum_if(F.col("flow") == f, "units").alias(f"units_{f}") for f in flows],
        *[money_if(F.col("flow") == f, "net_value").alias(f"net_value_{f}") for f in flows],
    ).orderBy(F.desc_nulls_last("net_value_sell_in"), "channel")
