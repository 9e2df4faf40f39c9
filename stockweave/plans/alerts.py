"""Stock alerts: the frame rules read, the eight rules, ranking and digest tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from stockweave import schemas as S
from stockweave.functions.numbers import EXACT, fmt_sql, ratio
from stockweave.operators.dedup import top_per_group

ALERT_COLUMNS = (
    "alert", "label", "severity", "sev_rank", "key", "sku", "item", "category", "stock", "monthly_ros",
    "cover_days", "sell_through", "return_rate", "ageing", "movement", "value_at_risk", "revenue_at_risk",
    "value_basis", "reason", "priority", "money_col",
)

# Alert frame column -> published or working column names it may carry.
_TEXT = {
    "sku": "Sku Code", "item": "Item Name", "category": "Category", "gender": "Gender", "ageing": "Ageing",
    "movement": "Movement", "overall_movement": "Overall Movement", "inv_level": "Inv. Level",
    "inv_status": "Inventory status", "reorder_status": "Reorder Status", "style_reorder": "Style Re-order Status",
}
_NUMBERS = {
    "stock": "Total Inventory", "monthly_ros": "monthly ros", "ros_month": "ros/month", "net_sale": "Net sale",
    "returns": "Returns", "overall_sale": "overall net sale qty", "overall_ret": "Overall ret",
    "sell_through": "Sell through", "last15_sales": "Last 15 days Sales", "for_3_months": "For 3 months",
    "purchase_qty": "Purchase. qty",
}


def sku_valuation(inventory: DataFrame) -> DataFrame:
    """Reported stock value per SKU; a SKU with no reported value has no row."""
    return (
        inventory.filter("master_sku is not null and value_on_hand is not null")
        .groupBy("master_sku").agg(F.sum(F.col("value_on_hand").cast(EXACT)).cast("double").alias("stock_value"))
        .filter("stock_value > 0")
    )


def _sold(sales: DataFrame) -> DataFrame:
    return (
        sales.filter("flow = 'sell_out' and master_sku is not null").groupBy("master_sku")
        .agg(
            F.coalesce(F.sum(F.col("net_value").cast(EXACT)).cast("double"), F.lit(0.0)).alias("net"),
            F.coalesce(F.sum("qty_sold"), F.lit(0.0)).alias("qty"),
        ).filter("qty > 0")
    )


def average_price(sales: DataFrame) -> DataFrame:
    """Realised price per sold SKU."""
    return _sold(sales).select("master_sku", ratio("net", "qty").alias("avg_price")).filter("avg_price > 0")


def overall_price(sales: DataFrame) -> DataFrame:
    """One row: total sell-out value over total units."""
    return _sold(sales).agg(
        F.coalesce(ratio(F.sum(F.col("net").cast(EXACT)).cast("double"), F.sum("qty")), F.lit(0.0)).alias("overall_price")
    )


def prepare(skus: DataFrame, fallback_to_asp: bool = True) -> DataFrame:
    """The frame every rule reads, from the SKU working table.

    Stock value and realised prices were summed in the same pass as the SKU
    measures, so valuing needs no further look at the facts; only the overall
    price is one extra aggregate row.
    """
    base = skus.selectExpr(
        *[f"coalesce(trim(cast(`{src}` as string)), '') as {name}" for name, src in _TEXT.items()],
        *[f"coalesce(cast(`{src}` as double), 0.0D) as {name}" for name, src in _NUMBERS.items()],
        "case when _stock_value > 0 then _stock_value end as reported_value",
        "case when _all_sold > 0 then coalesce(_so_net, 0.0D) end as _net",
        "case when _all_sold > 0 then _all_sold end as _qty",
    ).filter("sku <> ''")
    if fallback_to_asp:
        total = base.selectExpr(
            f"coalesce(try_divide(cast(sum(cast(_net as {EXACT})) as double), nullif(sum(_qty), 0.0D)), 0.0D) as overall_price"
        )
        base = base.crossJoin(F.broadcast(total))  # one row
    else:
        base = base.selectExpr("*", "0.0D as overall_price").withColumn("_net", F.lit(None).cast("double"))
    # A zero 15-day rate is normal right after a cycle closes; the period rate stands in.
    rated = base.selectExpr(
        "* except (_net, _qty, overall_price)",
        "coalesce(case when _net / _qty > 0 then _net / _qty end, overall_price) as unit",
        "case when monthly_ros > 0 then monthly_ros else ros_month end as demand_rate",
        "overall_sale + overall_ret as _volume",
    )
    valued = rated.selectExpr(
        "* except (_volume)",
        "demand_rate / 30.0D as daily_rate",
        "case when demand_rate / 30.0D > 0 then stock / (demand_rate / 30.0D) end as cover_days",
        "case when _volume > 0 then overall_ret / _volume end as return_rate",
        "rint(coalesce(reported_value, stock * unit, 0.0D)) + 0.0D as value_at_risk",
    )
    priced = valued.selectExpr(
        "* except (unit, reported_value)",
        """case when not coalesce(value_at_risk > 0, false) then 'none'
            when reported_value is not null then 'reported' else 'estimated' end as value_basis""",
        "case when stock > 0 then value_at_risk / stock else unit end as unit_price",
    )
    return priced.selectExpr("*", "rint(demand_rate * unit_price) + 0.0D as revenue_at_risk")


def _text_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "\\'") + "'" for v in values)


def _floor(cfg: dict, name: str, default) -> str:
    return f"{float(cfg.get(name, default))!r}D"


def _out_of_stock(cfg):
    return (
        f"stock <= 0 and demand_rate >= {_floor(cfg, 'min_monthly_ros', 0.5)}",
        f"concat('sells ~', {fmt_sql('demand_rate')}, '/month, stock is zero')",
    )


def _low_stock(cfg):
    """Short cover, or already called low by the SKU table: either is enough."""
    cover = cfg.get("cover_days", 21)
    short = f"coalesce(cover_days < {float(cover)!r}D and demand_rate >= {_floor(cfg, 'min_monthly_ros', 0.5)}, false)"
    return (
        f"stock > 0 and ({short} or lower(inv_status) = 'low stock')",
        f"""case when {short} then concat({fmt_sql('cover_days')}, ' days of cover left (floor is {cover})')
            else 'flagged low stock in the workbook' end""",
    )


def _reorder_level(cfg):
    open_note = f" and lower(trim(reorder_status)) not in ({_text_list(S.HANDLED_NOTES)})"
    return (
        "upper(inv_level) = 'REORDER'" + (open_note if cfg.get("respect_manual_override", True) else ""),
        f"""concat('at reorder point — ', {fmt_sql('stock')}, ' on hand vs ', {fmt_sql('for_3_months')},
            ' needed for 3 months')""",
    )


def _best_sellers(cfg):
    return (
        f"movement = 'Fast Movement' and net_sale >= {_floor(cfg, 'min_units_sold', 5)}",
        f"concat({fmt_sql('net_sale')}, ' sold this period, sell-through ', {fmt_sql('sell_through * 100')}, '%')",
    )


def _high_returns(cfg):
    volume = "overall_sale + overall_ret"
    return (
        f"return_rate > {_floor(cfg, 'return_rate', 0.15)} and {volume} >= {_floor(cfg, 'min_units_sold', 10)}",
        f"""concat({fmt_sql('return_rate * 100')}, '% returned (', {fmt_sql('overall_ret')}, ' of ',
            {fmt_sql(volume)}, ')')""",
    )


def _slow_moving(cfg):
    return (
        f"movement = 'Slow Movement' and value_at_risk >= {_floor(cfg, 'min_value', 5000)}",
        f"concat('sell-through ', {fmt_sql('sell_through * 100')}, '% against its ', ageing, ' age')",
    )


def _dead_stock(cfg):
    buckets = _text_list(cfg.get("ageing_buckets", [">1 year", ">2 years"]))
    return (
        f"movement = 'No Movement' and ageing in ({buckets}) and stock >= {_floor(cfg, 'min_units', 5)}",
        f"concat('no sales, ', {fmt_sql('stock')}, ' units sitting ', replace(ageing, '>', 'over '))",
    )


def _stock_ageing(cfg):
    buckets = _text_list(cfg.get("ageing_buckets", [">2 years"]))
    return (
        f"ageing in ({buckets}) and stock >= {_floor(cfg, 'min_units', 5)}",
        f"concat({fmt_sql('stock')}, ' units in the ', ageing, ' bucket')",
    )


# A rule turns its settings into (condition, reason), both SQL over the alert
# frame; add one here to extend.
RULES: dict[str, Callable[[dict], tuple[str, str]]] = {
    "out_of_stock": _out_of_stock,
    "low_stock": _low_stock,
    "reorder_level": _reorder_level,
    "best_sellers": _best_sellers,
    "high_returns": _high_returns,
    "slow_moving": _slow_moving,
    "dead_stock": _dead_stock,
    "stock_ageing": _stock_ageing,
}
MONEY_COLUMNS = ("value_at_risk", "revenue_at_risk")


def load_rules(path: str | None = None) -> dict:
    """Rules from a YAML file, or the shipped ones."""
    if path is None:
        return S.DEFAULT_RULES
    import yaml

    with open(path, encoding="utf-8") as fh:
        rules = yaml.safe_load(fh) or {}
    if "alerts" not in rules:
        raise ValueError(f"{path} has no 'alerts' section")
    return rules


def active_rules(rules: dict) -> dict[str, dict]:
    """Enabled rules that exist; unknown names are skipped."""
    listed = {k: (v or {}) for k, v in (rules.get("alerts") or {}).items()}
    return {k: v for k, v in listed.items() if v.get("enabled", True) and k in RULES}


def evaluate(frame: DataFrame, rules: dict = S.DEFAULT_RULES) -> DataFrame:
    """All open alerts; one SKU may raise several.

    The names of the rules a row breaks become one array, exploded once: the
    SKU frame is computed a single time however many rules there are, and texts
    are made for raised alerts only.
    """
    conditions, labels, severities, ranks, reasons, money = [], {}, {}, {}, {}, {}
    for name, cfg in active_rules(rules).items():
        condition, reasons[name] = RULES[name](cfg)
        conditions.append(f"case when {condition} then '{name}' end")
        labels[name] = cfg.get("label", name.replace("_", " ").title())
        severities[name] = cfg.get("severity", "medium")
        ranks[name] = S.SEVERITY_RANK.get(severities[name], 9)
        rank_by = cfg.get("rank_by", "value_at_risk")
        money[name] = rank_by if rank_by in frame.columns else "value_at_risk"
    if not conditions:
        raise ValueError("no alert rule is enabled")

    def per_alert(values: dict, render=lambda v: _text_list([v])) -> str:
        return "case alert " + " ".join(f"when '{n}' then {render(v)}" for n, v in values.items()) + " end"

    raised = frame.selectExpr("*", f"explode(array_compact(array({', '.join(conditions)}))) as alert")
    return raised.selectExpr(
        "*", f"{per_alert(labels)} as label", f"{per_alert(severities)} as severity",
        f"{per_alert(ranks, str)} as sev_rank", f"{per_alert(reasons, str)} as reason",
        f"cast({per_alert(money, lambda c: f'`{c}`')} as double) as priority", f"{per_alert(money)} as money_col",
        "concat(alert, '|', sku) as key",
    ).select(*ALERT_COLUMNS)


def sort_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy("sev_rank", "alert", F.desc_nulls_last("priority"), "sku")


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Per alert: SKUs, new ones, units and money, in digest order."""
    is_new = F.col("status") == "NEW" if "status" in alerts.columns else F.lit(True)
    return alerts.groupBy("alert", "label", "severity", "sev_rank", "money_col").agg(
        F.count(F.lit(1)).alias("skus"), F.count_if(is_new).alias("new_skus"),
        F.sum("stock").alias("units"), F.sum("priority").alias("money"),
    ).orderBy("sev_rank", F.desc("new_skus"), F.desc("money"))


def top_alerts(alerts: DataFrame, n: int = S.DEFAULT_RULES["digest"]["top_n"]) -> DataFrame:
    """The n most valuable rows of every alert."""
    return top_per_group(alerts, "alert", [F.desc_nulls_last("priority"), F.asc("sku")], n)


def unique_money(alerts: DataFrame) -> DataFrame:
    """Money per side, each SKU counted once however many alerts it raised."""
    once = alerts.groupBy("money_col", "sku").agg(F.max("priority").alias("money"))
    return once.groupBy("money_col").agg(F.sum("money").alias("money"), F.count(F.lit(1)).alias("skus"))
