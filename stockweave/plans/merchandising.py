"""The merchandising tables: one row per SKU, one per style, and the action list."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from stockweave import schemas as S
from stockweave.functions import classify as C
from stockweave.functions.dates import overlaps, period_label, season_date, windows
from stockweave.functions.numbers import EXACT, unit_sum
from stockweave.operators.overrides import apply_overrides

INVENTORY_NAMES = tuple(S.INVENTORY_COLUMNS)
SUMMED = (
    "Total Inventory", "all sports inv", "J&J Inv", "OR inv", "INCS inv", "d8 inv + rtv", "D8 inv", "CB rtv",
    "Sale", "Ret", "Coco-OR SALES", "Coco-OR RET", "Retail", "Net sale", "Returns", "Purchase. qty",
    "overall net sale qty", "Overall ret", "Last 15 days Sales", "Last 15 days Returns",
)


def q(name: str):
    return F.col(f"`{name}`")


#: Per fact: the columns that SKU measures read.
SKU_FACTS = {
    "sales": ("master_sku", "style_code", "channel", "channel_type", "flow", "period_start", "period_end", "qty_sold", "qty_returned", "net_value"),
    "inventory": ("master_sku", "style_code", "channel", "qty_on_hand", "value_on_hand"),
    "purchase": ("master_sku", "created_date", "qty_ordered"),
}


def sku_fact(fact: DataFrame, name: str) -> DataFrame:
    """Those rows and columns of a fact that ``sku_measures`` reads."""
    return fact.filter("master_sku is not null").select(*SKU_FACTS[name])


def sku_measures(
    sales: DataFrame, inventory: DataFrame, purchases: DataFrame, asof: dt.date,
    period_days: int = S.PERIOD_DAYS, recent_days: int = S.RECENT_DAYS,
) -> DataFrame:
    """All per-SKU sums from the three facts in one aggregation.

    Each fact is summed by (SKU, style), then the sums are stacked and grouped
    by SKU: the union is the SKU universe, so there is no distinct, no universe
    join and no join per measure. Sums of rows have numbers only, which Spark
    adds up in a hash table; the largest style, a text, would have it sort all
    rows, and is taken from the sums. Map-side partial sums keep a best-selling
    SKU from becoming one task's work.
    """
    start, recent = windows(asof, period_days, recent_days)
    in_period, in_recent = overlaps(start, asof), overlaps(recent, asof)
    amazon = F.col("channel") == S.MARKETPLACE_CHANNEL
    retail = F.col("channel_type") == S.STORE_TYPE
    amazon, retail = F.coalesce(amazon, F.lit(False)), F.coalesce(retail, F.lit(False))
    sellout = F.col("flow") == "sell_out"
    other = ~amazon & ~retail

    # name -> (source, value); the value is null outside its condition.
    sale_cols = {
        "Coco-OR SALES": F.when(sellout & in_period & amazon, F.col("qty_sold")),
        "Coco-OR RET": F.when(sellout & in_period & amazon, F.col("qty_returned")),
        "Retail": F.when(sellout & in_period & retail, F.col("qty_sold")),
        "Sale": F.when(sellout & in_period & other, F.col("qty_sold")),
        "Ret": F.when(sellout & in_period & other, F.col("qty_returned")),
        "Last 15 days Sales": F.when(sellout & in_recent, F.col("qty_sold")),
        "Last 15 days Returns": F.when(sellout & in_recent, F.col("qty_returned")),
        "_all_sold": F.when(sellout, F.col("qty_sold")),
        "Overall ret": F.when(sellout, F.col("qty_returned")),
    }
    stock_cols = {
        name: F.when(F.col("channel") == channel, F.col("qty_on_hand")) for name, channel in S.INVENTORY_COLUMNS.items()
    }
    po_cols = {"Purchase. qty": F.col("qty_ordered")}
    sums = [*sale_cols, *stock_cols, *po_cols]
    # name -> (source, how rows add up, value, type); text is not summed but grouped by.
    extra = {
        "_so_net": (sales, "sum", F.when(sellout, F.col("net_value")).cast(EXACT), EXACT),
        "_stock_value": (inventory, "sum", F.col("value_on_hand").cast(EXACT), EXACT),
        "_first_sale": (sales, "min", F.when(sellout, F.col("period_start")), "timestamp_ntz"),
        "_first_po": (purchases, "min", F.col("created_date"), "timestamp_ntz"),
    }
    styles = {"_sold_style": sales, "_held_style": inventory}

    def part(df: DataFrame, own: dict) -> DataFrame:
        named = [n for n, src in styles.items() if src is df]
        mine = {n: (how, value, kind) for n, (src, how, value, kind) in extra.items() if src is df}
        summed = df.filter("master_sku is not null").select(
            "master_sku", *[F.col("style_code").alias(n) for n in named],
            *[value.cast("double").alias(n) for n, value in own.items()], *[value.cast(kind).alias(n) for n, (_, value, kind) in mine.items()],
        ).groupBy("master_sku", *named).agg(
            *[F.expr(f"sum(`{n}`) as `{n}`") for n in own], *[F.expr(f"{how}(`{n}`) as `{n}`") for n, (how, _, _) in mine.items()]
        )
        kinds = dict.fromkeys(sums, "double") | {n: kind for n, (_, _, _, kind) in extra.items()} | dict.fromkeys(styles, "string")
        return summed.select("master_sku", *[
            F.col(f"`{n}`").cast(kind).alias(n) if n in summed.columns else F.expr(f"cast(null as {kind}) as `{n}`") for n, kind in kinds.items()
        ])

    stacked = part(sales, sale_cols).unionByName(part(inventory, stock_cols)).unionByName(part(purchases, po_cols))
    grouped = stacked.groupBy("master_sku").agg(
        *[unit_sum(f"`{n}`").alias(n) for n in sums],
        F.sum("_so_net").cast("double").alias("_so_net"),
        F.sum("_stock_value").cast("double").alias("_stock_value"),
        F.min("_first_sale").alias("_first_sale"), F.min("_first_po").alias("_first_po"),
        F.max("_sold_style").alias("_sold_style"), F.max("_held_style").alias("_held_style"),
    )
    held = " + ".join(f"`{n}`" for n in INVENTORY_NAMES if n != "D8 inv")
    return grouped.selectExpr(
        "* except (master_sku, _held_style, _sold_style)", "master_sku as `Sku Code`",
        "coalesce(_held_style, _sold_style) as `Item Name`",
        "_all_sold - `Overall ret` as `overall net sale qty`",
        # Return-to-vendor stock has a column of its own; no source reports it yet.
        "0.0D as `CB rtv`", "`D8 inv` + 0.0D as `d8 inv + rtv`", f"{held} + (`D8 inv` + 0.0D) as `Total Inventory`",
        "Ret + `Coco-OR RET` as Returns", "Sale + `Coco-OR SALES` + Retail - (Ret + `Coco-OR RET`) as `Net sale`",
    )


AGEING_RUNGS = (
    ("first PO date", "_first_po"), ("first sale date", "_first_sale"),
    ("season code", "_season"), ("product year", "_yeardate"),
)


def ageing_ladder(skus: DataFrame, asof: dt.date) -> DataFrame:
    """First date known for a SKU, the rung that gave it, and the age bucket."""
    dated = skus.withColumns({
        "_season": season_date(F.coalesce("Item Name", "Sku Code")),
        "_yeardate": F.expr("make_date(nullif(cast(_year as int), 0), 7, 1)"),
    })
    rungs = " ".join(f"when {c} is not null then '{label}'" for label, c in AGEING_RUNGS)
    first = ", ".join(f"cast({c} as timestamp_ntz)" for _, c in AGEING_RUNGS)
    return dated.selectExpr(
        "* except (_season, _yeardate)", f"coalesce({first}) as _first_seen",
        f"case {rungs} else 'unknown' end as `Ageing basis`",
    ).withColumn("Ageing", C.ageing_bucket(whole_days(asof, "_first_seen")))


def whole_days(asof: dt.date, column: str) -> str:
    """SQL: full days from a moment to the report date; a started day does not count."""
    started = f"if({column} > cast(cast({column} as date) as timestamp_ntz), 1, 0)"
    return f"datediff(date'{asof}', {column}) - {started}"


def _rates(df: DataFrame, period_days: int, recent_days: int, sheet: str) -> DataFrame:
    months = f"{period_days / 30.0!r}D"
    overall, basis = C.overall_sell_through("`overall net sale qty`", "`Total Inventory`", "`Purchase. qty`")
    over = "Overall Movement" if sheet == "sku" else "overall Movement"
    out = df.withColumns({
        "ros/month": F.expr(f"`Net sale` / {months}"),
        "monthly ros": F.expr(f"`Last 15 days Sales` * {30.0 / recent_days!r}D"),
        "Sell through": C.period_sell_through("`Net sale`", "`Total Inventory`"),
        "Overall Sell-through": overall,
        "Sell-through basis": basis,
        "For 3 months": F.expr(f"`Net sale` / {months} * 3"),
    })
    need, words = "For 3 months", ("reorder", "in-stock")
    if sheet == "sku":
        need, words = "Sale Projection for next 3 month", ("REORDER", "IN-STOCK")
        out = out.withColumns({"avg": F.expr(f"`Net sale` / {months}"), need: F.expr(f"`Net sale` / {months} * 3")})
    return out.withColumns({
        over: C.movement("`Overall Sell-through`", "Ageing"),
        "Movement": C.movement("`Sell through`", "Ageing"),
        "Inv. Level": C.inventory_level("`Total Inventory`", f"`{need}`", *words),
        "Inventory status": C.inventory_status("`Total Inventory`", "`monthly ros`"),
    })


def svs_sku(
    sales: DataFrame, inventory: DataFrame, purchases: DataFrame, items: DataFrame,
    by_sku: DataFrame, by_style: DataFrame, asof: dt.date,
    period_days: int = S.PERIOD_DAYS, recent_days: int = S.RECENT_DAYS,
) -> DataFrame:
    """The SKU table in working columns. ``items``: master_sku, Category, Gender, MRP, _year."""
    base = sku_measures(sales, inventory, purchases, asof, period_days, recent_days)
    item = items.withColumnRenamed("master_sku", "_item")
    described = base.join(item, q("Sku Code") == q("_item"), "left").drop("_item")
    rated = _rates(ageing_ladder(described, asof), period_days, recent_days, "sku")
    return apply_overrides(rated, by_sku, by_style)


def svs_article(
    skus: DataFrame, by_style: DataFrame, asof: dt.date,
    period_days: int = S.PERIOD_DAYS, recent_days: int = S.RECENT_DAYS,
) -> DataFrame:
    """Styles from SKU rows, then the same rates and classes.

    Rows are first grouped by style and note, then by style: the most common
    note falls out of the same pass that sums the sizes, so the SKU table is
    read once and a huge style never sits in one task.
    """
    named = skus.filter("`Item Name` is not null")
    dated = "case when _first_seen is not null then struct(_first_seen, `Sku Code`, `Ageing basis` as basis) end"
    by_note = named.groupBy("Item Name", F.col("`Style Re-order Status`").alias("_note")).agg(
        *[F.expr(f"sum(`{n}`) as `{n}`") for n in SUMMED],
        F.expr("min(struct(`Sku Code`, Category, Gender)) as _first_size"),
        # SKU rows are unique already, so sizes are plain counts.
        F.expr("count(1) as _sizes"), F.expr("count_if(`Total Inventory` > 0) as _in_stock"),
        F.expr(f"min({dated}) as _oldest"),
    )
    grouped = by_note.groupBy("Item Name").agg(
        *[F.expr(f"sum(`{n}`) as `{n}`") for n in SUMMED],
        F.expr("min(_first_size) as _first_size"), F.expr("sum(_sizes) as sizes"),
        F.expr("sum(_in_stock) as `sizes in stock`"), F.expr("min(_oldest) as _oldest"),
        F.expr("min_by(_note, struct(-_sizes, _note)) filter (where _note <> '') as lifted_note"),
    ).selectExpr(
        "* except (_first_size, _oldest)", "_first_size.Category as Category", "_first_size.Gender as Gender",
        "_oldest._first_seen as _first_seen", "_oldest.basis as `Ageing basis`",
    ).withColumn("Ageing", C.ageing_bucket(whole_days(asof, "_first_seen")))
    rated = _rates(grouped, period_days, recent_days, "article").withColumns({
        "overall ret qty": q("Overall ret"),
        "Ret %": C.return_rate("`Overall ret`", "`overall net sale qty`"),
        "Movement Stability": C.stability("Movement", "`overall Movement`"),
    })
    style = by_style.select(
        F.col("key").alias("_key"), q("Style Re-order Status").alias("_style"), q("Reorder Status").alias("_reorder")
    )
    return (
        rated.join(style, q("Item Name") == q("_key"), "left")
        .withColumn("Style Status", F.coalesce("_style", "lifted_note", F.lit("")))
        .withColumn("Re-order Status", F.coalesce("_reorder", F.lit("")))
        .drop("_key", "_style", "_reorder", "lifted_note")
    )


def action_list(articles: DataFrame, level_counts_as_thin: bool = False) -> DataFrame:
    """Styles to act on, first matching action only.

    With ``level_counts_as_thin`` a style at its reorder level counts as thin
    even if its inventory status does not say so.
    """
    def whole(name):
        return F.coalesce(F.rint(q(name)), F.lit(0.0)).cast("long").cast("string")

    selling = q("Movement").isin("Good Movement", "Fast Movement")
    thin = q("Inventory status").isin("no stock", "low stock")
    if level_counts_as_thin:
        thin = thin | (F.upper(q("Inv. Level")) == "REORDER")
    clear = (q("Movement") == "No Movement") & (q("Inventory status") == "over stock")
    broken = selling & (q("sizes in stock") < q("sizes") * F.lit(0.5))
    ladder = (
        ("REORDER", selling & thin, F.concat(
            q("Movement"), F.lit(", "), q("Inventory status"), F.lit(", "), whole("For 3 months"),
            F.lit(" units projected for 3 months vs "), whole("Total Inventory"), F.lit(" in stock"))),
        ("SIZE BREAK", broken, F.concat(
            whole("sizes in stock"), F.lit(" of "), whole("sizes"), F.lit(" sizes in stock on a "),
            F.lower(q("Movement")), F.lit(" style"))),
        ("CLEAR", clear, F.concat(
            F.lit("no sales in the window, "), whole("Total Inventory"), F.lit(" units on hand, aged "), q("Ageing"))),
    )
    out = articles.withColumns({
        "Action": F.coalesce(*[F.when(cond, name) for name, cond, _ in ladder]),
        "Why": F.coalesce(*[F.when(cond, why) for _, cond, why in ladder]),
    }).filter("Action is not null")
    rank = F.coalesce(*[F.when(q("Action") == name, F.lit(i)) for i, (name, _, _) in enumerate(ladder)])
    return out.orderBy(rank, F.desc_nulls_last("Total Inventory"), "Item Name").select(
        "Action", "Why", "Item Name", "Category", "Gender", "Total Inventory", "sizes", "sizes in stock",
        "Net sale", "ros/month", "For 3 months", "Ageing", "Movement", "overall Movement",
        q("Inventory status"), q("Inv. Level"), "Style Status", "Re-order Status",
    )


def slice_report(df: DataFrame, **wanted) -> DataFrame:
    """IN-filters on report columns; an empty list leaves the column alone."""
    for name, values in wanted.items():
        if values:
            df = df.filter(q(name.replace("_", " ")).isin(*values))
    return df


DISTRIBUTION_COLUMNS = (
    "Movement", "Overall Movement", "Inventory status", "Inv. Level", "Ageing", "Ageing basis", "Sell-through basis",
)


def distributions(skus: DataFrame, columns=DISTRIBUTION_COLUMNS) -> DataFrame:
    """Value counts, nulls included, of several class columns in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), q(c).cast("string").alias("value")) for c in columns])
    return skus.select(F.explode(pairs).alias("p")).groupBy("p.column", "p.value").agg(F.count(F.lit(1)).alias("skus"))


def caveats(skus: DataFrame, purchases: DataFrame) -> DataFrame:
    """How many SKUs lack a purchase order, an age or a category."""
    counts = skus.agg(
        F.count(F.lit(1)).alias("skus"),
        F.count_if(F.coalesce(q("Purchase. qty"), F.lit(0.0)) == 0).alias("without_po"),
        F.count_if(q("Ageing").isNull()).alias("without_age"),
        F.count_if(q("Category").isNull()).alias("without_category"),
    )
    return counts.crossJoin(F.broadcast(purchases.agg(F.count(F.lit(1)).alias("po_lines"))))  # 1 x 1 row


# --------------------------------------------------------------------------
# Published layouts. The headers are fixed values: downstream sheets bind to
# them letter by letter, odd spacing and spelling included. {P} becomes the
# period label. A plain string is both the header and the working column.
# --------------------------------------------------------------------------

SKU_LAYOUT = (
    "Sku Code", "Item Name", "Category", "Total Inventory", "all sports inv", "J&J Inv", "OR inv",
    "d8 inv + rtv", "D8 inv", "CB rtv", ("Sale   ({P} )", "Sale"), "Ret", "Coco-OR SALES", "Coco-OR RET",
    ("Retail ({P})", "Retail"), ("Net sale ({P} )", "Net sale"), ("Returns ({P} )", "Returns"), "avg",
    "Sale Projection for next 3 month", "Purchase. qty", ("Sell through ({P})", "Sell through"),
    "overall net sale qty", "Overall ret", ("Overall \nSell-through", "Overall Sell-through"), "ros/month",
    ("Last 15 days  Sales", "Last 15 days Sales"), ("Last 15 days  Returns", "Last 15 days Returns"),
    "monthly ros", "Ageing", "Overall Movement", "Inv. Level", "Movement", "Style Re-order Status",
    "For 3 months", "Inventory status", "Reorder Status", "Gender", "INCS inv", "Ageing basis", "Sell-through basis",
)
ARTICLE_LAYOUT = (
    "Item Name", "Category", "Gender", "Total Inventory", ("d8 Inv + RTV", "d8 inv + rtv"), ("d8 Inventory", "D8 inv"),
    ("Net sale ({P})", "Net sale"), ("Reurns   ({P} 15)", "Returns"), "ros/month", "Purchase. qty", "Sell through",
    ("Last 15 days sales ", "Last 15 days Sales"), ("Last 15 daysRet", "Last 15 days Returns"),
    ("ros/ month ( Based on last 15 days)", "monthly ros"), ("overall net sale qty ", "overall net sale qty"),
    ("overall ret qty ", "overall ret qty"), ("Overall \nSell-through", "Overall Sell-through"), "Ret %", "Ageing",
    "overall Movement", "Inv. Level", "Movement", "Movement Stability", "Style Status", "For 3 months",
    "Inventory status", "Re-order Status", "all sports inv", "J&J Inv", "OR inv", "INCS inv", "CB rtv", "sizes",
    "sizes in stock", "Ageing basis", "Sell-through basis",
)


def lay_out(df: DataFrame, layout, start: dt.date, asof: dt.date) -> DataFrame:
    """Exact published headers in order; a missing working column is null."""
    label = period_label(start, asof)
    have = set(df.columns)
    pairs = [(entry, entry) if isinstance(entry, str) else entry for entry in layout]
    return df.select([
        (q(key) if key in have else F.lit(None).cast("string")).alias(header.replace("{P}", label)) for header, key in pairs
    ])
