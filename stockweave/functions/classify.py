"""Class columns: age bucket, movement, inventory status, stability.

The arguments are SQL texts (a column name or an expression), the result is a
column; each class is one built-in CASE expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stockweave import schemas as S

MOVEMENT_RANK = ("No Movement", "Slow Movement", "Good Movement", "Fast Movement")


def ratio_sql(a: str, b: str) -> str:
    """a / b, null when b is 0 or null."""
    return f"try_divide(cast({a} as double), nullif(cast({b} as double), 0.0D))"


def ageing_bucket(days: str) -> Column:
    steps = " ".join(f"when ({days}) <= {last} then '{name}'" for name, last, _ in S.AGEING_LADDER[:-1])
    return F.expr(f"case when ({days}) is null then null {steps} else '{S.AGEING_LADDER[-1][0]}' end")


def expected_sql(bucket: str) -> str:
    """Expected sell-through of an age bucket, null for anything else."""
    rates: dict[float, list[str]] = {}
    for name, _, rate in S.AGEING_LADDER:
        rates.setdefault(rate, []).append(f"'{name}'")
    return "case " + " ".join(f"when {bucket} in ({', '.join(n)}) then {r!r}D" for r, n in rates.items()) + " end"


def movement(sell_through: str, bucket: str) -> Column:
    """Sell-through judged against what stock of that age should have sold."""
    e, none, slow, good, fast = expected_sql(bucket), *MOVEMENT_RANK
    return F.expr(f"""case when ({sell_through}) is null or ({e}) is null then null
        when ({sell_through}) <= 0 then '{none}'
        when ({sell_through}) < ({e}) * {S.SLOW_CUT}D then '{slow}'
        when ({sell_through}) <= ({e}) * {S.FAST_CUT}D then '{good}' else '{fast}' end""")


def inventory_status(stock: str, monthly_rate: str) -> Column:
    """Months of cover as a word; without recent sales, the units alone decide."""
    return F.expr(f"""case when ({stock}) is null or ({stock}) <= 0 then 'no stock'
        when not coalesce(({monthly_rate}) > 0, false) then if(({stock}) > 3, 'over stock', 'in stock')
        when ({stock}) / ({monthly_rate}) < {S.LOW_COVER}D then 'low stock'
        when ({stock}) / ({monthly_rate}) < {S.NORMAL_COVER}D then 'in stock' else 'over stock' end""")


def stability(recent: str, overall: str) -> Column:
    names = "array(" + ", ".join(f"'{m}'" for m in MOVEMENT_RANK) + ")"
    now, then = (f"nullif(array_position({names}, {c}), 0L)" for c in (recent, overall))
    good = MOVEMENT_RANK.index("Good Movement") + 1
    return F.expr(f"""case when {now} > {then} then 'Improving'
        when {now} < {then} and {then} >= {good} then 'Slowing Down'
        when {now} < {then} then 'Recovering' when {now} = {then} then 'Stable' end""")


def inventory_level(stock: str, need: str, short: str, fine: str) -> Column:
    return F.expr(f"if(({stock}) <= ({need}), '{short}', '{fine}')")


def period_sell_through(net: str, stock: str) -> Column:
    return F.expr(ratio_sql(net, f"{net} + {stock}"))


def overall_sell_through(net: str, stock: str, purchased: str) -> tuple[Column, Column]:
    """(rate, basis): against purchases where known, else against sold plus stock."""
    on_receipts, estimate = ratio_sql(net, purchased), ratio_sql(net, f"{net} + {stock}")
    basis = F.expr(f"""case when {on_receipts} is not null then 'purchase qty'
        when {estimate} is not null then 'sold + stock (estimate)' else 'unknown' end""")
    return F.expr(f"coalesce({on_receipts}, {estimate})"), basis


def return_rate(returned: str, net: str) -> Column:
    return F.expr(ratio_sql(returned, f"{net} + {returned}"))


def movement_criteria(spark: SparkSession) -> DataFrame:
    """The ladder as a table: one row per age bucket with its cut points."""
    rows = ", ".join(f"struct({i}, '{name}', {rate!r}D)" for i, (name, _, rate) in enumerate(S.AGEING_LADDER))
    return spark.range(1).selectExpr(f"inline(array({rows})) as (bucket_order, ageing, expected)").selectExpr(
        "bucket_order", "ageing", "expected", "0.0D as no_movement_to",
        f"rint(expected * {S.SLOW_CUT}D * 10000) / 10000 as slow_below",
        f"rint(expected * {S.FAST_CUT}D * 10000) / 10000 as good_to",
    )
