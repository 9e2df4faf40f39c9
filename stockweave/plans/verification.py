"""Tie-out: prove each report figure against its raw input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stockweave import schemas as S
from stockweave.functions.numbers import money_if, money_sum, num, percent, round_half_even, sum_if, unit_sum


def check_row(name: str, raw: Column, got: Column, tolerance: float = 1.0, otherwise: str = "FAIL") -> Column:
    """One check as a struct; a difference above the tolerance does not pass."""
    a, b = raw.cast("double"), got.cast("double")
    return F.struct(
        F.lit(name).alias("check"), round_half_even(a, 2).alias("raw_file"), round_half_even(b, 2).alias("in_report"),
        round_half_even(b - a, 2).alias("diff"),
        F.when(F.abs(a - b) <= tolerance, "PASS").otherwise(otherwise).alias("result"),
    )


def as_table(one_row: DataFrame, checks: Sequence[Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*checks)).alias("c")).select("c.*")


def tie_out(raw: DataFrame, fact: DataFrame, pairs: Sequence[tuple[str, Column, Column, float]]) -> DataFrame:
    """Raw totals against fact totals: one scan per side, however many checks.

    ``pairs`` holds (name, aggregate over raw, aggregate over fact, tolerance).
    """
    left = raw.agg(*[a.alias(f"r{i}") for i, (_, a, _, _) in enumerate(pairs)])
    right = fact.agg(*[b.alias(f"f{i}") for i, (_, _, b, _) in enumerate(pairs)])
    checks = [check_row(n, F.col(f"r{i}"), F.col(f"f{i}"), tol) for i, (n, _, _, tol) in enumerate(pairs)]
    return as_table(left.crossJoin(F.broadcast(right)), checks)  # 1 x 1 row


def sales_pairs(label: str, qty="qty_sold", gross="gross_value", net="net_value"):
    reported = F.col("value_basis") == "as_reported"
    return [
        (f"{label} | units", unit_sum(qty), unit_sum("qty_sold"), 1.0),
        (f"{label} | invoice total", money_sum(gross), money_sum("gross_value"), 1.0),
        (f"{label} | taxable value", money_sum(net), money_if(reported, "net_value"), 1.0),
        (f"{label} | returned units", unit_sum("qty_returned"), unit_sum("qty_returned"), 1.0),
        (f"{label} | returns value", money_sum("returns_value"), money_sum("returns_value"), 1.0),
        (f"{label} | row count", F.count(F.lit(1)), F.count(F.lit(1)), 0.0),
    ]


def inventory_pairs(label: str):
    return [
        (f"{label} | units", unit_sum("qty_on_hand"), unit_sum("qty_on_hand"), 1.0),
        (f"{label} | value", money_sum("value_on_hand"), money_sum("value_on_hand"), 1.0),
        (f"{label} | row count", F.count(F.lit(1)), F.count(F.lit(1)), 0.0),
    ]


def purchase_pairs(label: str):
    same = [
        (f"{label} | {word}", unit_sum(c), unit_sum(c), 1.0)
        for word, c in (("ordered qty", "qty_ordered"), ("received qty", "qty_received"), ("pending qty", "qty_pending"))
    ]
    return same + [
        (f"{label} | total value", money_sum("total"), money_sum("total"), 1.0),
        (f"{label} | row count", F.count(F.lit(1)), F.count(F.lit(1)), 0.0),
        (f"{label} | distinct PO codes", F.countDistinct("po_code"), F.countDistinct("po_code"), 0.0),
    ]


#: Per fact: metric -> column. Of net values only those the files gave are compared.
SOURCE_METRICS = {
    "sales": {
        "units": "qty_sold", "invoice total": "gross_value", "taxable value": "net_value", "returned units": "qty_returned", "returns value": "returns_value",
    },
    "inventory": {"units": "qty_on_hand", "value": "value_on_hand"},
    "purchase": {
        "ordered qty": "qty_ordered", "received qty": "qty_received", "rejected qty": "qty_rejected", "pending qty": "qty_pending", "total value": "total",
    },
}
ROWS = "row count"


def source_totals(rows: DataFrame, fact: str) -> DataFrame:
    """(source_type, source_file, metric, value) of raw or of fact rows: one aggregation, whatever the number of sources."""
    have = rows.columns

    def value(column: str) -> Column:
        if column not in have:
            return F.lit(None).cast("double")
        return F.when(F.col("value_basis") == "as_reported", F.col(column)) if column == "net_value" and "value_basis" in have else F.col(column)

    wide = rows.groupBy("source_type", "source_file").agg(
        F.count(F.lit(1)).cast("double").alias("m0"), *[money_sum(value(c)).alias(f"m{i}") for i, c in enumerate(SOURCE_METRICS[fact].values(), 1)]
    )
    long = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"m{i}").alias("value")) for i, n in enumerate((ROWS, *SOURCE_METRICS[fact]))])
    return wide.select("source_type", "source_file", F.explode(long).alias("m")).select("source_type", "source_file", "m.*")


def tie_out_sources(raw: DataFrame, loaded: DataFrame, missing: DataFrame | None = None, tolerance: float = 1.0) -> DataFrame:
    """Every source against the facts, metric by metric: source_type, source_file, metric, raw_file, in_report, diff, result.

    Sources that only one side has are compared with nothing there, so a lost
    file cannot hide behind another one's surplus. ``missing``: source_type,
    source_file and state of expected sources that could not be read; each
    gives a FAIL row of its own.
    """
    key = ["source_type", "source_file", "metric"]
    both = raw.withColumnRenamed("value", "a").join(loaded.withColumnRenamed("value", "b"), key, "full_outer")
    a, b = F.coalesce("a", F.lit(0.0)), F.coalesce("b", F.lit(0.0))
    allowed = F.when(F.col("metric") == ROWS, 0.0).otherwise(tolerance)
    out = both.select(
        *key, round_half_even(a, 2).alias("raw_file"), round_half_even(b, 2).alias("in_report"), round_half_even(b - a, 2).alias("diff"),
        F.when(F.abs(a - b) <= allowed, "PASS").otherwise("FAIL").alias("result"),
    )
    if missing is None:
        return out
    none = F.lit(None).cast("double")
    return out.unionByName(missing.select(
        "source_type", "source_file", F.col("state").alias("metric"), none.alias("raw_file"), none.alias("in_report"), none.alias("diff"), F.lit("FAIL").alias("result")
    ))


def missing_sources(files: DataFrame, expected: DataFrame) -> DataFrame:
    """source_type, source_file, state: expected kinds (column ``source_type``) that no file has, and files that cannot be read.

    ``files``: name, kind, note of every file that was found.
    """
    absent = expected.join(files.select(F.col("kind").alias("source_type")).distinct(), "source_type", "left_anti")
    unreadable = files.filter("kind = 'UNREADABLE'").select(F.col("kind").alias("source_type"), F.col("name").alias("source_file"), F.lit("not readable").alias("state"))
    return absent.select("source_type", F.lit(None).cast("string").alias("source_file"), F.lit("source file not found").alias("state")).unionByName(unreadable)


def po_line_balance(purchases: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """Ordered must equal received + pending + rejected, and lines should match a SKU."""
    def z(c):
        return F.coalesce(c, F.lit(0.0))

    off = F.abs(z("qty_ordered") - (z("qty_received") + z("qty_pending") + z("qty_rejected"))) > tolerance
    one = purchases.agg(
        F.count_if(off).alias("bad"), F.count(F.lit(1)).alias("lines"), F.count("master_sku").alias("matched")
    )
    return as_table(one, [
        check_row("PO lines balance (ordered = received + pending + rejected)", F.lit(0), F.col("bad"), 0.0, "REVIEW"),
        check_row("PO lines matched to a SKU in the master mapping table", F.col("lines"), F.col("matched"), 0.0, "REVIEW"),
    ])


def flow_checks(sales: DataFrame, marketplace: str = S.MARKETPLACE_CHANNEL) -> DataFrame:
    """Flows stay apart: nothing leaks between purchase, sell-in, sell-out and excluded rows."""
    at = F.col("channel") == marketplace
    known = F.col("master_sku").isNotNull()
    one = sales.agg(
        F.count_if(F.col("source_type") == "uniware_purchase_orders").alias("po_rows"),
        F.count_if(F.col("flow").isNull() | (F.col("flow") == "unknown")).alias("no_flow"),
        sum_if(at & (F.col("flow") == "sell_in"), "qty_sold").alias("si"),
        sum_if(at & (F.col("flow") == "sell_out"), "qty_sold").alias("so"),
        F.count_if(known & ~F.coalesce(F.col("flow").isin("exclude", "unknown"), F.lit(False))).alias("countable"),
        F.count_if(known & F.col("flow").isin("sell_in", "sell_out")).alias("counted"),
    )
    distinct = (F.col("si") > 0) & (F.col("so") > 0) & (F.col("si") != F.col("so"))
    apart = check_row(f"{marketplace} sell-in and sell-out kept as distinct measures", F.col("si"), F.col("so"))
    return as_table(one, [
        check_row("purchase rows kept out of the sales fact table", F.lit(0), F.col("po_rows"), 0.0),
        check_row("every fact row has a flow (sell_in/sell_out/exclude)", F.lit(0), F.col("no_flow"), 0.0),
        apart.withField("result", F.when(distinct, "PASS").otherwise("REVIEW")),
        check_row("excluded ledgers not counted in channel totals", F.col("countable"), F.col("counted"), 0.0),
    ])


def agreement(df: DataFrame, rules: Sequence[tuple[str, Column, Column, float]]) -> DataFrame:
    """Share of rows where a recomputed value equals the given one.

    ``rules`` holds (name, condition 'comparable', condition 'agrees', floor in percent).
    """
    one = df.agg(
        *[F.count_if(valid).alias(f"n{i}") for i, (_, valid, _, _) in enumerate(rules)],
        *[F.count_if(valid & F.coalesce(ok, F.lit(False))).alias(f"k{i}") for i, (_, valid, ok, _) in enumerate(rules)],
    )
    rows = []
    for i, (name, _, _, floor) in enumerate(rules):
        share = F.coalesce(F.try_divide(F.col(f"k{i}") * F.lit(100.0), F.col(f"n{i}").cast("double")), F.lit(0.0))
        rows.append(F.struct(
            F.lit(name).alias("rule"), F.col(f"k{i}").alias("matched"), F.col(f"n{i}").alias("of"),
            round_half_even(share, 1).alias("pct"), F.when(share >= floor, "PASS").otherwise("FAIL").alias("result"),
        ))
    return as_table(one, rows)


def equal_within(left: Column, right: Column, tolerance: float = 0.01) -> tuple[Column, Column]:
    return left.isNotNull() & right.isNotNull(), F.abs(left - right) <= tolerance


def mismatches(df: DataFrame, key: str, given: Column, computed: Column) -> DataFrame:
    """The rows a rule cannot reproduce, both values side by side."""
    return df.select(F.col(f"`{key}`").alias("item"), given.alias("given"), computed.alias("computed")).filter(
        "given is not null and computed is not null and given <> computed"
    )


def source_presence(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Newest file per expected source, or a FAIL row where there is none.

    ``files``: path, name, modified, readable. ``expected``: source, folded_name
    (a config table). The match is a substring test on folded names.
    """
    folded = files.withColumn("folded", F.regexp_replace(F.lower("name"), "[\\s_\\-]+", ""))
    newest = (
        folded.join(F.broadcast(expected), F.col("folded").contains(F.col("folded_name")))
        .groupBy("source").agg(F.max_by(F.struct("name", "readable"), F.struct("modified", "name")).alias("file"))
    )
    return expected.select("source").join(newest, "source", "left").select(
        "source", F.col("file.name").alias("file"),
        F.when(F.col("file").isNull(), "source file not found").when(~F.col("file.readable"), "not readable")
        .otherwise("present").alias("state"),
        F.when(F.col("file.readable"), "PASS").otherwise("FAIL").alias("result"),
    )
