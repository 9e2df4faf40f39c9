"""Row operators on small fixtures, skewed ones included."""

import datetime as dt
import random

from pyspark.sql import functions as F

from stockweave import schemas as S
from stockweave.operators import facts as O
from stockweave.operators import lifecycle as L
from stockweave.operators import overrides as N
from stockweave.operators import resolve as R
from stockweave.plans import alerts as A
from stockweave.plans import facts as FP
from stockweave.plans import merchandising as M
from stockweave.plans import reports as P
from stockweave.plans import verification as V
from stockweave.queries import catalog


def master(spark):
    rows = [
        (1, "S1", "STYLE-A", "B1", None, 11.0), (2, "S2", "STYLE-A", "B2", "F2", None), (3, " s3 ", "STYLE-B", None, "S1", 33.0),
        (4, "S4", None, "DUP", None, None), (5, "S5", "STYLE-C", "DUP", None, None), (6, None, "STYLE-D", "B6", None, None),
    ]
    return spark.createDataFrame(rows, "row_seq long, `Sku Code` string, `Item Name` string, `AZ ASIN` string, `FK SKU` string, `Jio code` double")


def resolve_all(spark, ids, kind="az_asin"):
    facts = spark.createDataFrame([(i, v, kind) for i, v in enumerate(ids)], "qty int, external_id string, external_id_type string")
    out = R.resolve(facts, R.build_lookup(master(spark)))
    return {r.qty: (r.matched_via, r.master_sku, r.style_code) for r in out.collect()}


def test_resolve_ladder(spark):
    got = resolve_all(spark, ["b1", "S2", " f2", "STYLE-A", "nope", None, "DUP", "33", "S1", "B6"])
    assert got[0] == ("az_asin", "S1", "STYLE-A")      # declared
    assert got[1] == ("sku_code", "S2", "STYLE-A")     # fallback
    assert got[2] == ("fk_sku", "S2", "STYLE-A")
    assert got[3] == ("style_code", None, "STYLE-A")   # style only
    assert got[4] == got[5] == (None, None, None)
    assert got[6] == ("az_asin", "S4", None)           # first master row wins
    assert got[7] == ("jio_code", "S3", "STYLE-B")     # numeric ids lose the fraction
    assert got[8] == ("sku_code", "S1", "STYLE-A")     # sku_code comes before fk_sku
    assert got[9] == (None, None, None)                # a master row without a SKU gives nothing
    assert resolve_all(spark, ["S1"], "fk_sku")[0] == ("fk_sku", "S3", "STYLE-B")


def test_resolve_keeps_every_row_of_a_hot_id_and_of_nulls(spark):
    hot = spark.range(60_000).select(
        F.col("id").alias("qty"),
        F.when(F.col("id") % 3 == 0, "B1").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("Z"), "id")).alias("external_id"),
        F.lit("az_asin").alias("external_id_type"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        out = R.resolve(hot, R.build_lookup(master(spark)))
        got = {r.matched_via: r.n for r in out.groupBy("matched_via").agg(F.count(F.lit(1)).alias("n")).collect()}
        placed = R.resolve(hot, R.build_lookup(master(spark))).withColumn("p", F.spark_partition_id())
        nulls = placed.filter("external_id is null").groupBy("p").count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert got == {"az_asin": 20_000, None: 40_000}
    assert len(nulls) > 1  # null keys do not meet in one task


def test_value_basis(spark):
    rows = [(10.0, None, 1.0, 7.0), (0.0, 5.0, 1.0, 7.0), (None, 0.0, 2.0, 7.0), (None, None, None, 7.0), (None, None, 2.0, None)]
    df = spark.createDataFrame(rows, "net_value double, gross_value double, qty_sold double, mrp double")
    assert [tuple(r) for r in O.value_basis(df).select("net_value", "value_basis").collect()] == [
        (10.0, "as_reported"), (5.0, "gross_fallback"), (14.0, "imputed_mrp"), (None, "as_reported"), (None, "as_reported")]


def test_ledger_map(spark):
    df = spark.createDataFrame([(" myntrappmp ",), ("J&J_KOHIMA_B2B",), ("new one",), (None,)], "ledger string")
    got = [tuple(r) for r in O.map_ledger(df).select("channel", "channel_type", "flow").collect()]
    assert got == [("Myntra", "marketplace", "sell_in"), ("Jack & Jill", "retail_store", "sell_in"), ("new one", "unknown", "unknown"), (None, "unknown", "unknown")]


def test_drop_total_rows(spark):
    keys = ["Grand Total", "grandtotal", "Total", "Totally", "Sum of Qty", "Summer", None, "S1"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert [r.k for r in O.drop_total_rows(df, "k").collect()] == ["Totally", "Summer", "S1"]


def test_facility_scope(spark):
    df = spark.createDataFrame([("f", " wh1"), ("f", None), ("f", "wh2"), ("f", "wh3"), ("g", "wh9")], "source_file string, facility string")
    assert O.facility_rows(df, "facility", "WH1").count() == 2
    got = {r.source_file: (r.rows_dropped, r.facilities_found) for r in O.facility_drops(df, "facility", "wh1").collect()}
    assert got == {"f": (2, "WH2, WH3"), "g": (1, "WH9")}


def test_overrides(spark):
    raw = spark.createDataFrame([
        (1, "s1", "A", "note1", ""), (2, "S1", "A", "later", ""), (3, "", "a", "stylenote", "styleRe"), (4, "S2", "A", " ", " "), (5, "S3", "A", "", "x"),
    ], "row_seq int, `Sku Code` string, `Item Name` string, `Style Re-order Status` string, `Reorder Status` string")
    by_sku, by_style = N.split_overrides(raw)
    skus = spark.createDataFrame([("S1", "A"), ("S2", "A"), ("S3", "A"), ("S9", "B")], "`Sku Code` string, `Item Name` string")
    got = {r[0]: (r[2], r[3]) for r in N.apply_overrides(skus, by_sku, by_style).collect()}
    assert got == {"S1": ("note1", "styleRe"), "S2": ("stylenote", "styleRe"), "S3": ("stylenote", "x"), "S9": ("", "")}


def state(spark, rows):
    return spark.createDataFrame(rows, L.empty_state(spark).schema)


def test_alert_diff(spark):
    cur = spark.createDataFrame([("a|1", "a", "1", "A", "i", 5.0), ("a|2", "a", "2", "A", "i", 6.0)], "key string, alert string, sku string, label string, item string, priority double")
    prev = state(spark, [("a|1", "a", "1", "A", "i", "r0", 3, 1.0), ("b|9", "b", "9", "B", "i", "r0", 2, 1.0)])
    got = {r.key: (r.status, r.first_seen, r.cycles) for r in L.alert_diff(cur, prev, "r1").collect()}
    assert got == {"a|1": ("ONGOING", "r0", 4), "a|2": ("NEW", "r1", 1), "b|9": ("RESOLVED", "r0", 2)}
    assert {r.status for r in L.alert_diff(cur, L.empty_state(spark), "r1").collect()} == {"NEW"}
    gone = L.alert_diff(cur.limit(0), prev, "r1")
    assert {r.status for r in gone.collect()} == {"RESOLVED"} and L.next_state(gone).count() == 0


def test_history_is_order_free_and_idempotent(spark):
    rows = [("P1", "S1", 1, "2026-01-01"), ("P1", "S1", 2, "2026-02-01"), ("P1", "S2", 3, None), ("P1", "S2", 4, "2025-01-01"), (None, "S3", 5, "2026-01-01")]
    schema = "po string, sku string, qty int, upd string"
    keys, order = ["po", "sku"], ["upd", "qty"]
    want = {("P1", "S1"): 2, ("P1", "S2"): 4}
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, schema)
        once = L.merge_history(None, df, keys, order)
        assert {(r.po, r.sku): r.qty for r in once.collect()} == want
        again = L.merge_history(once, df, keys, order)
        assert {(r.po, r.sku): r.qty for r in again.collect()} == want


def test_history_survives_a_hot_key(spark):
    df = spark.range(90_000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as po", "'s' as sku", "id as qty")
    out = L.merge_history(None, df, ["po", "sku"], ["qty"])
    assert out.count() == 60_001 and out.filter("po = 'hot'").first().qty == 89_997
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # rows are thinned before the shuffle as well


def test_retired_never_takes_the_history(spark):
    prev = spark.createDataFrame([(1, "a.csv"), (2, "b.csv"), (3, "Purchase_Orders_history.csv")], "file_id int, name string")
    cur = spark.createDataFrame([(1,)], "file_id int")
    assert [r.name for r in L.retired(prev, cur, "Purchase_Orders_history.csv").collect()] == ["b.csv"]


FRAME = dict(
    sku="S", item="I", category="", gender="", ageing="0-1 month", movement="", overall_movement="", inv_level="IN-STOCK", inv_status="in stock",
    reorder_status="", style_reorder="", stock=10.0, monthly_ros=0.0, ros_month=0.0, net_sale=0.0, returns=0.0, overall_sale=0.0, overall_ret=0.0,
    sell_through=0.0, last15_sales=0.0, for_3_months=0.0, purchase_qty=0.0, demand_rate=0.5, daily_rate=0.0, cover_days=None, return_rate=None,
    value_at_risk=0.0, value_basis="none", unit_price=0.0, revenue_at_risk=0.0,
)


def raised(spark, rule, cfg=None, **over):
    row = {**FRAME, **over}
    kinds = ", ".join(f"{k} {'double' if isinstance(FRAME[k], float) or FRAME[k] is None else 'string'}" for k in row)
    df = spark.createDataFrame([tuple(row.values())], kinds)
    return [r.reason for r in A.evaluate(df, {"alerts": {rule: cfg if cfg is not None else S.DEFAULT_RULES["alerts"][rule]}}).collect()]


def test_low_stock_rule(spark):
    assert raised(spark, "low_stock", cover_days=20.9) == ["21 days of cover left (floor is 21)"]
    assert raised(spark, "low_stock", cover_days=21.0) == []
    assert raised(spark, "low_stock", cover_days=5.0, demand_rate=0.4) == []
    assert raised(spark, "low_stock", inv_status="Low Stock") == ["flagged low stock in the workbook"]
    assert raised(spark, "low_stock", inv_status="low stock", stock=0.0) == []


def test_other_rules(spark):
    assert raised(spark, "out_of_stock", stock=0.0) == ["sells ~0.5/month, stock is zero"]
    assert raised(spark, "reorder_level", inv_level="REORDER", for_3_months=30.0) == ["at reorder point — 10 on hand vs 30 needed for 3 months"]
    assert raised(spark, "reorder_level", inv_level="REORDER", reorder_status=" PO Raised") == []
    assert raised(spark, "high_returns", return_rate=0.2, overall_sale=4.0, overall_ret=1.0) == ["20% returned (1.0 of 5.0)"]
    assert raised(spark, "high_returns", {"return_rate": 0.15}, return_rate=0.2, overall_sale=4.0, overall_ret=1.0) == []
    assert raised(spark, "dead_stock", movement="No Movement", ageing=">1 year", stock=1234.0) == ["no sales, 1,234 units sitting over 1 year"]
    assert raised(spark, "stock_ageing", ageing=">2 years", stock=4.0) == []


def test_unknown_and_disabled_rules_are_skipped():
    rules = {"alerts": {"nonsense": {}, "low_stock": {"enabled": False}, "dead_stock": None}}
    assert list(A.active_rules(rules)) == ["dead_stock"]


def test_tie_out_flags_a_difference(spark):
    a = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    rows = V.tie_out(a, a.limit(1), [("sum", F.sum("v"), F.sum("v"), 1.0), ("rows", F.count(F.lit(1)), F.count(F.lit(1)), 0.0)]).collect()
    assert [(r.check, r.result) for r in rows] == [("sum", "FAIL"), ("rows", "FAIL")]


def test_price_list_takes_the_last_row(spark):
    df = spark.createDataFrame([("S1", 5.0, 1), ("S1", 7.0, 2), (None, 9.0, 3)], "sku string, price double, row_seq int")
    assert [(r.master_sku, r.mrp) for r in FP.price_list(df, "sku", "price").collect()] == [("S1", 7.0)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_meet_the_lookup_unsorted(spark):
    facts = spark.range(100).selectExpr("id as qty", "concat('B', id) as external_id", "'az_asin' as external_id_type")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(R.resolve(facts, R.build_lookup(master(spark))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def fact_rows(spark):
    """A SKU of two styles, one never sold, one sold only, and rows without a SKU."""
    stamp = "timestamp_ntz'2001-07-20 00:00:00'"
    sales = spark.sql(f"""select *, 'sell_out' as flow, {stamp} as period_start, {stamp} as period_end, 1.0D as qty_returned from values
        ('S1', 'A', 'Shop', 'd2c', 2.0D, 10.5D), ('S1', 'B', 'Shop', 'd2c', 3.0D, 1.25D), ('S1', 'A', 'Amazon Vendor Central', 'marketplace', 4.0D, cast(null as double)),
        ('S3', cast(null as string), 'Shop', 'd2c', 1.0D, 1.0D), (null, 'Z', 'Shop', 'd2c', 9.0D, 9.0D)
        as t(master_sku, style_code, channel, channel_type, qty_sold, net_value)""")
    stock = spark.sql("""select * from values ('S1', 'A', 'Warehouse', 5.0D, 7.0D), ('S1', 'C', 'INCS', 1.0D, null), ('S2', 'D', 'INCS', 2.0D, 3.0D), (null, 'Y', 'INCS', 8.0D, 8.0D)
        as t(master_sku, style_code, channel, qty_on_hand, value_on_hand)""")
    bought = spark.sql(f"""select *, {stamp} as created_date, 'A' as style_code, qty_ordered as qty_pending, 0.0D as qty_received, 1.5D as total
        from values ('S1', 6.0D), ('S1', 1.0D), ('S2', 1.0D), (null, 7.0D) as t(master_sku, qty_ordered)""")
    return sales, stock, bought


def test_sku_measures_hash_the_rows_and_take_the_largest_style(spark):
    sales, stock, bought = fact_rows(spark)
    out = M.sku_measures(sales, stock, bought, dt.date(2001, 8, 1))
    got = {r["Sku Code"]: r for r in out.collect()}
    assert {k: r["Item Name"] for k, r in got.items()} == {"S1": "C", "S2": "D", "S3": None}
    assert [got["S1"][c] for c in ("Sale", "Coco-OR SALES", "D8 inv", "INCS inv", "Purchase. qty", "_so_net", "_stock_value", "_all_sold")] == [5.0, 4.0, 5.0, 1.0, 7.0, 11.75, 7.0, 9.0]
    assert got["S2"]["_so_net"] is None and got["S2"]["Sale"] == 0.0 and got["S3"]["_first_po"] is None and got["S1"]["_first_po"] is not None
    assert plan_of(out).count("HashAggregate(keys=[master_sku") >= 6  # rows of the three facts, before and after the shuffle


def test_sku_reports_hash_the_rows(spark):
    sales, stock, bought = fact_rows(spark)
    report, cover = P.sku(sales, stock), P.po_sku(bought, stock, sales)
    rows = {r.master_sku: r for r in report.collect()}
    assert [rows["S1"][c] for c in ("style_code", "channels", "qty_sold_sell_out", "net_value_sell_out", "stock_on_hand")] == ["C", 2, 9.0, 11.75, 6.0] and set(rows) == {"S1", "S3"}
    rows = {r.master_sku: r for r in cover.collect()}
    assert [rows["S1"][c] for c in ("style_code", "on_order", "stock_on_hand", "sell_out_units", "po_value")] == ["C", 7.0, 6.0, 9.0, 3.0] and set(rows) == {"S1", "S2"}
    for df in (report, cover):
        assert "HashAggregate(keys=[master_sku" in plan_of(df)


def test_queries_write_no_whole_facts(spark, tmp_path):
    for name, sql in {
        "lineitem": """select 1L as l_orderkey, id as l_partkey, id as l_suppkey, cast(id as int) as l_linenumber, 3.0D as l_quantity, 5.0D as l_extendedprice, 0.1D as l_discount,
            0.0D as l_tax, 'N' as l_returnflag, 'O' as l_linestatus, timestamp_ntz'2001-07-01 00:00:00' as l_shipdate from range(1, 7)""",
        "orders": "select 1L as o_orderkey, 1L as o_custkey, 'O' as o_orderstatus, 1.0D as o_totalprice, timestamp_ntz'2001-07-01 00:00:00' as o_orderdate, '9-NEW' as o_orderpriority",
        "part": "select id as p_partkey, 'n' as p_name, 'b' as p_brand, 't' as p_type, 1 as p_size, 2.0D as p_retailprice from range(1, 7)",
    }.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    before = set(catalog._STORED)
    assert [r.channel for r in catalog.unknown_ledgers(spark, str(tmp_path)).collect()] == ["9-NEW/N"]
    assert {r.result for r in catalog.tie_out(spark, str(tmp_path)).collect()} == {"PASS"}
    assert set(catalog._STORED) == before
    catalog.sku_table(spark, str(tmp_path))
    assert {k[2] for k in set(catalog._STORED) - before} == {"sku-facts-sales", "sku-facts-inventory", "sku-facts-purchase", "svs-sku-2001-08-01"}
