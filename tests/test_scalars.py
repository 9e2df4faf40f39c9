"""Boundary cases of the scalar functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockweave import schemas as S
from stockweave.functions import classify as C
from stockweave.functions import dates as D
from stockweave.functions import numbers as N
from stockweave.functions import text as X


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_norm_id(spark):
    got = column(spark, [" ab ", "ＡＢ１", "nan", "None", "NaT", "", None, " x ", "ﬁ½", "é", "é"], X.norm_id("v"))
    assert got == ["AB", "AB1", None, None, None, None, None, "X", "FI1⁄2", "É", "É"]


def test_norm_keeps_words_norm_id_drops(spark):
    assert column(spark, [" ab", "none", "NAN", "", None], X.norm("v")) == ["AB", "NONE", None, None, None]


def test_money(spark):
    got = column(spark, ["₹10,422.42", "0.00%", "-", " ", "1 234", "1 234", "$5", "€7.5", "12d", "nan", None, "-3"], N.money("v"))
    assert got == [10422.42, 0.0, None, None, 1234.0, 1234.0, 5.0, 7.5, None, None, None, -3.0]


def test_fmt(spark):
    got = column(spark, [None, 0.04, 9.94, 9.96, 10.5, 11.5, 12345.5, -12.0], N.fmt("v"), "double")
    assert got == ["—", "0.0", "9.9", "10.0", "10", "12", "12,346", "-12"]


def test_round_half_even(spark):
    assert column(spark, [0.5, 1.5, -0.2, 2.5], N.round_half_even("v"), "double") == [0.0, 2.0, 0.0, 2.0]


def test_folding(spark):
    assert column(spark, ["PO  Code_1-x"], X.fold("v")) == ["pocode1x"]
    assert column(spark, [" Amazon--VC "], X.fold_words("v")) == ["amazon vc"]
    assert column(spark, ["Inventory_Snap-shot 1"], X.fold_separators("v")) == ["inventorysnapshot1"]
    assert X.clean_header('  "Sku Code" ') == "Sku Code"


def test_period_from_name(spark):
    names = [
        "Sales_01-06-2026_30-06-2026.csv", "Sales_2026-06-01_2026-06-30.csv", "soh 5-8-2026.csv", "soh 2026-08-05.csv",
        "none.csv", "99-99-2026.csv", "x 2026-08-01_31-08-2026.csv",
    ]
    got = column(spark, names, D.period_from_name("v"))
    day = dt.date
    assert [(g["start"], g["end"]) if g else None for g in got] == [
        (day(2026, 6, 1), day(2026, 6, 30)), (day(2026, 6, 1), day(2026, 6, 30)), (day(2026, 8, 5), day(2026, 8, 5)),
        (day(2026, 8, 5), day(2026, 8, 5)), None, None, (day(2026, 8, 31), day(2026, 8, 31)),
    ]


def test_parse_when(spark):
    got = column(spark, ["2026-08-03 16:22:52", "03/08/2026", "03-08-2026 6:05", "2026-08-03", "nope", None, "08/25/2026", "2026-13-01"], D.parse_when("v"))
    t = dt.datetime
    assert got == [t(2026, 8, 3, 16, 22, 52), t(2026, 8, 3), t(2026, 8, 3, 6, 5), t(2026, 8, 3), None, None, t(2026, 8, 25), None]


def test_parse_dates_decides_per_column(spark):
    rows = [("a", "2026-01-02")] * 9 + [("a", "05-02-2026")] + [("b", "2026-01-02")] + [("b", "05-02-2026")]
    df = spark.createDataFrame(rows, "f string, d string")
    got = {(r.f, r.d): r.p for r in D.parse_dates(df, "d", by="f", into="p").collect()}
    assert got[("a", "05-02-2026")] is None and got[("a", "2026-01-02")] == dt.datetime(2026, 1, 2)
    assert got[("b", "05-02-2026")] == dt.datetime(2026, 2, 5) and got[("b", "2026-01-02")] == dt.datetime(2026, 1, 2)


def test_season_date(spark):
    got = column(spark, ["AW24FES0MTS11BE", "ss25-x", "ABC8-AW-M-TS-24", "SS10A", "plain", None], D.season_date("v"))
    assert got == [dt.date(2024, 8, 1), dt.date(2025, 2, 1), dt.date(2023, 8, 1), None, None, None]


def test_month_to_period(spark):
    p = D.month_to_period("v", F.lit(dt.date(2026, 3, 10)))
    got = column(spark, ["March", "apr", "FEB", "zzz"], p)
    assert [(g["start"], g["end"]) for g in got] == [
        (dt.date(2026, 3, 1), dt.date(2026, 3, 31)), (dt.date(2025, 4, 1), dt.date(2025, 4, 30)),
        (dt.date(2026, 2, 1), dt.date(2026, 2, 28)), (dt.date(2025, 1, 1), dt.date(2025, 1, 31)),
    ]


def test_snapshot_dates(spark):
    assert column(spark, ["Soh As on 17th Aug 2026", "3 Sept 2026", "none"], D.worded_date("v")) == [dt.date(2026, 8, 17), dt.date(2026, 9, 3), None]
    got = column(spark, ["Stock_17082026093015", "Stock 17-08-2026", "Stock_99992026093015"], D.warehouse_snapshot("v"))
    assert got == [dt.datetime(2026, 8, 17, 9, 30, 15), dt.datetime(2026, 8, 17), None]


def test_labels_and_windows():
    assert D.period_label(dt.date(2026, 6, 3), dt.date(2026, 8, 1)) == "Jun-Aug"
    assert D.period_label(dt.date(2026, 6, 3), dt.date(2026, 6, 30)) == "Jun"
    assert D.windows(dt.date(2026, 8, 1)) == (dt.date(2026, 6, 3), dt.date(2026, 7, 18))


def test_ageing_bucket(spark):
    days = [-5, 0, 31, 32, 92, 93, 183, 184, 274, 275, 365, 366, 730, 731, None]
    assert column(spark, days, C.ageing_bucket("v"), "int") == [
        "0-1 month", "0-1 month", "0-1 month", "1-3 months", "1-3 months", "3-6 months", "3-6 months", "6-9 months", "6-9 months",
        "9-12 months", "9-12 months", ">1 year", ">1 year", ">2 years", None,
    ]


def test_movement(spark):
    st = [-0.1, 0.0, 0.15, 0.1501, 0.25, 0.2501, None]
    assert column(spark, st, C.movement("v", "'0-1 month'"), "double") == [
        "No Movement", "No Movement", "Slow Movement", "Good Movement", "Good Movement", "Fast Movement", None]
    assert column(spark, [0.5], C.movement("v", "cast(null as string)"), "double") == [None]


def test_inventory_status(spark):
    assert column(spark, [0.0, 3.0, 4.0, None], C.inventory_status("v", "0.0D"), "double") == ["no stock", "in stock", "over stock", "no stock"]
    assert column(spark, [1.49, 1.5, 2.99, 3.0], C.inventory_status("v", "1.0D"), "double") == ["low stock", "in stock", "in stock", "over stock"]
    assert column(spark, [4.0], C.inventory_status("v", "cast(null as double)"), "double") == ["over stock"]


@pytest.mark.parametrize("recent,overall,want", [
    ("Fast Movement", "Good Movement", "Improving"), ("Slow Movement", "Good Movement", "Slowing Down"),
    ("No Movement", "Slow Movement", "Recovering"), ("Good Movement", "Good Movement", "Stable"), (None, "Good Movement", None),
])
def test_stability(spark, recent, overall, want):
    df = spark.createDataFrame([(recent, overall)], "a string, b string")
    assert df.select(C.stability("a", "b")).first()[0] == want


def test_channel_map_is_extendable():
    table = S.channel_map_with(["myshop"])
    assert table["MYSHOP"] == ("D2C Website", "d2c", "sell_out") and "MYSHOP" not in S.CHANNEL_MAP


def test_to_local(spark):
    df = spark.sql("select timestamp'2026-08-01 19:36:00' as t")
    assert df.select(D.to_local("t").cast("string")).first()[0] == "2026-08-02 01:06:00"
