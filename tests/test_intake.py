"""Files on disk to facts: detection, duplicates, encodings, adapters, tie-out."""

import csv
import datetime as dt
import io
import os
import random
import threading

import pytest

from stockweave import schemas as S
from stockweave.plans import facts as FP
from stockweave.plans import merchandising as M
from stockweave.plans.reports import fact_exceptions
from stockweave.plans.cycle import run_cycle
from stockweave.session import together, work_dir
from stockweave.sinks.publish import write_facts
from stockweave.sources import adapters as A
from stockweave.sources import detect as D
from stockweave.sources import scan as C
from stockweave.sources import tables as B
from stockweave.sources.intake import load_folder

MASTER = [
    (1, "TS-1", "TEE AW24", "B001", 11.0), (2, "TS-2", "TEE AW24", "B002", None), (3, "SH-1", "SHOE SS25", "B003", None),
]


def put(path, text, encoding="utf-8", when=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    if when:
        os.utime(path, (when, when))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("in put")
    put(root / "amazon vc/Sales_ASIN_01-06-2026_30-06-2026.csv",
        'Program=[Retail],View=[x]\nASIN,Ordered Units,Shipped Units,Customer Returns,Ordered Revenue,Shipped COGS\nB001,5,4,1,"₹1,000.50",₹0.00\nB999,1,1,0,₹10,₹9\n')
    put(root / "amazon vc/Inventory_ASIN_2026-07-31.csv",
        'Program=[Retail]\nASIN,Sellable On Hand Units,Sellable On-Hand Inventory,Unfilled Customer Ordered Units,Shipped Units\nB002,7,"₹2,100",0,1\n')
    gst = "Product SKU Code,Channel Ledger,Qty,Total,Sales,Date\nTS-1,MYNTRAPPMP,2,200,180,2026-07-01 10:00:00\nTS-2,SNAPMINT,1,100,,2026-07-20\nXX,Mystery,1,50,40,2026-07-21\n"
    put(root / "uniware/Tally GST.csv", gst, when=1_770_000_000)
    put(root / "uniware/Tally GST old.csv", gst + "TS-1,PROMO,9,900,900,2026-06-01\n" * 40, when=1_760_000_000)
    put(root / "uniware/Tally GST copy.csv", gst, when=1_770_000_000)
    put(root / "uniware/returns.csv", "Channel Ledger,Qty,Total,Date\nSNAPMINT,3,300,05-07-2026\nSNAPMINT,1,100,25-07-2026\n")
    put(root / "uniware/Inventory Snapshot_31072026093000__WH1.csv", "Item SkuCode,Facility,Inventory,MRP\nTS-1,WH1,10,500\nTS-2,WH2,3,400\nSH-1,,2,900\n")
    put(root / "uniware/Inventory Snapshot__WH2.csv", "Item SkuCode,Facility,Inventory,MRP\nTS-1,WH2,99,500\n")
    put(root / "uniware/Purchase Orders.csv",
        "﻿PO Code,Item SkuCode,Purchase Order Status,Created,Vendor Name,Facility,Order Quantity,Recieved Quantity,Rejected Quantity,Pending Quantity,Total\n"
        "PO1,TS-1,APPROVED,2026-05-01,\"Café, Ltd\",WH1,20,5,0,15,\"2,000\"\nPO2,SH-1,COMPLETE,2026-04-01,Acme,WH2,10,10,0,0,900\n", encoding="utf-8")
    put(root / "uniware/Item Master.csv", "Product Code,Category Code,Category Name,Gender,MRP,Year\nTS-1,T,Tees,Men,500,2024\n")
    put(root / "stores/jj SaleReport_26-07-2026.csv",
        "Row Labels,Grand Total,KOHIMA,,DIMAPUR,\n,Sum of Sold Qty,Sold Qty,Value,Sold Qty,Value\nTS-1,3,2,200,1,100\nSH-1,0,0,0,,\nGrand Total,3,2,200,1,100\n", encoding="cp1252")
    put(root / "stores/jj SOHReport_26-07-2026.csv", "Stock as of,,\nRow Labels,KOHIMA \x96 main,Grand Total\nTS-2,6,6\nGrand Total,6,6\n", encoding="latin-1")
    put(root / "stores/random.csv", "a,b\n1,2\n")
    put(root / "_archive/Tally GST.csv", gst)
    put(root / "uniware/~$lock.csv", "x\n")
    put(root / "reorder_status.csv", "Sku Code,Item Name\n")
    return str(root)


@pytest.fixture(scope="module")
def lookup(spark):
    master = spark.createDataFrame(MASTER, "row_seq int, `Sku Code` string, `Item Name` string, `AZ ASIN` string, `Jio code` double")
    prices = spark.createDataFrame([("TS-1", 500.0), ("TS-2", 400.0)], "master_sku string, mrp double")
    return FP.lookup_for(master, prices)


SHEETS = [
    ("All Sports July.xlsx", "Sale Report", 0, ["All Sports", None, None]),
    ("All Sports July.xlsx", "Sale Report", 1, ["Principal Code", "Invoice Date", "Total Sales Qty", "Invoice MRP Value", "Invoice Basic Value"]),
    ("All Sports July.xlsx", "Sale Report", 2, ["TS-1", "21/07/2026", "2", "1000", "800"]),
    ("All Sports July.xlsx", "Sale Report", 3, ["Grand Total", "", "2", "1000", "800"]),
    ("All Sports July.xlsx", "Soh", 0, ["Soh As on 17th Jul 2026"]),
    ("All Sports July.xlsx", "Soh", 1, ["Principal Code", "Total Stock On Hand"]),
    ("All Sports July.xlsx", "Soh", 2, ["TS-2", "4"]),
    ("notes.xlsx", "Sheet1", 0, ["hello"]),
]


@pytest.fixture(scope="module")
def loaded(spark, folder, lookup):
    cells = spark.createDataFrame(SHEETS, S.RAW_CELLS)
    got = load_folder(spark, folder, lookup, facility="WH1", raw_cells=cells)
    out = work_dir(spark, "test-facts")
    write_facts(out, got.sales, got.inventory, got.purchases)
    got.sales, got.inventory, got.purchases = B.load_facts(spark, out)
    return got


def test_scan_skips_what_is_not_input(spark, folder):
    names = {r.name for r in C.scan_inputs(spark, folder).select("name").collect()}
    assert "random.csv" in names and len(names) == 13
    assert not names & {"~$lock.csv", "reorder_status.csv"}


def test_superseded_and_skipped(loaded):
    lost = {r.file: r.reason for r in loaded.superseded.collect()}
    assert set(lost) == {"Tally GST old.csv", "Tally GST copy.csv", "Inventory Snapshot__WH2.csv"} or set(lost) == {
        "Tally GST old.csv", "Tally GST.csv", "Inventory Snapshot__WH2.csv"}
    assert "WARNING: the superseded file is larger" in lost["Tally GST old.csv"]
    assert lost["Inventory Snapshot__WH2.csv"].startswith("facility WH2")
    skipped = {r.file: r.reason for r in loaded.skipped.collect()}
    assert skipped["random.csv"] == "no rule matched" and skipped["notes.xlsx"] == "no profile matched this sheet"
    assert skipped["Item Master.csv"].startswith("dimension file")


def test_sales_facts(loaded):
    rows = loaded.sales.collect()
    assert [(f.name, f.dataType) for f in loaded.sales.schema] == [(f.name, f.dataType) for f in S.FACT_SALES]
    by = {}
    for r in rows:
        by.setdefault(r.source_type, []).append(r)
    amazon = {r.external_id: r for r in by["amazon_vc_sales"]}
    assert amazon["B001"].net_value == 1000.5 and amazon["B001"].value_basis == "gross_fallback" and amazon["B001"].master_sku == "TS-1"
    assert amazon["B001"].period_start == dt.datetime(2026, 6, 1) and amazon["B001"].period_end == dt.datetime(2026, 6, 30)
    assert amazon["B999"].matched_via is None
    gst = {r.external_id: r for r in by["uniware_tally_gst"]}
    assert len(gst) == 3 and gst["TS-1"].flow == "sell_in" and gst["XX"].flow == "unknown" and gst["XX"].channel == "Mystery"
    assert gst["TS-2"].value_basis == "gross_fallback" and gst["TS-1"].period_start == dt.datetime(2026, 7, 1, 10)
    back = by["uniware_returns"]
    assert sorted(r.qty_returned for r in back) == [1.0, 3.0] and {r.external_id for r in back} == {None}
    assert sorted(r.period_start for r in back) == [dt.datetime(2026, 7, 5), dt.datetime(2026, 7, 25)]
    blocks = {r.location: r for r in by["store_blocks"]}
    assert set(blocks) == {"KOHIMA", "DIMAPUR"} and blocks["KOHIMA"].qty_sold == 2.0 and blocks["KOHIMA"].value_basis == "imputed_mrp"
    assert blocks["KOHIMA"].net_value == 1000.0 and blocks["KOHIMA"].period_start == dt.datetime(2026, 7, 20)
    flat = by["store_flat"]
    assert len(flat) == 1 and flat[0].source_file == "All Sports July.xlsx::Sale Report" and flat[0].period_start == dt.datetime(2026, 7, 21)


def test_inventory_and_purchase_facts(loaded):
    inv = {(r.source_type, r.external_id): r for r in loaded.inventory.collect()}
    assert inv[("amazon_vc_inventory", "B002")].value_on_hand == 2100.0
    assert inv[("uniware_inventory", "TS-1")].value_on_hand == 5000.0 and ("uniware_inventory", "TS-2") not in inv
    assert inv[("uniware_inventory", "SH-1")].location is None
    assert inv[("uniware_inventory", "TS-1")].snapshot_date == dt.datetime(2026, 7, 31, 9, 30)
    assert inv[("store_matrix_soh", "TS-2")].location == "KOHIMA – main"  # code page 1252 dash
    assert inv[("store_flat_soh", "TS-2")].snapshot_date == dt.datetime(2026, 7, 17)
    po = loaded.purchases.collect()
    assert [(r.po_code, r.vendor, r.total, r.qty_received) for r in po] == [("PO1", "Café, Ltd", 2000.0, 5.0)]
    drops = {r.source_file: r.rows_dropped for r in loaded.facility_drops.collect()}
    assert drops == {"Purchase Orders.csv": 1, "Inventory Snapshot_31072026093000__WH1.csv": 1}
    missing = {(r.source_file, r.external_id) for r in fact_exceptions(loaded.sales, loaded.inventory, loaded.purchases).collect()}
    assert ("Sales_ASIN_01-06-2026_30-06-2026.csv", "B999") in missing and len(missing) == 2


def test_full_cycle_publishes_and_tracks_alerts(spark, loaded, tmp_path):
    items = spark.createDataFrame([("TS-1", "Tees", "Men", 500.0, 2024.0)], "master_sku string, Category string, Gender string, MRP double, _year double")
    none = spark.createDataFrame([], "key string, `Style Re-order Status` string, `Reorder Status` string")
    facts = (loaded.sales, loaded.inventory, loaded.purchases)
    out = str(tmp_path / "out")
    first = run_cycle(spark, facts, items, (none, none), out, "run-1", dt.date(2026, 8, 1))
    assert {r.status for r in first["lifecycle"].collect()} == {"NEW"}
    state = spark.read.parquet(f"{out}/alert_state/run_id=run-1")
    second = run_cycle(spark, facts, items, (none, none), out, "run-2", dt.date(2026, 8, 1), state)
    assert {(r.status, r.cycles, r.first_seen) for r in second["lifecycle"].collect()} == {("ONGOING", 2, "run-1")}
    archived = spark.read.parquet(f"{out}/archive/sku_wise")
    assert {r.run_id for r in archived.select("run_id").distinct().collect()} == {"run-1", "run-2"}
    sheet = spark.read.parquet(f"{out}/latest/sku_wise")
    assert sheet.columns[:3] == ["Sku Code", "Item Name", "Category"] and "Overall Sell-through" in sheet.columns
    assert sheet.count() == 3 and len(M.SKU_LAYOUT) == len(sheet.columns) == 40
    again = B.load_facts(spark, f"{out}/facts")
    assert again[0].count() == loaded.sales.count() and again[0].schema["flow"].dataType.simpleString() == "string"


def test_classify_prefers_stock_over_sales(spark):
    both = ["asin", "sellable on hand units", "shipped units"]
    df = spark.createDataFrame([("a", "x.csv", both, None), ("b", "y.csv", ["p"], both), ("c", "jj salereport.csv", [], [])], "path string, name string, h0 array<string>, h1 array<string>")
    got = {r.path: (r.kind, r.header_row) for r in D.classify_source(df).collect()}
    assert got == {"a": ("amazon_vc_inventory", 0), "b": ("amazon_vc_inventory", 1), "c": ("store_blocks", 0)}


def test_two_sheets_of_one_file_and_two_stores_of_one_kind_stay(spark):
    t = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame([
        ("a", "w.xlsx", "store_flat", "Sale", t, 10, "d1", "p1"), ("a", "w.xlsx", "store_flat_soh", "Soh", t, 10, "d1", "p2"),
        ("b", "v.xlsx", "store_flat", "Sale", t, 11, "d2", "p3"),
    ], "path string, name string, kind string, sheet string, modified timestamp, bytes int, digest string, profile_id string")
    kept, lost = D.dedupe_files(df)
    assert kept.count() == 3 and lost.count() == 0


def test_combine_refuses_copies_and_other_headers(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    with pytest.raises(C.CombineError, match="header"):
        C.combine_same_schema({"a": a, "b": a.select("b", "a")})
    with pytest.raises(C.CombineError, match="same rows"):
        C.combine_same_schema({"a": a, "b": a.select("*")})


def test_fingerprint_and_skip(spark):
    files = spark.createDataFrame([("f", "n1", "1", "v", 1), ("f", "n2", "2", "v", 2)], "folder string, name string, file_id string, version string, bytes int")
    one = C.input_fingerprint(files, "r").first().fingerprint
    assert C.input_fingerprint(files.orderBy("name", ascending=False), "r").first().fingerprint == one
    assert C.input_fingerprint(files, "other rules").first().fingerprint != one
    assert C.input_fingerprint(files.limit(1), "r").first().fingerprint != one
    status = "fingerprint string, ok boolean, started int"

    def skip(rows, complete=True):
        return C.should_skip(C.input_fingerprint(files, "r"), spark.createDataFrame(rows, status), complete).first().skip

    assert skip([(one, True, 1)]) and not skip([(one, True, 1)], False)
    assert not skip([(one, True, 1), (one, False, 2)]) and not skip([("x", True, 1)]) and not skip([])


def test_alias_headers(spark):
    df = spark.createDataFrame([(" P1 ", "S1 ", 5, "keep")], "`PO Number` string, `Child SKU` string, `Qty Ordered` int, SKU string")
    out = B.alias_headers(df)
    assert out.columns == ["PO Code", "Item SkuCode", "Order Quantity", "SKU"] and out.first()[0] == "P1"
    real = spark.createDataFrame([("a", "b")], "`Item SkuCode` string, SKU string")
    assert B.alias_headers(real).columns == ["Item SkuCode", "SKU"]
    assert B.looks_like_po(df) and not B.looks_like_po(real)


@pytest.mark.parametrize("bits", [16, 1])
def test_records_follow_the_csv_rules_across_blocks(spark, monkeypatch, bits):
    # The csv module tells which lines make a record; lines are dealt over blocks of three, and blocks over parts of two.
    monkeypatch.setattr(C, "PART_BITS", bits)
    r, rows, want, open_ends = random.Random(4), [], {}, set()
    for n in range(60):
        lines = ["".join(r.choice('aa,""') for _ in range(r.randint(1, 7))) for _ in range(r.randint(1, 14))]
        rows += [(f"f{n}", i // 3, 1000 * (i // 3) + i, text) for i, text in enumerate(lines)]
        reader, at, found = csv.reader(x + "\n" for x in lines), 0, []
        for _ in reader:
            found.append("\n".join(lines[at : reader.line_num]))
            at = reader.line_num
        try:
            list(csv.reader((x + "\n" for x in lines), strict=False))
            text = "\n".join(lines) + "\n"
            closed = len(list(csv.reader(io.StringIO(text + "end,of\n")))) == len(found) + 1
        except csv.Error:
            closed = False
        want[f"f{n}"] = found if closed else lines
        if not closed:
            open_ends.add(f"f{n}")
    table = spark.createDataFrame(rows, "path string, block long, seq long, value string").repartition(5)
    got, unclosed = C.join_records(table, C.content_profile(table))
    by = {}
    for x in sorted(got.collect(), key=lambda x: (x.path, x.block, x.seq)):
        by.setdefault(x.path, []).append(x.value)
    assert {x.path for x in unclosed.collect()} == open_ends and 5 < len(open_ends) < 55
    assert by == want


def test_an_inch_mark_swallows_no_row(spark, tmp_path, lookup):
    head = "Product SKU Code,Channel Ledger,Qty,Total,Sales,Date\n"
    put(tmp_path / "Tally GST.csv", head + 'TS-1,MYNTRAPPMP,2,200,180,2026-07-01\nTV 32" flat,MYNTRAPPMP,1,9,9,2026-07-02\nTS-2,SNAPMINT,1,100,90,2026-07-03\n'
        + '"SH\n1",SNAPMINT,3,30,30,2026-07-04\nTS-1,SNAPMINT,1,5,5,2026-07-05\n')
    put(tmp_path / "Inventory Snapshot.csv", 'Item SkuCode,Facility,Inventory,MRP\n"TS-1,WH1,10,500\nTS-2,WH2,3,400\n')
    got = load_folder(spark, str(tmp_path), lookup)
    assert sorted((r.external_id, r.qty_sold) for r in got.sales.collect()) == [
        ("SH\n1", 3.0), ("TS-1", 1.0), ("TS-1", 2.0), ("TS-2", 1.0), ('TV 32" FLAT', 1.0)]
    assert {r.file: r.reason for r in got.skipped.collect()} == {"Inventory Snapshot.csv": "a quoted cell is never closed"} and got.inventory.count() == 0


def test_path_rules_of_every_line(spark):
    names = ["a.csv", "_x/a.csv", "in/_x/a.csv", "OLD/a.csv", "old.csv", "bold/a.csv", "in/Exports/b/a.csv", "my_x/a.csv", "x_/_a.csv", ".git/a.csv", "agit/a.csv", "~$a.csv", "a.txt"]
    df = spark.createDataFrame([(f"/r/in/{n}",) for n in names], "path string")
    got = [r[0].removeprefix("/r/in/") for r in df.filter(C.wanted(df.path, "/r/in")).collect()]
    assert sorted(got) == sorted(["a.csv", "old.csv", "bold/a.csv", "my_x/a.csv", "x_/_a.csv", "agit/a.csv"])


def test_path_rules_are_applied_once_per_file(spark, tmp_path):
    names = ["a b+%20[1].csv", "in/{x}*.CSV", "Old/a.csv", "_x/a.csv", "~$a.csv", "note.txt"]
    for n in names:
        put(tmp_path / "r 1" / n, f"h\n{n}\n")
    lines = C.read_lines(spark, str(tmp_path / "r 1"))
    files = {r.path for r in C.scan_inputs(spark, str(tmp_path / "r 1")).collect()}
    assert {(r.path, r.value) for r in lines.filter("value <> 'h'").collect()} == {(p, p.split("/r 1/")[1]) for p in files if p.lower().endswith(".csv")}
    assert len(files) == 2 and lines.count() == 4
    plan = lines._jdf.queryExecution().executedPlan().toString().lower()
    assert "rlike" not in plan and "regexp" not in plan and "decode" not in plan


def test_first_rows_are_taken_before_the_shuffle(spark):
    df = spark.createDataFrame([(f"p{n % 3}", 0, n, f"{n},x") for n in range(300)], "path string, block long, seq long, value string")
    head = C.head_rows(df, 2)
    assert "WindowGroupLimit" in head._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.path, r.row_idx, r.seq, r.cells) for r in head.collect()) == [(f"p{k}", i, k + 3 * i, [str(k + 3 * i), "x"]) for k in range(3) for i in range(2)]


def test_cells_are_picked_once_for_facts_and_accounts(spark, folder, lookup, monkeypatch):
    seen = []
    pick = A.pick_cells
    monkeypatch.setattr(A, "pick_cells", lambda rows, files, columns, check=False: seen.append(tuple(columns)) or pick(rows, files, columns, check))
    got = load_folder(spark, folder, lookup)
    read = [c for c in seen if len(c) > 2]  # list prices pick two columns of their own
    assert len(read) == len(set(read)) == 6 and {r.reason for r in got.rejects.collect()} <= {A.MORE_CELLS}


def test_steps_run_together(spark):
    both = threading.Barrier(2, timeout=30)
    assert together(lambda: (both.wait(), spark.range(3).count())[1], lambda: (both.wait(), "b")[1]) == [3, "b"]
    ended = []
    with pytest.raises(ZeroDivisionError):
        together(lambda: 1 / 0, lambda: ended.append(spark.range(5).count()))
    assert ended == [5] and together() == []


def test_rows_beyond_the_header(spark):
    rows = [(["a", "b", None], 2), (["a", "b", " "], 2), (["a", "b", "c"], 2), (["a", None, "c"], 1), (["a"], 3), (["a", "b"], None), ([], 0), (["x"], 0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, cells array<string>, width int")
    assert [r[0] for r in df.orderBy("i").select(A.fits()).collect()] == [True, True, False, False, True, True, True, False]


def test_heading_cells(spark):
    df = spark.createDataFrame([('Item,Size 32",Name',), ('"a, b", "c ",d',), ('"x ""y"", z",,"w"',)], "value string")
    got = [r[0] for r in df.select(C.split_cells(df.value)).collect()]
    assert got == [["Item", 'Size 32"', "Name"], ["a, b", "c", "d"], ['x ""y"", z', "", "w"]]
