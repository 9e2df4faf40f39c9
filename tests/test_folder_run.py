"""A folder of extracts to published tables: nothing is lost, and every outcome leaves a status row."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from stockweave import schemas as S
from stockweave.functions import numbers as N
from stockweave.operators.lifecycle import alert_diff, empty_state, merge_history, next_state
from stockweave.plans import facts as FP
from stockweave.plans.cycle import dashboard, report_set, run_folder, settings, verified
from stockweave.sinks import publish as W
from stockweave.sources import adapters as A
from stockweave.sources import scan as C
from stockweave.sources.intake import load_folder
from stockweave.streaming import alert_state as SA
from stockweave.streaming import po_history as SH
from tests.test_intake import MASTER, put

PO_HEADER = "PO Code,Item SkuCode,Purchase Order Status,Created,Vendor Name,Facility,Order Quantity,Recieved Quantity,Rejected Quantity,Pending Quantity,Total\n"
GST = "Product SKU Code,Channel Ledger,Qty,Total,Sales,Date\nTS-1,MYNTRAPPMP,2,200,180,2026-07-01 10:00:00\n"


@pytest.fixture(scope="module")
def lookup(spark):
    master = spark.createDataFrame(MASTER, "row_seq int, `Sku Code` string, `Item Name` string, `AZ ASIN` string, `Jio code` double")
    return FP.lookup_for(master, spark.createDataFrame([("TS-1", 500.0)], "master_sku string, mrp double"))


def test_purchases_only_with_breaks_in_cells(spark, lookup, tmp_path):
    root = tmp_path / "it's in"
    put(root / "Purchase Orders.CSV", PO_HEADER + 'PO1,TS-1,APPROVED,2026-05-01,"Acme\n\nLtd, ""the""\nbest",WH1,20,5,0,15,"2,000"\nPO2,TS-2,APPROVED,2026-05-02,Plain,WH1,1,0,0,1,10\n')
    put(root / "Books.xlsx", "not decoded")
    put(root / "output/Purchase Orders.csv", PO_HEADER + "PO9,TS-1,APPROVED,2026-05-01,Old,WH1,99,0,0,99,1\n")
    got = load_folder(spark, str(root), lookup)
    rows = {r.po_code: (r.vendor, r.qty_ordered, r.total) for r in got.purchases.collect()}
    assert rows == {"PO1": ('Acme\n\nLtd, "the"\nbest', 20.0, 2000.0), "PO2": ("Plain", 1.0, 10.0)}
    assert got.sales.count() == got.inventory.count() == 0 and got.exceptions.count() == 0
    assert {r.file: r.kind for r in got.skipped.collect()} == {"Books.xlsx": "workbook"}
    assert {r.path.rsplit("/", 1)[-1] for r in C.read_lines(spark, str(root)).select("path").distinct().collect()} == {"Purchase Orders.CSV"}


def test_line_order_tells_files_apart(spark, tmp_path):
    for name, text in (("a", "x\ny\nz\n"), ("b", "x\ny\nz\n"), ("c", "z\ny\nx\n")):
        put(tmp_path / f"{name}.csv", text)
    digest = {r.path[-5:-4]: r.digest for r in C.content_profile(C.read_lines(spark, str(tmp_path))).collect()}
    assert digest["a"] == digest["b"] != digest["c"]


def test_newer_workbook_wins(spark, lookup, tmp_path):
    put(tmp_path / "r/returns.csv", "Channel Ledger,Qty,Total,Date\nSNAPMINT,3,300,05-07-2026\n")
    rows = []
    for file, day, qty in (("All Sports z old.xlsx", 1, "9"), ("All Sports a new.xlsx", 2, "4")):
        for i, cells in enumerate((["Soh As on 17th Jul 2026"], ["Principal Code", "Total Stock On Hand"], ["TS-2", qty])):
            rows.append((file, "Soh", i, cells, dt.datetime(2026, 1, day), 10))
    cells = spark.createDataFrame(rows, "source_file string, sheet string, row_idx int, cells array<string>, modified timestamp, bytes long")
    got = load_folder(spark, str(tmp_path / "r"), lookup, raw_cells=cells)
    assert [r.qty_on_hand for r in got.inventory.collect()] == [4.0] and [r.file for r in got.superseded.collect()] == ["All Sports z old.xlsx"]


def test_run_skip_rebuild_and_retention(spark, lookup, tmp_path, monkeypatch):
    root, out = tmp_path / "in", str(tmp_path / "out")
    put(root / "uniware/Tally GST.csv", GST)
    put(root / "uniware/Purchase Orders.csv", PO_HEADER + "PO1,TS-1,APPROVED,2026-05-01,V,WH1,20,5,0,15,9\nPO2,TS-1,APPROVED,2026-05-01,V,WH2,20,5,0,15,9\n")
    put(root / "uniware/Inventory__WH1.csv", "Item SkuCode,Facility,Inventory,MRP\nTS-1,WH2,10,500\n")
    put(root / "junk.csv", "a,b\n1,2\n")
    items = spark.createDataFrame([("TS-1", "Tees", "Men", 500.0, 2024.0)], "master_sku string, Category string, Gender string, MRP double, _year double")
    none = spark.createDataFrame([], "key string, `Style Re-order Status` string, `Reorder Status` string")

    def run(run_id):
        return run_folder(spark, str(root), out, lookup, items, (none, none), run_id, dt.date(2026, 8, 1), facility="WH1")

    assert run("run-1") is not None and run("run-2") is None
    figures = {r.metric: r.value_num for r in spark.read.parquet(f"{out}/reports/summary").collect()}
    assert figures["Files skipped"] == 1 and figures["Rows dropped (other facility)"] == 2 and figures["Files superseded (deduped)"] == 0
    audit = {(r.kind, r.source_file): (r.rows, r.rows_other_facility) for r in spark.read.parquet(f"{out}/reports/load_audit").collect()}
    assert audit == {("sales", "Tally GST.csv"): (1, 0), ("purchase", "Purchase Orders.csv"): (1, 1), ("dropped", "Inventory__WH1.csv"): (0, 1)}
    assert {r.file for r in spark.read.parquet(f"{out}/reports/skipped_files").collect()} == {"junk.csv"}
    assert {r.result for r in spark.read.parquet(f"{out}/reports/tie_out_sources").collect()} == {"PASS"} and not W.exists(spark, f"{out}/reports/rejects")
    assert W.exists(spark, f"{out}/reports/facility_filter") and not W.exists(spark, f"{out}/reports/superseded_files")
    (root / "junk.csv").unlink()
    monkeypatch.setattr(W.prune, "__defaults__", (1,))
    assert run("run-3") is not None
    assert {r.verdict for r in W.read_status(spark, out).collect()} == {"OK", "SKIPPED"}
    assert {r.run_id for r in spark.read.parquet(f"{out}/archive/sku_wise").select("run_id").distinct().collect()} == {"run-3"}
    put(root / "bad.csv", "a,b\n")
    monkeypatch.setattr("stockweave.plans.cycle.load_folder", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run("run-4")
    assert {(r.run_id, r.verdict) for r in W.read_status(spark, out).filter("not ok").collect()} == {("run-4", "FAILED")}


def test_exact_sums_of_tiny_and_huge_values(spark):
    df = spark.range(10_000).selectExpr("0.00004D as a", "2e14D as b", "if(id = 0, 1e35D, 1.0D) as c")
    row = df.select(N.money_sum("a").alias("a"), N.money_sum("b").alias("b"), N.money_sum("c").alias("c"), N.unfit("c").alias("d")).first()
    assert (row.a, row.b, row.c, row.d) == (0.4, 2e18, 9999.0, 1)


def test_equal_stamps_go_to_the_later_arrival(spark):
    schema = "po string, updated int, qty int, file string, row int"
    old = spark.createDataFrame([("P1", 1, 1, "h", 9), ("P2", 2, 1, "h", 1)], schema)
    new = spark.createDataFrame([("P1", 1, 9, "a", 1), ("P1", 1, 8, "a", 0), ("P2", 1, 5, "b", 1)], schema)
    got = {r.po: r.qty for r in merge_history(old, new, ["po"], ["updated"], ["file", "row"]).collect()}
    assert got == {"P1": 9, "P2": 1}


def test_equal_stamps_in_a_stream(spark, tmp_path):
    root, schema = str(tmp_path), "po string, updated int, qty int"
    for n, qty in enumerate((5, 3)):
        SH.fold_batch(spark.createDataFrame([("P1", 1, qty)], schema), n, f"{root}/log", ["po"], ["updated"])
    seed = spark.createDataFrame([("P1", 1, 7), ("P2", 1, 7)], schema)
    assert {r.po: r.qty for r in SH.read_history(spark, f"{root}/log", ["po"], ["updated"], seed).collect()} == {"P1": 3, "P2": 7}


def test_runs_waiting_before_one_trigger(spark, tmp_path):
    root = str(tmp_path)
    rows = [(f"run-{n}", f"a|{k}", "a", k, "A", "", 1.0) for n, keys in enumerate(("xy", "yz")) for k in keys]
    batch = spark.createDataFrame(rows, "run_id string, key string, alert string, sku string, label string, item string, priority double")
    for _ in range(2):  # the second time is a replay
        SA.advance(batch, 0, root)
        got = {(r.run, r.sku): (r.status, r.cycles) for r in spark.read.parquet(f"{root}/outcome/batch=0").collect()}
        assert got == {
            ("run-0", "x"): ("NEW", 1), ("run-0", "y"): ("NEW", 1), ("run-1", "x"): ("RESOLVED", 1), ("run-1", "y"): ("ONGOING", 2), ("run-1", "z"): ("NEW", 1),
        }
    assert {r.sku for r in SA.state_after(spark, root, 0).collect()} == {"y", "z"}


def test_dashboard_holds_all_tables_columns_and_vendors(spark, lookup, tmp_path):
    put(tmp_path / "uniware/Tally GST.csv", GST)
    po = [f"PO{i},TS-1,{'CANCELLED' if i % 2 else 'APPROVED'},2026-05-01,{'' if i == 7 else f'V{i}'},WH1,{20 + i},5,0,{100 + i},9\n" for i in range(30)]
    put(tmp_path / "uniware/Purchase Orders.csv", PO_HEADER + "".join(po))
    got = load_folder(spark, str(tmp_path), lookup)
    reports = report_set(got.sales, got.inventory, got.purchases)
    rows = dashboard(reports).collect()
    by = {}
    for r in rows:
        by.setdefault(r.table, []).append(json.loads(r.json))
    assert set(by) <= {"summary", "channel", "store", "sku", "audit", "coverage", "exceptions", "basis", "returns", "po_vendor", "po_sku"}
    assert {"summary", "channel", "audit", "coverage", "basis", "po_vendor", "po_sku"} <= set(by)
    for table, report in (("summary", "summary"), ("audit", "load_audit"), ("po_vendor", "po_by_vendor"), ("po_sku", "inbound_by_sku"), ("basis", "value_basis")):
        assert all(set(x) == set(reports[report].columns) for x in by[table]), table
    # The twenty of most pending units, whatever their status, one of them without a name.
    assert sorted(x["pending"] for x in by["po_vendor"]) == [float(100 + i) for i in range(10, 30)] and len({x["po_status"] for x in by["po_vendor"]}) == 2
    assert len(by["summary"]) == reports["summary"].count()


def test_rejects_lost_rows_and_a_kind_that_fails(spark, lookup, tmp_path, monkeypatch):
    put(tmp_path / "u/Tally GST.csv", GST + "TS-1,MYNTRAPPMP,n/a,\u20b91,080,2026-07-02 10:00:00\nTS-1,MYNTRAPPMP,1,2,3,2026-07-03,beyond\nTS-1,MYNTRAPPMP,1,100,90,2026-07-04 00:00:00, \n")
    put(tmp_path / "u/returns.csv", "Channel Ledger,Qty,Total,Date\nSNAPMINT,3,300,05-07-2026\n")
    put(tmp_path / "u/Purchase Orders.csv", PO_HEADER + "PO1,TS-1,APPROVED,2026-05-01,V,WH1,20,5,0,15,9\n")
    adapt = A.adapt
    monkeypatch.setattr(A, "adapt", lambda kind, *a: adapt(kind, *a).withColumn("day", F.raise_error("no such date")) if kind == "uniware_returns" else adapt(kind, *a))
    got = load_folder(spark, str(tmp_path), lookup)
    assert sorted((r.qty_sold, r.net_value) for r in got.sales.collect() if r.qty_sold) == [(1.0, 90.0), (2.0, 180.0)] and got.purchases.count() == 1
    assert [(r.file, r.kind, "no such date" in r.reason) for r in got.skipped.collect()] == [("returns.csv", "uniware_returns", True)]
    assert {tuple(r) for r in got.rejects.collect()} == {("Tally GST.csv", "not a number: Qty", 1), ("Tally GST.csv", A.MORE_CELLS, 1)}
    whole = {r.metric: r.result for r in verified(got, got.sales, got.inventory, got.purchases, ("uniware_tally_gst", "amazon_vc_sales")).collect()}
    assert whole.pop("source file not found") == "FAIL" and set(whole.values()) == {"PASS"}
    lost = got.sales.filter("coalesce(qty_sold, 0) <> 2")
    failed = {(r.source_file, r.metric): r.diff for r in verified(got, lost, got.inventory, got.purchases).collect() if r.result == "FAIL"}
    assert failed == {("Tally GST.csv", "row count"): -1.0, ("Tally GST.csv", "units"): -2.0, ("Tally GST.csv", "invoice total"): -200.0, ("Tally GST.csv", "taxable value"): -180.0}
    monkeypatch.setattr(A, "adapt", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load_folder(spark, str(tmp_path), lookup)


def test_state_goes_from_run_to_run(spark, tmp_path):
    out, begun, empty = str(tmp_path), dt.datetime(2026, 1, 1), empty_state(spark)
    seen = {}
    for n, (keys, ok) in enumerate((("xy", True), ("q", False), ("yz", True), ("yz", True))):
        rows = [(f"a|{k}", "a", k, "A", "", 1.0) for k in keys]
        raised = spark.createDataFrame(rows, "key string, alert string, sku string, label string, item string, priority double")
        diff = alert_diff(raised, W.last_state(spark, out, f"run-{n}", empty), f"run-{n}")
        seen[n] = {r.sku: (r.status, r.first_seen, r.cycles) for r in diff.collect()}
        next_state(diff).write.parquet(f"{out}/alert_state/run_id=run-{n}")
        W.write_status(spark, out, f"run-{n}", begun + dt.timedelta(hours=n), 1.0, ok, "f", 1)
        W.write_status(spark, out, f"skip-{n}", begun + dt.timedelta(hours=n, minutes=1), 1.0, True, "f", 1, skipped=True)
    assert seen[0] == {"x": ("NEW", "run-0", 1), "y": ("NEW", "run-0", 1)}
    assert seen[2] == {"x": ("RESOLVED", "run-0", 1), "y": ("ONGOING", "run-0", 2), "z": ("NEW", "run-2", 1)}
    assert seen[3] == {"y": ("ONGOING", "run-0", 3), "z": ("ONGOING", "run-2", 2)}
    assert W.prune(spark, out, (), 2) == ["alert_state/run_id=run-0", "alert_state/run_id=run-1"]


def test_settings_tell_rules_days_ledgers_and_notes(spark):
    notes = [spark.createDataFrame([("S1", note)], "key string, note string") for note in ("", "hold")]
    base = (dt.date(2026, 1, 1), {"a": {"low": 1}}, {"L": ("c", "t", "f")}, None, (notes[0],))
    texts = {settings(*base)} | {settings(*base[:k], changed, *base[k + 1 :]) for k, changed in enumerate(
        (dt.date(2026, 1, 2), {"a": {"low": 2}}, {"L": ("c", "t", "x")}, "WH1", (notes[1],)))}
    assert len(texts) == 6 and settings(*base) in texts


def test_complete_sees_a_missing_table(spark, tmp_path):
    wanted = [f"latest/{n}" for n in W.PUBLISHED] + [f"reports/{n}" for n, optional in W.REPORTS.items() if not optional] + ["reports/dashboard"]
    for place in wanted:
        put(tmp_path / place / "_SUCCESS", "")
    assert W.complete(spark, str(tmp_path))
    (tmp_path / "reports/returns/_SUCCESS").unlink()
    assert not W.complete(spark, str(tmp_path))


def test_readers_keep_the_old_version_until_the_switch(spark, tmp_path):
    out, names = str(tmp_path), ("a", "b")

    def write(run, *which):
        for n in which:
            W.publish(spark.createDataFrame([(run,)], "x string"), out, n, run)

    def seen():
        latest = {spark.read.parquet(f"{out}/latest/{n}").first().x for n in names}
        return {W.read_published(spark, out, n).first().x for n in names} | latest

    with pytest.raises(ValueError):
        W.read_published(spark, out, "a")
    write("r1", *names)
    assert W.switch(spark, out, "r1", names) == 1 and seen() == {"r1"}
    # The run fails after its first table: nothing of it shows, and it cannot be switched to.
    write("r2", "a")
    with pytest.raises(ValueError, match="b"):
        W.switch(spark, out, "r2", names)
    assert seen() == {"r1"} and W.versions(spark, out) == [1]
    # A manifest whose job died before its end is no version.
    put(tmp_path / "versions/version=2/part-0.parquet", "half")
    assert seen() == {"r1"}
    write("r3", *names)
    assert W.switch(spark, out, "r3", names) == 2 and seen() == {"r3"}
    assert W.read_published(spark, out, "a", version=1).first().x == "r1"
    # Retention leaves what the newest version shows, and drops versions whose runs are gone.
    write("r4", "a", "b")
    write("r5", "a", "b")
    assert W.prune(spark, out, names, 1) == ["a/run_id=r1", "a/run_id=r2", "a/run_id=r4", "b/run_id=r1", "b/run_id=r4"]
    assert seen() == {"r3"} and W.versions(spark, out) == [2]
