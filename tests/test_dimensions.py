"""Master, item master, notes and list prices out of the folder itself."""

import pytest

from stockweave.operators import resolve as R
from stockweave.sources import dimensions as M
from stockweave.sources.intake import load_folder
from tests.test_intake import put

CELLS = "source_file string, sheet string, row_idx int, cells array<string>"
ITEMS = "Product Code,Category Code,Category Name,Gender,MRP,Year\n"


def sheet(file, header, *rows, name="S", at=1):
    return [(file, name, i, ["", "all ids"]) for i in range(at)] + [(file, name, at + i, list(r)) for i, r in enumerate((header, *rows))]


def test_master_is_found_by_its_header(spark):
    other = sheet("z store.xlsx", ("Principal Code", "Qty"), ("TS-1", "2"), at=0)
    for at in (0, 1, 2):
        rows = sheet("m.xlsx", ("AZ ASIN", " \"Sku Code\" ", "Sku Code", "Jio code", "Notes"), ("B1", "ts-1", "no", "11.0", "x"), ("", "TS-1", "no", None, None), ("B2", "", "no", "1", ""), ("B3", "TS-3"), at=at)
        raw = M.master_sheet(spark.createDataFrame(rows + other, CELLS))
        assert raw.columns == ["AZ ASIN", "Sku Code", "Jio code", "row_seq", "Item Name"]
        kept, copies = R.load_master(raw)
        assert {(r["Sku Code"], r["AZ ASIN"], r["Jio code"]) for r in kept.collect()} == {("TS-1", "B1", "11"), ("TS-3", "B3", None)}
        assert [tuple(r) for r in copies.collect()] == [("TS-1", 2)]
    # Row 1 is tried before row 0, and a header further down is none.
    both = [("m.xlsx", "S", i, c) for i, c in enumerate((["Sku Code", "FSN"], ["FSN", "Sku Code"], ["F1", "TS-9"]))]
    assert [r["Sku Code"] for r in M.master_sheet(spark.createDataFrame(both, CELLS)).collect()] == ["TS-9"]
    for rows in (other, sheet("m.xlsx", ("AZ ASIN", "Sku Code"), at=3)):
        with pytest.raises(ValueError, match="no master sheet"):
            M.master_sheet(spark.createDataFrame(rows, CELLS))


def test_newest_item_master_and_none(spark, tmp_path):
    put(tmp_path / "x.csv", "a,b\n1,2\n")
    assert M.load_items(spark, str(tmp_path)).count() == 0
    put(tmp_path / "u/item_master new.csv", "﻿\n" + ITEMS + 'TS-1,T,"Tees,\nlong",Men,"1,500",2024\n ts-1 ,T,Late,Men,1,2024\n,T,None,Men,1,2024\n', when=1_770_000_000)
    put(tmp_path / "Item Master.csv", ITEMS + "TS-1,T,Old,Men,1,2020\n", when=1_760_000_000)
    put(tmp_path / "_archive/ItemMaster.csv", ITEMS + "TS-1,T,Gone,Men,1,2020\n", when=1_780_000_000)
    got = [(r.master_sku, r.Category, r._year) for r in M.load_items(spark, str(tmp_path)).collect()]
    assert got == [("TS-1", "Tees,\nlong", 2024.0)]


def test_notes_by_sku_and_style(spark, tmp_path):
    put(tmp_path / "x.csv", "a,b\n1,2\n")
    assert [n.count() for n in M.load_notes(spark, str(tmp_path))] == [0, 0]
    put(tmp_path / "sub/reorder_status.csv", "Sku Code,Reorder Status\nTS-9,elsewhere\n")
    put(tmp_path / "reorder_status.csv", 'STYLE,Master_SKU,Reorder Status\nTEE,,"hold,\nplease"\nTEE,ts-1,own\nTEE,TS-1,late\nSHOE,,  \n')
    by_sku, by_style = M.load_notes(spark, str(tmp_path))
    assert [tuple(r) for r in by_sku.collect()] == [("TS-1", "", "own")]
    assert [tuple(r) for r in by_style.collect()] == [("TEE", "", "hold,\nplease")]
    put(tmp_path / "reorder_status.csv", "Reorder Status\nhold\n")
    assert [n.count() for n in M.load_notes(spark, str(tmp_path))] == [0, 0]


def test_folder_gives_its_own_lookup_and_prices(spark, tmp_path):
    put(tmp_path / "a/Inventory__WH1.csv", "Item SkuCode,Facility,Inventory,MRP\nTS-1,WH1,1,100\nTS-1,WH1,1,300\nTS-2,WH1,1,50\nTS-2,WH1,1,\n")
    put(tmp_path / "b/Inventory__WH2.csv", "Item SkuCode,Facility,Inventory,MRP\nTS-1,WH2,1,900\n")
    put(tmp_path / "c/Tally GST.csv", "Product SKU Code,Channel Ledger,Qty,Total,Sales,Date\nTS-1,SNAPMINT,2,,,2026-07-01\nTS-2,SNAPMINT,2,,,2026-07-01\n")
    cells = spark.createDataFrame(sheet("m.xlsx", ("Sku Code", "AZ ASIN"), ("TS-1", "B1"), ("TS-2", "B2")), CELLS)
    got = load_folder(spark, str(tmp_path), raw_cells=cells, master=M.master_sheet(cells))
    assert {(r.master_sku, r.net_value, r.value_basis) for r in got.sales.collect()} == {("TS-1", 600.0, "imputed_mrp"), ("TS-2", None, "as_reported")}
    assert got.skipped.count() == 0 and got.files.filter("name = 'm.xlsx'").count() == 0
    with pytest.raises(ValueError, match="lookup or a master"):
        load_folder(spark, str(tmp_path))
