"""Master, item master and merchandiser notes out of the input folder itself."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockweave import schemas as S
from stockweave.functions.text import clean_header, norm_id
from stockweave.operators import overrides as N
from stockweave.plans import facts as FP
from stockweave.session import cut_lineage, together
from stockweave.sources import adapters as A
from stockweave.sources import detect as D
from stockweave.sources import scan as C
from stockweave.sources import tables as B

# Where a master sheet may have its header, in the order they are tried; the notes' file and its key columns.
MASTER_HEADER_ROWS = (1, 0, 2)
NOTES_FILE = "reorder_status.csv"
NOTES_SKU, NOTES_STYLE = ("sku code", "master_sku"), ("item name", "style", "style code")

NOTES_SCHEMA = "key string, " + ", ".join(f"`{c}` string" for c in N.NOTES)
ITEMS_SCHEMA = "master_sku string, Category string, Gender string, MRP double, _year double"


def places(cells: list[str | None]) -> dict[str, int]:
    """Header name -> position; of equal names the first counts, blank ones are none."""
    found: dict[str, int] = {}
    for i, cell in enumerate(cells):
        name = clean_header(cell or "")
        if name:
            found.setdefault(name, i)
    return found


def named(rows: DataFrame, at: dict[str, int], order) -> DataFrame:
    """Cell rows as one text column per header name, with ``row_seq``; blank cells are null."""
    return rows.select(*[F.nullif(F.get("cells", F.lit(i)), F.lit("")).alias(name) for name, i in at.items()], order.alias("row_seq"))


def master_sheet(raw_cells: DataFrame) -> DataFrame:
    """The wide master: rows below the header of the workbook that ``detect_master`` names, under its header names.

    The header is the first of rows 1, 0 and 2 that has a cell ``Sku Code``; of
    several such sheets the first counts, by ``sheet_idx`` if there is one, else
    by name. Only that header row comes to the driver. A number that a decoder
    wrote with a fraction of zeros (``11.0``) loses it, as ids are compared as text.
    A sheet without styles gets a null ``Item Name``.
    """
    tried = F.array_position(F.array(*[F.lit(r) for r in MASTER_HEADER_ROWS]), F.col("row_idx").cast("int"))
    tidy = F.transform("cells", lambda c: F.btrim(F.replace(F.coalesce(c, F.lit("")), F.lit("\u00a0"), F.lit(" ")), F.lit(' \t\r\n"')))
    sheet = F.col("sheet_idx") if "sheet_idx" in raw_cells.columns else F.col("sheet")
    top = raw_cells.filter(F.col("row_idx") <= max(MASTER_HEADER_ROWS)).join(F.broadcast(D.detect_master(raw_cells)), "source_file")  # one row
    found = top.filter((tried > 0) & F.array_contains(tidy, "Sku Code"))
    head = found.agg(F.min_by(F.struct("source_file", "sheet", "row_idx", "cells"), F.struct(sheet, tried)).alias("h")).first().h
    if head is None:
        raise ValueError("no master sheet with a 'Sku Code' column in row 1, 0 or 2 among the workbooks")
    mine = raw_cells.filter((F.col("source_file") == head.source_file) & F.col("sheet").eqNullSafe(F.lit(head.sheet)) & (F.col("row_idx") > head.row_idx))
    at = {name: i for name, i in places(head.cells).items() if name in S.MASTER_ID_COLUMNS}
    wide = named(mine, at, F.col("row_idx"))
    wide = wide.withColumns({name: F.regexp_replace(F.col(f"`{name}`"), "^(\\d+)\\.0+$", "$1") for name in at})
    return wide if "Item Name" in at else wide.withColumn("Item Name", F.lit(None).cast("string"))


def csv_table(spark: SparkSession, root: str, path: str) -> DataFrame | None:
    """One CSV below the root under its header names, all text, with ``row_seq``; None when it is absent or has no header.

    Read by the rules of the extracts: encoding per file, line breaks inside
    quoted cells, no task that needs the whole file.
    """
    lines = cut_lineage(C.read_lines(spark, root, only=path), "lines")
    profile = cut_lineage(C.content_profile(lines, cut_lineage(C.block_starts(lines), "starts")), "profile")
    # Read for the header and again for each table made of the rows.
    text = cut_lineage(C.join_records(C.decode_lines(lines, profile), profile)[0], "records")
    filled = F.exists("cells", lambda c: c != "")
    head = C.head_rows(text).filter(filled).orderBy("row_idx").limit(1).first()
    if head is None:
        return None
    place = spark.createDataFrame([(head.path, head.block, head.seq)], "path string, header_block long, header_seq long")
    rows = C.body_cells(text, F.broadcast(place), len(head.cells))  # one row
    return named(rows, places(head.cells), F.struct("block", "seq"))


def load_items(spark: SparkSession, root: str) -> DataFrame:
    """The newest item master below the root; no rows when there is none."""
    newest = B.newest_matching(C.scan_inputs(spark, root).filter("suffix = 'csv'"), "item[_ ]?master").first()
    raw = csv_table(spark, root, newest.path) if newest.path is not None else None
    return B.load_item_master(raw) if raw is not None else spark.createDataFrame([], ITEMS_SCHEMA)


def load_notes(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(by SKU, by style) from the notes file at the root; a row with a SKU speaks for it, any other for its style."""
    none = spark.createDataFrame([], NOTES_SCHEMA)
    raw = csv_table(spark, root, f"{root.rstrip('/')}/{NOTES_FILE}")
    if raw is None:
        return none, none
    sku = next((c for c in raw.columns if c.lower() in NOTES_SKU), None)
    style = next((c for c in raw.columns if c.lower() in NOTES_STYLE), None)
    pick = lambda c: F.col(f"`{c}`") if c in raw.columns else F.lit("")
    both = N.split_overrides(raw.select(pick(sku).alias("Sku Code"), pick(style).alias("Item Name"), *[pick(c).alias(c) for c in N.NOTES], "row_seq"))
    # Digested, and joined by several tables.
    by_sku, by_style = together(*[partial(cut_lineage, notes, "notes") for notes in both])
    return by_sku, by_style


def stock_prices(files: DataFrame, rows: DataFrame) -> DataFrame:
    """SKU to list price from the first of the warehouse stock files, by path; a SKU's last row counts, also one without a price.

    ``files``, ``rows``: the kept files of the kind and their cell rows.
    """
    first = files.join(F.broadcast(files.agg(F.min("path").alias("_first"))), F.col("path") == F.col("_first"), "left_semi")  # one row
    sources = {c: A.ADAPTERS["uniware_inventory"].columns[c] for c in ("external_id", "mrp")}
    picked = A.pick_cells(rows, first, sources).select(norm_id("external_id").alias("sku"), "mrp", F.struct("block", "seq").alias("row_seq"))
    return FP.price_list(picked, "sku", "mrp")
