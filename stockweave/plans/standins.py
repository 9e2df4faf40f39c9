"""Extracts, master and notes derived from the test tables.

The test tables are a star schema, not retail extracts. These views turn them,
whole, into the shapes the operators read: ``lineitem`` with ``orders`` plays
the sales ledger, ``lineitem`` alone the stock and purchase extracts, ``part``
the master sheet, the item master and the merchandiser notes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

ASOF = dt.date(2001, 8, 1)
EARLIER_ASOF = dt.date(2001, 6, 1)

CHANNELS = {
    "1-URGENT/A": ("Amazon Vendor Central", "marketplace", "sell_out"),
    "1-URGENT/R": ("Amazon Vendor Central", "marketplace", "sell_out"),
    "1-URGENT/N": ("D2C Website", "d2c", "sell_out"),
    "2-HIGH/A": ("Myntra", "marketplace", "sell_in"),
    "2-HIGH/R": ("Myntra", "marketplace", "sell_in"),
    "2-HIGH/N": ("Amazon Vendor Central", "marketplace", "sell_in"),
    "3-MEDIUM/A": ("All Sports", "retail_store", "sell_out"),
    "3-MEDIUM/R": ("Jack & Jill", "retail_store", "sell_in"),
    "3-MEDIUM/N": ("INCS", "retail_store", "sell_out"),
    "4-NOT SPECIFIED/A": ("Promotions", "internal", "exclude"),
    "4-NOT SPECIFIED/R": ("Promotions", "internal", "exclude"),
    "4-NOT SPECIFIED/N": ("Promotions", "internal", "exclude"),
}
# l_suppkey % 5 -> who holds the stock.
HOLDERS = (
    ("Warehouse", "warehouse"), ("All Sports", "retail_store"), ("Jack & Jill", "retail_store"),
    ("Amazon Vendor Central", "marketplace"), ("INCS", "retail_store"),
)


# Schemas of the test tables; stating them spares a footer read per table.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def sku_code(key: str):
    return F.expr(f"concat('S', {key})")


def style_sql(key: str) -> str:
    """Eight sizes to a style; the season suffix is dated, undated or absent."""
    return (
        f"concat('ST', {key} div 8, case ({key} div 8) % 4 when 0 then '-AW24' when 1 then '-SS25' when 2 then '-AW' else '' end)"
    )


def master(spark, sf_dir) -> DataFrame:
    """Wide master sheet; two id types are sparse on purpose."""
    return table(spark, sf_dir, "part").selectExpr(
        "concat('S', p_partkey) as `Sku Code`", f"{style_sql('p_partkey')} as `Item Name`",
        "case when p_partkey % 2 = 0 then concat('B', p_partkey) end as `AZ ASIN`",
        "case when p_partkey % 3 = 0 then concat('F', p_partkey) end as `FK SKU`",
        "p_partkey as row_seq",
    )


def prices(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "concat('S', p_partkey) as master_sku", "p_retailprice as mrp", "p_partkey as row_seq"
    )


def items(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "concat('S', p_partkey) as master_sku",
        "case when p_size <= 45 then p_type end as Category",
        "element_at(array('Men', 'Women', 'Unisex'), p_size % 3 + 1) as Gender",
        "p_retailprice as MRP",
        "cast(case when p_size <= 40 then p_size % 10 + 1990 end as double) as _year",
    )


def override_rows(spark, sf_dir) -> DataFrame:
    """A note sheet with one row per part: most blank, some for the SKU, some for its style."""
    return table(spark, sf_dir, "part").selectExpr(
        "case when p_size = 40 then '' else concat('S', p_partkey) end as `Sku Code`",
        f"{style_sql('p_partkey')} as `Item Name`",
        "case p_size when 10 then 'Watch' when 12 then 'Repeat' when 40 then 'Style hold' else '' end as `Style Re-order Status`",
        "case p_size when 10 then 'Ordered ' when 20 then 'PO raised' else '' end as `Reorder Status`",
        "p_partkey as row_seq",
    )


def sales_extract(spark, sf_dir) -> DataFrame:
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    line = table(spark, sf_dir, "lineitem")
    return line.join(order.hint("shuffle_hash"), F.expr("l_orderkey = o_orderkey")).selectExpr(
        "concat('sales_', o_orderpriority, '.csv') as source_file",
        "'uniware_tally_gst' as source_type",
        "concat_ws('/', o_orderpriority, l_returnflag) as ledger",
        "concat('LOC', l_suppkey % 5) as location",
        "'day' as grain",
        "l_shipdate as period_start", "l_shipdate as period_end",
        f"""case l_linenumber % 4 when 0 then concat(' s', l_partkey) when 1 then concat('B', l_partkey)
            when 2 then concat('f', l_partkey, ' ')
            else case when l_partkey % 2 = 0 then {style_sql('l_partkey')} else concat('X', l_partkey) end end as external_id""",
        "'az_asin' as external_id_type",
        "l_quantity as qty_sold", "l_quantity as qty_ordered",
        "case when l_returnflag = 'R' then l_quantity else 0.0D end as qty_returned",
        "case when l_linenumber <> 7 then l_extendedprice end as gross_value",
        """case when l_linenumber = 7 then null when l_linestatus = 'O' and l_tax = 0 then 0.0D
            else l_extendedprice * (1 - l_discount) end as net_value""",
        "l_extendedprice * l_discount as discount_value",
        "case when l_returnflag = 'R' then l_extendedprice end as returns_value",
    )


def _case(column: str, values) -> str:
    return f"case {column} " + " ".join(f"when {i} then '{v}'" for i, v in enumerate(values)) + " end"


def stock_extract(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('stock_', l_suppkey % 5, '.csv') as source_file",
        "'uniware_inventory' as source_type",
        _case("l_suppkey % 5", [n for n, _ in HOLDERS]) + " as channel",
        _case("l_suppkey % 5", [t for _, t in HOLDERS]) + " as channel_type",
        "concat('LOC', l_suppkey % 5) as location",
        "l_shipdate as snapshot_date",
        "concat(case when l_linenumber = 7 then 'X' else 'S' end, l_partkey) as external_id",
        "'sku_code' as external_id_type",
        "cast(floor(l_quantity * (l_partkey % 4) / 40) as double) as qty_on_hand",
        "case when l_suppkey % 5 in (0, 3) then l_extendedprice end as value_on_hand",
    )


def purchase_extract(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "*", "l_linestatus = 'F' as done",
        "case when l_linestatus = 'F' then l_quantity when l_tax >= 0.04D then cast(floor(l_quantity / 2) as double) else 0.0D end as received",
    )
    return lines.selectExpr(
        "'Purchase_Orders_history.csv' as source_file", "'uniware_purchase_orders' as source_type",
        "concat('PO', l_orderkey) as po_code",
        "case when done then 'Complete' when l_tax = 0.08D then 'CANCELLED' else 'Approved' end as po_status",
        "'MANUAL' as po_type",
        "case when l_partkey % 5 < 3 then l_shipdate - make_dt_interval(cast(l_quantity as int)) end as created_date",
        "cast(null as timestamp_ntz) as approved_date", "l_shipdate as delivery_date",
        "case when l_suppkey % 10 <> 0 then concat('Supplier ', l_suppkey) end as vendor",
        "cast(l_suppkey as string) as vendor_code",
        "case when l_suppkey % 10 <> 0 then concat('loc', l_suppkey % 5) end as facility",
        "concat(case when l_linenumber = 7 then 'X' else 'S' end, l_partkey) as external_id",
        "'sku_code' as external_id_type",
        "l_quantity as qty_ordered", "received as qty_received", "l_quantity - received as qty_pending",
        "case when l_returnflag = 'R' and l_tax = 0.01D then 1.0D else 0.0D end as qty_rejected",
        "cast(null as double) as unit_price", "l_extendedprice as sub_total", "l_extendedprice * (1 + l_tax) as total",
        f"cast(datediff(date'{ASOF}', l_shipdate) as double) as ageing_days",
        "l_shipdate as updated", "l_linenumber as line_no",
    )


# ------------------------------------------------------- a folder of extracts

#: File of the folder -> day it was last changed. The order of the names decides between copies.
FOLDER_FILES = {
    **{f"uniware/Tally GST__F{k}.csv": 20 for k in range(3)}, "uniware/Tally GST old__F0.csv": 10, "uniware/copy of Tally GST__F1.csv": 21,
    **{f"uniware/Inventory__F{k}.csv": 20 for k in range(3)}, **{f"uniware/Purchase Orders__F{k}.csv": 20 for k in range(3)},
    "uniware/Item Master.csv": 20, "uniware/Item_Master early.csv": 10, "reorder_status.csv": 20, "stores/junk.csv": 20,
}
GST_HEADER = "Product SKU Code,Channel Ledger,Qty,Total,Sales,Date"
STOCK_HEADER = "Item SkuCode,Facility,Inventory,MRP"
PO_HEADER = (
    "PO Code,Item SkuCode,Purchase Order Status,Created,Vendor Name,Facility,Order Quantity,Recieved Quantity,Rejected Quantity,Pending Quantity,Total"
)
ITEM_HEADER = "Product Code,Category Code,Category Name,Gender,MRP,Year"
NOTES_HEADER = "Sku Code,Item Name,Style Re-order Status,Reorder Status"


def folder_lines(spark, sf_dir) -> DataFrame:
    """(file, a, b, line): every line of every file, in the order (a, b); headers have a = -1.

    All of lineitem is in the sales, stock and purchase files, by supplier; all
    of part in the item masters, the notes and the junk. Every fiftieth SKU of a
    sale is unknown, one sale in seven comes without money, one in seven with
    its gross value only, and vendors have commas, quotes and line breaks.
    """
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    k, key = "cast(l_suppkey % 3 as string)", ("l_orderkey as a", "cast(l_linenumber as bigint) as b")
    whole = "cast(cast(l_quantity as int) as string)"
    price = "cast(cast(l_extendedprice as decimal(18,2)) as string)"
    gst = f"""concat_ws(',', concat(if(l_partkey % 50 = 0, 'X', 'S'), l_partkey),
        element_at(array('MYNTRAPPMP', 'SNAPMINT', 'PROMO', ' ajio ', 'Walk in'), cast(l_orderkey % 5 + 1 as int)), {whole},
        case when l_linenumber = 5 then '' when l_linenumber = 4 then {price} else concat('"', format_number(l_extendedprice, 2), '"') end,
        if(l_linenumber in (4, 5), '', {price}), date_format(l_shipdate, 'yyyy-MM-dd'))"""
    stock = f"concat_ws(',', concat('S', l_partkey), concat('F', {k}), {whole}, cast(100 + l_partkey % 900 + l_linenumber as string))"
    po = f"""concat_ws(',', concat('PO', l_orderkey, '-', l_linenumber), concat('S', l_partkey), if(l_linestatus = 'O', 'APPROVED', 'COMPLETE'),
        date_format(l_shipdate, 'yyyy-MM-dd'), concat('"V', l_suppkey, if(l_linenumber = 2, concat(', ', repeat('"', 2), 'the\\nbest', repeat('"', 3)), '"')), concat('F', {k}), {whole}, '1', '0',
        cast(cast(l_quantity as int) - 1 as string), {price})"""
    item = "concat_ws(',', concat('S', p_partkey), 'C', {}, 'Men', cast(cast(p_retailprice as decimal(18,2)) as string), cast(2000 + p_size % 25 as string))"
    note = f"""case when p_partkey % 3 = 0 then concat('s', p_partkey, ' ,,,Hold')
        when p_partkey % 8 = 1 then concat(',', {style_sql('p_partkey')}, ',"Re-order, soon",') else concat('S', p_partkey, ',,,') end"""
    parts = [
        line.selectExpr(f"concat('uniware/Tally GST__F', {k}, '.csv') as file", *key, f"{gst} as line"),
        line.filter("l_suppkey % 3 = 1").selectExpr("'uniware/copy of Tally GST__F1.csv' as file", *key, f"{gst} as line"),
        line.filter("l_suppkey % 3 = 0 and l_linenumber > 2").selectExpr("'uniware/Tally GST old__F0.csv' as file", *key, f"{gst} as line"),
        line.selectExpr(f"concat('uniware/Inventory__F', {k}, '.csv') as file", *key, f"{stock} as line"),
        line.selectExpr(f"concat('uniware/Purchase Orders__F', {k}, '.csv') as file", *key, f"{po} as line"),
        part.selectExpr("'uniware/Item Master.csv' as file", "p_partkey as a", "0L as b", item.format("p_brand") + " as line"),
        part.selectExpr("'uniware/Item_Master early.csv' as file", "p_partkey as a", "0L as b", item.format("'Early'") + " as line"),
        part.selectExpr("'reorder_status.csv' as file", "p_partkey as a", "0L as b", f"{note} as line"),
        part.selectExpr("'stores/junk.csv' as file", "p_partkey as a", "0L as b", "concat('x,', p_size) as line"),
    ]
    heads = [
        (f, -1, 0, next(h for start, h in (
            ("uniware/Inv", STOCK_HEADER), ("uniware/Pur", PO_HEADER), ("uniware/Item", ITEM_HEADER), ("reorder", NOTES_HEADER), ("stores", "a,b"), ("uni", GST_HEADER),
        ) if f.startswith(start))) for f in FOLDER_FILES
    ]
    out = spark.createDataFrame(heads, "file string, a long, b long, line string")
    for frame in parts:
        out = out.unionByName(frame)
    return out


def master_cells(spark, sf_dir, layout: int = 0) -> DataFrame:
    """The master as decoded workbook cells: header in row 1, 0 or 2 and other columns first, by layout."""
    row = (1, 0, 2)[layout]
    names = (("Sku Code", "Item Name", "AZ ASIN", "FK SKU"), ("AZ ASIN", "Sku Code", "Remarks", "Item Name", "Sku Code"), ("Item Name", "FK SKU", "Sku Code", "FSN"))[layout]
    cells = {
        "Sku Code": "concat('S', p_partkey)", "Item Name": style_sql("p_partkey"), "AZ ASIN": "if(p_partkey % 2 = 0, concat('B', p_partkey), '')",
        "FK SKU": "if(p_partkey % 3 = 0, concat('F', p_partkey), null)", "FSN": "concat(p_partkey, '.0')", "Remarks": "p_name",
    }
    file = f"{('Listing', 'Codes', 'Sheet of all')[layout]}.xlsx"
    head = [(file, "Sheet1", i, ["Myntra, all ids"] if i < row else [*names[:-1], f' "{names[-1]}"\u00a0']) for i in range(row + 1)]
    first = "'again'" if layout == 1 else cells[names[-1]]
    body = table(spark, sf_dir, "part").selectExpr(
        f"'{file}' as source_file", "'Sheet1' as sheet", f"p_partkey + {row + 1} as row_idx", f"array({', '.join(cells[n] for n in names[:-1])}, {first}) as cells"
    )
    return spark.createDataFrame(head, "source_file string, sheet string, row_idx long, cells array<string>").unionByName(body)


def write_folder(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Put the files of ``folder_lines`` and the decoded master below ``root``, each file by one task."""
    split = f"{root}/_split"
    (
        folder_lines(spark, sf_dir).repartition("file").sortWithinPartitions("file", "a", "b")
        .select("file", "line").write.partitionBy("file").text(split)
    )
    master_cells(spark, sf_dir).write.parquet(f"{root}/raw_cells")
    jvm = spark._jvm
    place = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    files = place(root).getFileSystem(spark._jsc.hadoopConfiguration())
    named = {s.getPath().getName().removeprefix("file=").replace("%2F", "/"): s.getPath() for s in files.listStatus(place(split)) if s.isDirectory()}
    for name, day in FOLDER_FILES.items():
        part = next(s.getPath() for s in files.listStatus(named[name]) if s.getPath().getName().startswith("part-"))
        target = place(f"{root}/{name}")
        files.mkdirs(target.getParent())
        files.rename(part, target)
        files.setTimes(target, int(dt.datetime(2001, 7, day, tzinfo=dt.timezone.utc).timestamp() * 1000), -1)
    files.delete(place(split), True)
