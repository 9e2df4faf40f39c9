"""Registered queries for file, adapter, sink and streaming operators.

The test tables stand in for files: a document is a file with a name, a kind
and contents, an order is a sheet, a line item is a line of an extract.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from stockweave import schemas as S
from stockweave.functions.text import pick_column
from stockweave.operators import lifecycle as L
from stockweave.operators.unpivot import block_columns, unpivot_blocks, unpivot_matrix
from stockweave.plans import merchandising as M
from stockweave.plans.cycle import run_folder, settings
from stockweave.plans import reports as P
from stockweave.plans import standins as T
from stockweave.plans import verification as V
from stockweave.queries import catalog as K
from stockweave.queries.catalog import PO_VERSION_ORDER, query
from stockweave.session import cut_lineage, work_dir
from stockweave.sinks import publish as W
from stockweave.sources import adapters as A
from stockweave.sources import detect as D
from stockweave.sources import dimensions as DM
from stockweave.sources import scan as C
from stockweave.sources import tables as B
from stockweave.streaming import alert_state as SA
from stockweave.streaming import po_history as SH


def config_rows(spark, column: str, values) -> DataFrame:
    return spark.range(1).selectExpr("explode(array({})) as {}".format(", ".join(f"'{v}'" for v in values), column))


# ------------------------------------------------------------------- files


@query
def file_inventory(spark, sf):
    """The scan rules over a listing with one file per document."""
    listing = T.table(spark, sf, "documents").selectExpr(
        """concat('/data/input/', case doc_id % 6 when 0 then '_archive/' when 1 then 'stores/Old/' when 2 then 'vendor/week 1/' when 3 then '' else 'stores/' end,
           case doc_id % 7 when 0 then '~$' when 1 then '.' else '' end, source, '_', doc_id,
           case doc_id % 5 when 0 then '.csv' when 1 then '.XLSX' when 2 then '.txt' when 3 then '.xls' else '.csv' end) as path""",
        "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, cast(doc_id % 500 as int)) as modificationTime", "n_chars as length",
    )
    return C.file_table(listing, "/data/input").select("path", "name", "folder", "suffix", "bytes")


def document_files(spark, sf) -> DataFrame:
    return T.table(spark, sf, "documents").selectExpr(
        "concat('/in/', lpad(doc_id, 12, '0')) as path",
        """concat('Report_', doc_id, case when doc_id % 4 = 0 then concat('__', upper(lang), '.csv')
            when doc_id % 4 = 1 then concat('__', upper(lang), '_20240101_0930.csv') when doc_id % 50 = 2 then '__COMBINED.csv' else '.csv' end) as name""",
        """case when source in ('src0', 'src1') then 'uniware_inventory' when source = 'src2' then 'UNRECOGNISED'
            when doc_id % 50 = 2 then 'uniware_returns' else concat('kind_', source) end as kind""",
        "if(doc_id % 9 = 0, 'Sale', '') as sheet",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast((doc_id * 7919) % 100003 as int)) as modified",
        "cast(octet_length(text) as bigint) as bytes", "sha2(text, 256) as digest",
    )


def document_lines(spark, sf) -> DataFrame:
    return T.table(spark, sf, "documents").selectExpr("cast(doc_id as string) as path", "0L as block", "posexplode(split(text, '\n')) as (seq, value)")


@query
def dedupe_files(spark, sf):
    profile = C.content_profile(document_lines(spark, sf)).select("path", "digest")
    files = document_files(spark, sf).drop("digest").join(profile.withColumn("path", F.concat(F.lit("/in/"), F.lpad("path", 12, "0"))), "path", "left")
    kept, lost = D.dedupe_files(files, "EN")
    mine = kept.select("path", F.col("name").alias("file"), "kind", F.lit(None).cast("string").alias("reason"))
    return mine.unionByName(lost)


@query
def content_profile(spark, sf):
    """Digest every document line by line; how many files share their contents with others."""
    profile = C.content_profile(document_lines(spark, sf))
    copies = profile.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.sum("rows").alias("rows"), F.bool_and("utf8").alias("utf8"))
    return copies.groupBy("copies", "utf8").agg(F.count(F.lit(1)).alias("contents"), F.sum("rows").alias("rows"))


@query
def find_header_row(spark, sf):
    """Header search in every document: words are cells, lines are rows."""
    cells = T.table(spark, sf, "documents").selectExpr(
        "cast(doc_id as string) as source_file", "'' as sheet", "posexplode(split(text, '\n')) as (row_idx, line)"
    ).selectExpr("source_file", "sheet", "row_idx", "split(line, ' ') as cells")
    return D.find_header_row(cells, ("tion", "er", "ou")).select("source_file", "header_row")


HEADERS = (
    "ASIN,Ordered Units,Shipped Units,Shipped COGS", "ASIN,Sellable On Hand Units,Unfilled Customer Ordered Units,Shipped Units",
    "Product SKU Code,Channel Ledger,Qty,Total", "Channel Ledger,Qty,Total", "PO Code,Item SkuCode,Order Quantity",
    "PO Code,Order Quantity", "Item SkuCode,Facility,Inventory", "Product Code,Category Code,MRP", "something,else", "a,b",
)


@query
def classify_source(spark, sf):
    """One file per order; header and name vary with its key, a third have a banner line."""
    pick = "element_at(array({}), cast(o_orderkey % 10 + 1 as int))".format(", ".join(f"split(lower('{h}'), ',')" for h in HEADERS))
    files = T.table(spark, sf, "orders").selectExpr(
        "cast(o_orderkey as string) as path",
        "case o_orderkey % 4 when 0 then concat('jj SaleReport ', o_orderkey, '.csv') when 1 then concat('jj sohreport ', o_orderkey, '.csv') else concat('x', o_orderkey, '.csv') end as name",
        f"if(o_orderkey % 3 = 0, array('program=[x]'), {pick}) as h0", f"if(o_orderkey % 3 = 0, {pick}, array('1', '2')) as h1",
    )
    return D.classify_source(files).select("path", "kind", "profile_id", "header_row")


def order_sheets(spark, sf) -> DataFrame:
    """Every order is a sheet, every line item one of its rows; line 3 and 4 look like headers."""
    return T.table(spark, sf, "lineitem").selectExpr(
        "concat(element_at(array('All Sports ', 'INCS ', 'Other '), cast(l_orderkey % 3 + 1 as int)), l_orderkey, '.xlsx') as source_file",
        "if(l_orderkey % 2 = 0, 'Sale Report', 'Soh') as sheet", "cast(l_linenumber as bigint) as row_idx",
        """case l_linenumber when 3 then array('Principal Code', 'Invoice Date', 'Item Name', 'Qty')
            when 4 then array('principal code', 'Total Stock On Hand') else array(cast(l_partkey as string), cast(l_quantity as string)) end as cells""",
    )


@query
def match_store_profile(spark, sf):
    return D.match_store_profile(order_sheets(spark, sf)).drop("note")


@query
def detect_master(spark, sf):
    """The last order whose first lines look like a master sheet."""
    rows = T.table(spark, sf, "lineitem").selectExpr(
        "concat('book ', lpad(l_orderkey, 10, '0')) as source_file", "'' as sheet", "cast(l_linenumber as bigint) as row_idx",
        "case when l_linenumber = 2 then array('Sku Code', 'x') when l_linenumber = 3 and l_returnflag = 'R' then array('AZ ASIN') else array('1') end as cells",
    )
    return D.detect_master(rows)


@query
def discover_po_files(spark, sf):
    files = T.table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        """case o_orderkey % 5 when 0 then 'Purchase Orders_18082026.csv' when 1 then 'Purchase_Orders_history.csv' when 2 then 'purchase-order.csv'
            when 3 then 'PO master.xlsx' else 'sales.csv' end as name""",
        "if(o_orderkey % 2 = 0, array('PO Number', 'Child SKU', 'Qty'), array('Sku', 'Qty')) as header",
    )
    return B.discover_po_files(files).select("o_orderkey", "name", "found_by")


@query
def input_freshness(spark, sf):
    files = T.table(spark, sf, "events").selectExpr("event_type as folder", "ts + make_dt_interval(if(event_type = 'view', 5, 0)) as modified")
    expected = config_rows(spark, "folder", ("click", "error", "purchase", "signup", "view", "stores"))
    return C.input_freshness(files, expected, dt.datetime(2024, 2, 10))


@query
def input_fingerprint(spark, sf):
    files = T.table(spark, sf, "events").selectExpr(
        "event_type as folder", "props as name", "cast(event_id as string) as file_id", "date_format(ts, 'yyyy-MM-dd HH:mm:ss') as version", "user_id as bytes"
    )
    return C.input_fingerprint(files, "rules-1")


@query
def run_settings(spark, sf):
    """The same files under changed rules and dates: the fingerprint of each state."""
    files = T.table(spark, sf, "events").selectExpr(
        "event_type as folder", "props as name", "cast(event_id as string) as file_id", "date_format(ts, 'yyyy-MM-dd HH:mm:ss') as version", "user_id as bytes"
    )
    states = {"as it was": ({"low": 1}, 1), "other rule": ({"low": 2}, 1), "other day": ({"low": 1}, 2)}
    parts = [
        C.input_fingerprint(files, settings(dt.date(2026, 1, day), rules, {}, "WH1", ())).withColumn("state", F.lit(name))
        for name, (rules, day) in states.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def reject_counts(spark, sf):
    """Lines of seven files, some with a cell too many or a quantity that is no number: what is reported, and what stays."""
    rows = T.table(spark, sf, "lineitem").selectExpr(
        "concat('in_', l_suppkey % 7) as path", "0L as block", "monotonically_increasing_id() as seq", "4 as width",
        """array_compact(array(concat('S', l_partkey), 'LEDGER', case l_linenumber when 6 then 'n/a' when 4 then '-' when 3 then '' else cast(l_quantity as string) end,
           case when l_linenumber = 5 then concat('₹', l_partkey, ',000') when l_linenumber = 2 and l_tax = 0.05D then 'free' else cast(l_extendedprice as string) end,
           case when l_tax = 0.08D then 'beyond' when l_tax = 0.07D then ' ' end)) as cells""",
    )
    files = rows.select("path").distinct().select(
        "path", F.concat("path", F.lit(".csv")).alias("name"), F.lit("").alias("sheet"),
        F.array(*[F.lit(h) for h in ("product sku code", "channel ledger", "qty", "total")]).alias("header"),
    )
    raw = A.raw_rows("uniware_tally_gst", None, rows.filter(A.fits()).drop("width"), files)
    overflow = rows.filter(~A.fits()).join(files.select("path", F.col("name").alias("source_file")), "path")
    return A.rejects(raw, overflow)


@query
def retired_files(spark, sf):
    orders = T.table(spark, sf, "orders")
    before = orders.selectExpr("o_orderkey as file_id", "if(o_orderkey % 100 = 0, 'Purchase_Orders_history.csv', concat('f', o_custkey)) as name")
    return L.retired(before, orders.filter("o_orderstatus <> 'P'").selectExpr("o_orderkey as file_id"), B.PO_HISTORY_NAME)


@query
def source_presence(spark, sf):
    files = T.table(spark, sf, "events").selectExpr(
        "concat('/in/', event_id) as path", "concat(event_type, '_Report ', event_id, '.csv') as name", "ts as modified", "event_type <> 'error' as readable"
    )
    expected = config_rows(spark, "source", ("Click Report", "error-report", "Refund Report")).selectExpr(
        "source", "regexp_replace(lower(source), '[\\\\s_\\\\-]+', '') as folded_name"
    )
    return V.source_presence(files, expected)


@query
def profile_table(spark, sf):
    return C.profile_table(T.table(spark, sf, "events"), "event_type")


@query
def combine_same_schema(spark, sf):
    line = T.table(spark, sf, "lineitem")
    parts = {f: line.filter(F.col("l_returnflag") == f) for f in ("A", "N", "R")}
    return C.combine_same_schema(parts).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").alias("qty"))


@query
def item_master(spark, sf):
    """Item master keyed by a shared code: first row of a code wins."""
    raw = T.table(spark, sf, "part").selectExpr(
        "concat(' ', lower(p_brand), '-', p_size) as `Product Code`", "p_type as `Category Name`", "p_name as Gender",
        "cast(p_retailprice as string) as MRP", "cast(p_size + 1990 as string) as Year", "p_partkey as row_seq",
    )
    return B.load_item_master(raw).withColumnsRenamed({"Category": "category", "Gender": "gender", "MRP": "mrp", "_year": "product_year"})


# ---------------------------------------------------------------- adapters


def cell_rows(spark, sf, *columns: str) -> DataFrame:
    """Line items as text cells of one big extract."""
    return T.table(spark, sf, "lineitem").selectExpr(
        "'f' as path", "0L as block", "l_orderkey * 10 + l_linenumber as seq", "array({}) as cells".format(", ".join(f"cast({c} as string)" for c in columns))
    )


def one_file(spark, name: str, *header: str, **extra: str) -> DataFrame:
    """The file table row that goes with cell_rows."""
    cells = ", ".join("'" + h.lower() + "'" for h in header)
    text = ", ".join("'" + h + "'" for h in header)
    more = [f"{sql} as {c}" for c, sql in extra.items()]
    return spark.range(1).selectExpr("'f' as path", f"'{name}' as name", "'' as sheet", f"array({cells}) as header", f"array({text}) as header_text", *more)


MONEY_TEXT = "concat('₹', format_number({}, 2))"


@query
def adapt_tally_gst(spark, sf):
    rows = cell_rows(spark, sf, "concat('S', l_partkey)", "concat(' ', l_returnflag, ' ')", "l_quantity", MONEY_TEXT.format("l_extendedprice"), "l_extendedprice * 0.5D", "date_format(l_shipdate, 'dd-MM-yyyy')")
    out = A.adapt("uniware_tally_gst", rows, one_file(spark, "Tally GST.csv", "Product SKU Code", "Channel Ledger", "Qty", "Total", "Sales", "Date"))
    return out.groupBy("ledger", "grain", "external_id_type").agg(
        F.sum("qty_sold").alias("units"), P.money_sum("gross_value").alias("gross"), P.money_sum("net_value").alias("net"),
        F.min("period_start").alias("first_day"), F.max("period_end").alias("last_day"), F.countDistinct("external_id").alias("ids"),
    )


@query
def adapt_tally_returns(spark, sf):
    rows = cell_rows(spark, sf, "l_returnflag", "l_quantity", MONEY_TEXT.format("l_extendedprice"), "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss')")
    out = A.adapt("uniware_returns", rows, one_file(spark, "Tally Return.csv", "Channel Ledger", "Qty", "Total", "Date"))
    return out.groupBy("ledger").agg(
        F.sum("qty_returned").alias("units"), P.money_sum("returns_value").alias("value"), F.max("period_end").alias("last_day")
    )


@query
def adapt_amazon_sales(spark, sf):
    rows = cell_rows(spark, sf, "concat('B', l_partkey)", "l_quantity", "l_quantity - 1", "if(l_returnflag = 'R', 1, 0)", MONEY_TEXT.format("l_extendedprice"), "'₹0.00'")
    out = A.adapt("amazon_vc_sales", rows, one_file(spark, "Sales_ASIN_01-06-2001_30-06-2001.csv", "ASIN", "Ordered Units", "Shipped Units", "Customer Returns", "Ordered Revenue", "Shipped COGS"))
    return out.groupBy("channel", "location", "flow", "grain", "period_start", "period_end").agg(
        F.sum("qty_ordered").alias("ordered"), F.sum("qty_sold").alias("shipped"), F.sum("qty_returned").alias("returned"),
        P.money_sum("gross_value").alias("gross"), P.money_sum("net_value").alias("net"),
    )


@query
def adapt_amazon_inventory(spark, sf):
    rows = cell_rows(spark, sf, "concat('B', l_partkey)", MONEY_TEXT.format("l_extendedprice"), "l_quantity")
    out = A.adapt("amazon_vc_inventory", rows, one_file(spark, "Inventory_ASIN_2001-07-31.csv", "ASIN", "Net Sellable On-Hand Inventory Value", "Sellable On Hand Units"))
    return out.groupBy("external_id", "snapshot_date").agg(F.sum("qty_on_hand").alias("units"), P.money_sum("value_on_hand").alias("value"))


@query
def adapt_warehouse(spark, sf):
    rows = cell_rows(spark, sf, "concat('S', l_partkey)", "concat('WH', l_suppkey % 5)", "l_quantity", "'1,050.50'")
    out = A.adapt("uniware_inventory", rows, one_file(spark, "Inventory Snapshot_31072001093000.csv", "Item SkuCode", "Facility", "Inventory", "MRP"))
    return out.groupBy("channel", "location", "snapshot_date").agg(F.sum("qty_on_hand").alias("units"), P.money_sum("value_on_hand").alias("value"))


@query
def adapt_purchase_orders(spark, sf):
    rows = cell_rows(spark, sf, "concat('PO', l_orderkey)", "concat('S', l_partkey)", "if(l_linestatus = 'F', 'COMPLETE', 'APPROVED')", "date_format(l_shipdate, 'yyyy-MM-dd')",
                     "l_quantity", "l_quantity - 1", "1", MONEY_TEXT.format("l_extendedprice"), "concat('V', l_suppkey)")
    out = A.adapt("uniware_purchase_orders", rows, one_file(
        spark, "Purchase_Orders.csv", "PO Code", "Item SkuCode", "Purchase Order Status", "Created", "Order Quantity", "Recieved Quantity", "Pending Quantity", "Total", "Vendor Name"))
    return A.conformed("purchase", out).groupBy("vendor", "po_status").agg(
        F.sum("qty_ordered").alias("ordered"), F.sum("qty_received").alias("received"), F.sum("qty_pending").alias("pending"),
        F.count("qty_rejected").alias("rejected_rows"), P.money_sum("total").alias("value"), F.min("created_date").alias("first_po"),
    )


def _profile(name: str) -> D.StoreProfile:
    return next(p for p in D.STORE_PROFILES if p.profile_id == name)


@query
def adapt_store_flat(spark, sf):
    """Store sale lines; every eleventh line is a total that must not count."""
    rows = cell_rows(spark, sf, "if(l_orderkey % 11 = 0, 'Grand Total', concat('S', l_partkey))", "l_quantity", "l_extendedprice", "l_extendedprice * 0.5D", "date_format(l_shipdate, 'dd/MM/yyyy')")
    files = one_file(spark, "All Sports.xlsx", "Principal Code", "Total Sales Qty", "Invoice MRP Value", "Invoice Basic Value", "Invoice Date")
    out = A.adapt_flat(_profile("all_sports_sale"), rows, files)
    return out.groupBy("channel", "location", "grain", "period_start").agg(F.sum("qty_sold").alias("units"), P.money_sum("gross_value").alias("gross"), P.money_sum("net_value").alias("net"))


@query
def adapt_store_month(spark, sf):
    """Monthly style-level export: months without a year, read against the file's time."""
    rows = cell_rows(spark, sf, "concat('ST', l_partkey div 8)", "l_quantity", "l_extendedprice", "concat(' Shop ', l_suppkey % 3)", "date_format(l_shipdate, 'MMMM')")
    files = one_file(spark, "INCS.xlsx", "Item Name", "Qty", "Total", "INCS location", "Month", modified="timestamp_ntz'2001-05-20 10:00:00'")
    out = A.adapt_flat(_profile("incs"), rows, files)
    return out.groupBy("location", "period_start", "period_end").agg(F.sum("qty_sold").alias("units"), P.money_sum("net_value").alias("net"), F.countDistinct("external_id").alias("styles"))


def supplier_matrix(spark, sf) -> DataFrame:
    measure = [F.expr(f"sum(if(l_suppkey % 5 = {i}, l_quantity, 0.0D)) as `Store {i}`") for i in range(5)]
    return T.table(spark, sf, "lineitem").groupBy("l_partkey").agg(*measure, F.sum("l_quantity").alias("Grand Total"))


@query
def store_matrix_unpivot(spark, sf):
    return unpivot_matrix(supplier_matrix(spark, sf), "l_partkey")


@query
def adapt_store_matrix(spark, sf):
    wide = supplier_matrix(spark, sf)
    rows = wide.selectExpr("'f' as path", "0L as block", "l_partkey as seq", "array(concat('S', l_partkey), {}, cast(`Grand Total` as string)) as cells".format(
        ", ".join(f"cast(`Store {i}` as string)" for i in range(5))))
    files = one_file(spark, "sohreport 31-07-2001.csv", "Row Labels", *[f"Store {i}" for i in range(5)], "Grand Total")
    return A.adapt_matrix(_profile("jack_jill_soh"), rows, files).select("external_id", "location", "qty_on_hand", "snapshot_date")


def block_body(spark, sf) -> DataFrame:
    """Per part: total, then units and value per store, as a two-header sale report has them."""
    sums = ", ".join(f"cast(sum(if(l_suppkey % 3 = {i}, l_quantity, 0.0D)) as string), cast(sum(if(l_suppkey % 3 = {i}, l_extendedprice, 0.0D)) as string)" for i in range(3))
    return T.table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.expr(f"array(if(l_partkey % 50 = 0, 'Grand Total', concat('S', l_partkey)), cast(sum(l_quantity) as string), {sums}) as cells")
    ).selectExpr("'f' as source_file", "cells")


LABELS = "array('Row Labels', 'Grand Total', 'KOHIMA', '', '5TH MILE', null, ' DIMAPUR ', '') as labels"
MEASURES = "array('', 'Sum of Sold Qty', 'Sold Qty', 'Value', 'Sold Qty', 'Value', 'SOLD QTY', 'Value') as measures"


@query
def store_blocks_unpivot(spark, sf):
    header = spark.range(1).selectExpr("'f' as source_file", LABELS, MEASURES)
    return unpivot_blocks(block_body(spark, sf), block_columns(header))


@query
def adapt_store_blocks(spark, sf):
    files = spark.range(1).selectExpr("'f' as path", "'salereport_31-07-2001.csv' as name", LABELS, MEASURES)
    rows = block_body(spark, sf).selectExpr("source_file as path", "cells")
    out = A.adapt_blocks(_profile("jack_jill_sale"), rows, files)
    return out.groupBy("channel", "location", "period_start", "period_end").agg(F.sum("qty_sold").alias("units"), F.count(F.lit(1)).alias("rows"))


@query
def tolerant_columns(spark, sf):
    """Sum the columns a loose spelling finds in the supplier table."""
    df = T.table(spark, sf, "supplier").withColumnsRenamed({"s_acctbal": "Acct  Balance (INR) ", "s_suppkey": "Supplier Key"})
    money, key = pick_column(df, "balance"), pick_column(df, "supplier key")
    return df.agg(F.count(F.col(f"`{key}`")).alias("rows"), P.money_sum(F.col(f"`{money}`")).alias("value"))


# --------------------------------------------------------- sinks and runs


@query
def latest_runs(spark, sf):
    rows = T.table(spark, sf, "lineitem").selectExpr("date_format(l_shipdate, 'yyyy-MM') as run_id", "l_quantity")
    return W.latest_runs(rows).groupBy("run_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").alias("qty"))


@query
def prunable_runs(spark, sf):
    return W.prunable_runs(T.table(spark, sf, "lineitem").selectExpr("date_format(l_shipdate, 'yyyy-MM') as run_id"))


@query
def dashboard_payload(spark, sf):
    s, i, p = K.facts(spark, sf)
    def units(df, key, measure):
        return df.select(key, F.col(measure).cast("bigint").alias("units"))

    return W.payload_rows({
        "channel": (units(P.channel_pivot(P.channel(s)), "channel", "units_sell_in"), [F.asc("channel")], None),
        "sku": (units(P.sku(s, i), "master_sku", "qty_sold_sell_out"), [F.desc("units"), F.asc("master_sku")], 40),
        "po_vendor": (units(P.po_vendor(p).filter("vendor is not null and po_status = 'Approved'"), "vendor", "pending"), [F.desc("units"), F.asc("vendor")], 20),
        "po_sku": (units(P.po_sku(p, i, s), "master_sku", "on_order"), [F.desc("units"), F.asc("master_sku")], 25),
    })


@query
def rule_mismatches(spark, sf):
    """SKUs whose recent class differs from the overall one."""
    return V.mismatches(cut_lineage(K.sku_table(spark, sf), "svs-sku"), "Sku Code", M.q("Overall Movement"), M.q("Movement"))


@query
def tie_out_scoped(spark, sf):
    """Tie-out of one facility: both sides carry the same scope."""
    from stockweave.operators.facts import facility_rows

    raw = facility_rows(T.purchase_extract(spark, sf), "facility", "LOC1")
    fact = K.FP.fact_purchase(raw, K.lookup(spark, sf))
    return V.tie_out(raw, fact, V.purchase_pairs("Purchase orders"))


# ------------------------------------------------------- history, streaming


@query
def po_history_aliases(spark, sf):
    """Hand-made slices with their own header spellings, folded into one history."""
    line = T.table(spark, sf, "lineitem")
    spelled = line.selectExpr(
        "concat(' PO', l_orderkey, ' ') as `PO Number`", "concat('S', l_linenumber) as `Child SKU`", "l_quantity as `Qty Ordered`",
        "date_format(l_shipdate, 'dd/MM/yyyy') as `Last Updated`", "l_partkey", "l_suppkey", "l_extendedprice",
    )
    canon = B.alias_headers(spelled).withColumn("_when", K.D.parse_when(F.col("Updated")))
    merged = L.merge_history(None, canon, B.PO_KEYS, ["_when", "l_partkey", "l_suppkey", "Order Quantity", "l_extendedprice"])
    return merged.select(F.col("PO Code").alias("po_code"), F.col("Item SkuCode").alias("sku"), F.col("Order Quantity").alias("ordered"), F.col("_when").alias("updated"))


@query
def po_history_stream(spark, sf):
    """The history upsert as a stream over the line item file."""
    root = work_dir(spark, "po-history")
    stream = spark.readStream.schema(T.SCHEMAS["lineitem"]).option("pathGlobFilter", "lineitem.parquet").parquet(sf)
    keys = ["l_orderkey", "l_linenumber"]
    SH.run_slices(stream, f"{root}/log", f"{root}/checkpoint", keys, PO_VERSION_ORDER)
    merged = SH.read_history(spark, f"{root}/log", keys, PO_VERSION_ORDER)
    return merged.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")


@query
def alert_lifecycle_stream(spark, sf):
    """Two runs arrive one after the other; the second one's outcome."""
    root = work_dir(spark, "alert-stream")
    schema = "key string, alert string, sku string, label string, item string, priority double"
    names = ("key", "alert", "sku", "label", "item", "priority")
    for run, asof in enumerate((T.EARLIER_ASOF, T.ASOF)):
        K.alerts(spark, sf, asof).select(*names).write.parquet(f"{root}/runs/run={run}")
        stream = spark.readStream.schema(schema).parquet(f"{root}/runs").select(*names)
        SA.run_alerts(stream, root, f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/outcome/batch=1").select("key", "status", "first_seen", "cycles", "priority")


@query
def alert_runs_waiting(spark, sf):
    """Three runs wait before one trigger: the outcome of every run, as if each had come alone."""
    root = work_dir(spark, "alert-runs")
    names = ("key", "alert", "sku", "label", "item", "priority")
    open_ = T.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "concat('late|', l_partkey) as key", "'late' as alert", "concat('S', l_partkey) as sku", "'Late' as label",
        "'' as item", "cast(l_partkey as double) as priority",
    )
    for run in range(3):
        waiting = open_.filter(f"(l_orderkey div 4 + {run}) % 3 <> 0").select(*names).distinct()
        waiting.withColumn("run_id", F.lit(f"run-{run}")).write.mode("append").parquet(f"{root}/runs")
    schema = "key string, alert string, sku string, label string, item string, priority double, run_id string"
    SA.run_alerts(spark.readStream.schema(schema).parquet(f"{root}/runs"), root, f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/outcome/batch=0").select(F.col("run").alias("run_id"), "key", "status", "first_seen", "cycles", "priority")


@query
def po_history_ties(spark, sf):
    """Many equal stamps: a slice beats the history, and the later row of the later file an earlier one."""
    line = T.table(spark, sf, "lineitem").withColumn("stamp", F.trunc("l_shipdate", "year"))
    history, fresh = line.filter("l_returnflag <> 'N'"), line.filter("l_returnflag = 'N'")
    merged = L.merge_history(
        L.merge_history(None, history, ["l_partkey", "l_suppkey"], ["stamp"], ["l_orderkey", "l_linenumber"]), fresh,
        ["l_partkey", "l_suppkey"], ["stamp"], ["l_orderkey", "l_linenumber"],
    )
    return merged.select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_returnflag")


# ------------------------------------------------------------ whole folders


@query
def master_layouts(spark, sf):
    """The master sheet found and read in three layouts: header in row 1, 0 and 2, columns in other places, one name twice."""
    out = None
    for layout in range(3):
        raw = DM.master_sheet(T.master_cells(spark, sf, layout).unionByName(order_sheets(spark, sf)))
        ids = [F.col(f"`{c}`") if c in raw.columns else F.lit(None).cast("string") for c in ("AZ ASIN", "FK SKU", "FSN")]
        rows = raw.select(
            F.lit(layout).alias("layout"), F.col("Sku Code").alias("sku"), F.col("Item Name").alias("style"),
            *[c.alias(n) for c, n in zip(ids, ("az_asin", "fk_sku", "fsn"))], (F.col("row_seq") - F.lit((2, 1, 3)[layout])).alias("place"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def folder_run(spark, sf):
    """Fifteen files and a workbook, written from all of lineitem and part, through ``run_folder`` twice; what every table says of them.

    Nothing but the folder is given. Read back from storage: facts, audit,
    skipped and superseded files, rejects, tie-outs, the published SKU table and status rows.
    """
    root = work_dir(spark, "folder")
    T.write_folder(spark, sf, f"{root}/in")
    for n in range(2):
        run_folder(spark, f"{root}/in", f"{root}/out", run_id=f"run-{n}", asof=T.ASOF)
    sales, inventory, purchases = B.load_facts(spark, f"{root}/out/facts")
    report = lambda n: spark.read.parquet(f"{root}/out/reports/{n}")

    def says(df, section, name, **figures):
        """One row per figure of each row."""
        pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("figure"), v.cast("double").alias("value")) for k, v in figures.items()]))
        return df.select(F.lit(section).alias("section"), name.alias("name"), pairs.alias("p")).select("section", "name", "p.*")

    one, skus = F.lit(1), W.read_published(spark, f"{root}/out", "sku_wise")
    by_basis = sales.groupBy("source_file", "flow", "value_basis").agg(F.count(one).alias("n"), F.round(F.sum("net_value"), 2).alias("net"))
    vendors = purchases.groupBy("vendor").agg(F.count(one).alias("n"), F.sum("qty_pending").alias("pending"))
    stock = inventory.groupBy("source_file", "location").agg(F.sum("qty_on_hand").alias("qty"))
    kinds = skus.groupBy("Category", "Gender", "Style Re-order Status", "Reorder Status").agg(F.count(one).alias("n"))
    col, text = F.col, lambda *cs: F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("-")) for c in cs])
    parts = (
        says(by_basis, "sales", text("source_file", "flow", "value_basis"), rows=col("n"), net=F.coalesce("net", F.lit(0.0))),
        says(stock, "stock", text("source_file", "location"), qty=col("qty")),
        says(vendors, "vendor", col("vendor"), rows=col("n"), pending=col("pending")),
        says(report("load_audit"), "audit", text("kind", "source_file"), rows=col("rows"), matched=col("matched"), qty=col("qty")),
        says(report("skipped_files"), "skipped", text("file", "kind", "reason"), files=one),
        says(report("superseded_files"), "superseded", text("file", "kind", "reason"), files=one),
        says(report("tie_out_sources").groupBy("result").agg(F.countDistinct("source_file").alias("n")), "tie-out", col("result"), files=col("n")),
        says(kinds, "skus", text("Category", "Gender", "Style Re-order Status", "Reorder Status"), skus=col("n")),
        says(W.read_status(spark, f"{root}/out").groupBy("verdict").agg(F.count(one).alias("n")), "status", col("verdict"), runs=col("n")),
    )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
