"""Table schemas and the fixed configuration tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


TEXT, QTY, WHEN = T.StringType(), T.DoubleType(), T.TimestampNTZType()

FACT_SALES = _struct(
    source_file=TEXT, source_type=TEXT, channel=TEXT, channel_type=TEXT, location=TEXT,
    flow=TEXT, grain=TEXT, period_start=WHEN, period_end=WHEN,
    external_id=TEXT, external_id_type=TEXT, matched_via=TEXT, master_sku=TEXT, style_code=TEXT,
    qty_sold=QTY, qty_ordered=QTY, qty_returned=QTY, gross_value=QTY, net_value=QTY,
    discount_value=QTY, returns_value=QTY, value_basis=TEXT,
)

FACT_INVENTORY = _struct(
    source_file=TEXT, source_type=TEXT, channel=TEXT, channel_type=TEXT, location=TEXT,
    snapshot_date=WHEN, external_id=TEXT, external_id_type=TEXT, matched_via=TEXT,
    master_sku=TEXT, style_code=TEXT, qty_on_hand=QTY, value_on_hand=QTY,
)

FACT_PURCHASE = _struct(
    source_file=TEXT, source_type=TEXT, po_code=TEXT, po_status=TEXT, po_type=TEXT,
    created_date=WHEN, approved_date=WHEN, delivery_date=WHEN, vendor=TEXT, vendor_code=TEXT,
    facility=TEXT, external_id=TEXT, external_id_type=TEXT, matched_via=TEXT,
    master_sku=TEXT, style_code=TEXT, qty_ordered=QTY, qty_received=QTY, qty_pending=QTY,
    qty_rejected=QTY, unit_price=QTY, sub_total=QTY, total=QTY, ageing_days=QTY,
)

RAW_CELLS = T.StructType([
    T.StructField("source_file", TEXT), T.StructField("sheet", TEXT),
    T.StructField("row_idx", T.LongType()), T.StructField("cells", T.ArrayType(TEXT)),
])

# --------------------------------------------------------------------------
# They decide results, so they are stated as plain text here.
# --------------------------------------------------------------------------

# Master sheet column -> identifier type.
MASTER_ID_COLUMNS = {
    "Sku Code": "sku_code",
    "Item Name": "style_code",
    "Myntra article no": "myntra_article",
    "Myntra style id": "myntra_style_id",
    "AZ sku": "az_sku",
    "AZ ASIN": "az_asin",
    "Nykaa vendor sku": "nykaa_vendor_sku",
    "Nykaa SKU": "nykaa_sku",
    "FK SKU": "fk_sku",
    "FK FSN": "fk_fsn",
    "TCQ SKU": "tcq_sku",
    "TCQ ID": "tcq_id",
    "AJIO SKU": "ajio_sku",
    "Jio code": "jio_code",
    "FLIPKART SKU": "flipkart_sku",
    "FSN": "fsn",
}

# Identifier types tried, in this order, when the declared one misses.
FALLBACK_ID_TYPES = (
    "sku_code", "az_asin", "az_sku", "nykaa_vendor_sku", "fk_sku",
    "tcq_sku", "ajio_sku", "myntra_article", "flipkart_sku", "jio_code",
)

# Ledger -> (channel, channel type, flow). A shop adds its own web-store
# ledgers with channel_map_with().
CHANNEL_MAP = {
    "MYNTRAPPMP": ("Myntra", "marketplace", "sell_in"),
    "NYKAA_FASHION": ("Nykaa Fashion", "marketplace", "sell_in"),
    "NYKAA_COM": ("Nykaa", "marketplace", "sell_in"),
    "TATACLIQ": ("Tata Cliq", "marketplace", "sell_in"),
    "AJIO": ("AJIO", "marketplace", "sell_in"),
    "FLIPKART": ("Flipkart", "marketplace", "sell_in"),
    "COCOBLU RETAIL LIMITED.": ("Amazon Vendor Central", "marketplace", "sell_in"),
    "COCOBLU P.O": ("Amazon Vendor Central", "marketplace", "sell_in"),
    "COCOBLU PO": ("Amazon Vendor Central", "marketplace", "sell_in"),
    "SNAPMINT": ("D2C Website", "d2c", "sell_out"),
    "POPCLUB": ("D2C Website", "d2c", "sell_out"),
    "ALL SPORTS": ("All Sports", "retail_store", "sell_in"),
    "INCS KOC": ("INCS", "retail_store", "sell_in"),
    "J&J_KOHIMA_B2B": ("Jack & Jill", "retail_store", "sell_in"),
    "J&J_5TH_MILE_B2B": ("Jack & Jill", "retail_store", "sell_in"),
    "J&J_DIMAPUR_B2B": ("Jack & Jill", "retail_store", "sell_in"),
    "J&J_CHUMOUKEDIMA_B2B": ("Jack & Jill", "retail_store", "sell_in"),
    "PROMO": ("Promotions", "internal", "exclude"),
}

# Age bucket, last day inside it, expected sell-through.
AGEING_LADDER = (
    ("0-1 month", 31, 0.20),
    ("1-3 months", 92, 0.40),
    ("3-6 months", 183, 0.46),
    ("6-9 months", 274, 0.46),
    ("9-12 months", 365, 0.46),
    (">1 year", 730, 0.46),
    (">2 years", 1_000_000, 0.46),
)
SLOW_CUT, FAST_CUT = 0.75, 1.25

# Months of cover below which stock counts as low / normal.
LOW_COVER, NORMAL_COVER = 1.5, 3.0

# Season prefix -> month its goods arrive; date for seasons with no year.
SEASON_MONTH = {"SS": 2, "AW": 8}
UNDATED_SEASON = "2023-08-01"

# Merchandising inventory column -> channel that feeds it.
INVENTORY_COLUMNS = {
    "all sports inv": "All Sports",
    "J&J Inv": "Jack & Jill",
    "OR inv": "Amazon Vendor Central",
    "D8 inv": "Warehouse",
    "INCS inv": "INCS",
}
MARKETPLACE_CHANNEL = "Amazon Vendor Central"
STORE_TYPE = "retail_store"

# PO states that are finished.
CLOSED_PO = ("COMPLETE", "COMPLETED", "CANCELLED", "CANCELED", "CLOSED")

# Sources that are one picture of stock; two of them must never be summed.
SNAPSHOT_KINDS = (
    "uniware_inventory", "amazon_vc_inventory", "uniware_item_master",
    "uniware_purchase_orders", "store_flat_soh", "store_matrix_soh",
)

EXCLUDED_FOLDERS = ("output", "_archive", "archive", "exports", ".git", "__pycache__", "old", "backup")
CONTROL_FILES = ("reorder_status.csv", "channel_map.csv", "reconciliation_checks.csv")
INPUT_SUFFIXES = ("csv", "xlsx", "xls", "xlsm")

MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")

# Folded header spelling -> PO column.
PO_HEADER_ALIASES = {
    "pocode": "PO Code", "ponumber": "PO Code", "pono": "PO Code",
    "purchaseordercode": "PO Code", "purchaseorderno": "PO Code", "purchaseordernumber": "PO Code",
    "itemskucode": "Item SkuCode", "skucode": "Item SkuCode", "sku": "Item SkuCode",
    "itemsku": "Item SkuCode", "childsku": "Item SkuCode",
    "orderquantity": "Order Quantity", "orderedquantity": "Order Quantity",
    "orderedunits": "Order Quantity", "qtyordered": "Order Quantity",
    "recievedquantity": "Recieved Quantity", "receivedquantity": "Recieved Quantity",
    "qtyreceived": "Recieved Quantity",
    "pendingquantity": "Pending Quantity", "rejectedquantity": "Rejected Quantity",
    "created": "Created", "createddate": "Created", "podate": "Created", "purchaseorderdate": "Created",
    "updated": "Updated", "lastupdated": "Updated", "modified": "Updated",
}

SEVERITY_RANK = {"high": 0, "medium": 1, "info": 2}
HANDLED_NOTES = ("ordered", "po raised", "done", "actioned", "no")

DEFAULT_RULES = {
    "version": 1,
    "digest": {"top_n": 15, "send_when_no_change": False},
    "valuation": {"fallback_to_asp": True},
    "alerts": {
        "out_of_stock": {
            "enabled": True, "severity": "high", "label": "Out of stock",
            "min_monthly_ros": 0.5, "rank_by": "revenue_at_risk",
        },
        "low_stock": {
            "enabled": True, "severity": "high", "label": "Low stock",
            "cover_days": 21, "min_monthly_ros": 0.5, "rank_by": "revenue_at_risk",
        },
        "reorder_level": {
            "enabled": True, "severity": "medium", "label": "Reorder level reached",
            "respect_manual_override": True, "rank_by": "revenue_at_risk",
        },
        "best_sellers": {
            "enabled": True, "severity": "info", "label": "Best sellers",
            "min_units_sold": 5, "rank_by": "revenue_at_risk",
        },
        "high_returns": {
            "enabled": True, "severity": "high", "label": "High returns",
            "return_rate": 0.15, "min_units_sold": 5, "rank_by": "value_at_risk",
        },
        "slow_moving": {
            "enabled": True, "severity": "medium", "label": "Slow moving",
            "min_value": 5000, "rank_by": "value_at_risk",
        },
        "dead_stock": {
            "enabled": True, "severity": "high", "label": "Dead stock",
            "ageing_buckets": [">1 year", ">2 years"], "min_units": 5, "rank_by": "value_at_risk",
        },
        "stock_ageing": {
            "enabled": True, "severity": "medium", "label": "Stock ageing",
            "ageing_buckets": [">2 years"], "min_units": 5, "rank_by": "value_at_risk",
        },
    },
}

PERIOD_DAYS, RECENT_DAYS = 60, 15
STALE_AFTER_DAYS = 10
RUNS_KEPT = 12
REPORT_ZONE = "Asia/Kolkata"


def channel_map_with(own_site_ledgers=(), extra=None):
    """The shipped ledger table plus a shop's own web-store ledgers."""
    table = dict(CHANNEL_MAP)
    table.update({name.strip().upper(): ("D2C Website", "d2c", "sell_out") for name in own_site_ledgers})
    table.update(extra or {})
    return table
