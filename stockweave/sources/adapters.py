"""Source rows to canonical columns.

An adapter is data: which header feeds which canonical column and how its text
is read. Header positions are looked up once per file, on the file table; the
rows themselves only index into their cell array.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from stockweave import schemas as S
from stockweave.functions.dates import (
    back_fill_start, month_to_period, parse_dates, period_from_name, snapshot_date, warehouse_snapshot,
)
from stockweave.functions.numbers import money, money_text, num, num_text, text_value
from stockweave.operators.facts import conform, drop_total_rows
from stockweave.operators.unpivot import block_columns, unpivot_blocks
from stockweave.sources.detect import STORE_PROFILES, StoreProfile


def text(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: str | Column) -> Column:
    return F.trim(text(c))


@dataclass(frozen=True)
class Source:
    """One canonical column: accepted headers (first present wins) and its parser."""

    headers: tuple[str, ...]
    parse: Callable[[Column], Column] = text
    part_of_name: bool = False


@dataclass(frozen=True)
class Adapter:
    fact: str
    columns: dict[str, Source]
    constants: dict[str, str] = field(default_factory=dict)
    dates: tuple[str, ...] = ()
    period: str | None = None  # "name": from the file name, else the date column that gives the day


def _s(*headers: str, parse=text, part: bool = False) -> Source:
    return Source(headers, parse, part)


AMAZON = {"channel": "Amazon Vendor Central", "channel_type": "marketplace", "location": "Amazon FC (IN)"}

ADAPTERS: dict[str, Adapter] = {
    "amazon_vc_sales": Adapter("sales", {
        "external_id": _s("ASIN"), "qty_ordered": _s("Ordered Units", parse=num), "qty_sold": _s("Shipped Units", parse=num),
        "qty_returned": _s("Customer Returns", parse=num), "gross_value": _s("Ordered Revenue", parse=money),
        "net_value": _s("Shipped COGS", parse=money),
    }, {**AMAZON, "flow": "sell_out", "grain": "period", "external_id_type": "az_asin"}, period="name"),
    "amazon_vc_inventory": Adapter("inventory", {
        "external_id": _s("ASIN"),
        "qty_on_hand": _s("Sellable On Hand Units", "Sellable On-Hand Units", parse=num, part=True),
        "value_on_hand": _s("Sellable On-Hand Inventory", parse=money, part=True),
    }, {**AMAZON, "grain": "snapshot", "external_id_type": "az_asin"}),
    "uniware_tally_gst": Adapter("sales", {
        "external_id": _s("Product SKU Code"), "ledger": _s("Channel Ledger", parse=trimmed), "qty_sold": _s("Qty", parse=num),
        "gross_value": _s("Total", parse=money), "net_value": _s("Sales", parse=money), "day": _s("Date"),
    }, {"grain": "day", "external_id_type": "sku_code"}, dates=("day",), period="day"),
    "uniware_returns": Adapter("sales", {
        "ledger": _s("Channel Ledger", parse=trimmed), "qty_returned": _s("Qty", parse=num),
        "returns_value": _s("Total", parse=money), "day": _s("Date"),
    }, {"grain": "day"}, dates=("day",), period="day"),
    "uniware_inventory": Adapter("inventory", {
        "external_id": _s("Item SkuCode"), "location": _s("Facility", parse=trimmed), "qty_on_hand": _s("Inventory", parse=num),
        "mrp": _s("MRP", parse=money),
    }, {"channel": "Warehouse", "channel_type": "warehouse", "grain": "snapshot", "external_id_type": "sku_code"}),
    "uniware_purchase_orders": Adapter("purchase", {
        "external_id": _s("Item SkuCode", "Vendor SkuCode"), "po_code": _s("PO Code"), "po_status": _s("Purchase Order Status"),
        "po_type": _s("Type"), "created_date": _s("Created"), "approved_date": _s("PO Approved Date"),
        "delivery_date": _s("Delivery Date"), "vendor": _s("Vendor Name"), "vendor_code": _s("Vendor Code"),
        "facility": _s("Facility"), "qty_ordered": _s("Order Quantity", parse=num),
        "qty_received": _s("Recieved Quantity", "Received Quantity", parse=num), "qty_rejected": _s("Rejected Quantity", parse=num),
        "qty_pending": _s("Pending Quantity", parse=num), "unit_price": _s("Unit Price", parse=money),
        "sub_total": _s("Sub Total", parse=money), "total": _s("Total", parse=money), "ageing_days": _s("PO Ageing (Days)", parse=num),
    }, {"external_id_type": "sku_code"}, dates=("created_date", "approved_date", "delivery_date")),
}
DIMENSION_KINDS = ("uniware_item_master",)
FACT_SCHEMAS = {"sales": S.FACT_SALES, "inventory": S.FACT_INVENTORY, "purchase": S.FACT_PURCHASE}


def position(source: Source, header: str = "header") -> Column:
    """0-based place of a column in a header (lower-case cells), null when absent."""
    def place(name: str, exact: bool) -> Column:
        want = name.strip().lower()
        hits = F.transform(header, lambda h: (F.trim(h) == want) if exact else h.contains(want))
        return F.nullif(F.array_position(hits, F.lit(True)), F.lit(0).cast("long"))

    exact = [place(n, True) for n in source.headers]
    part = [place(n, False) for n in source.headers] if source.part_of_name else []
    return (F.coalesce(*exact, *part) - 1).cast("int")


def pick_cells(rows: DataFrame, files: DataFrame, columns: dict[str, Source], check: bool = False) -> DataFrame:
    """Rows with one named column per source; positions are resolved per file first.

    ``check`` adds ``bad``: the headers of the cells that should hold a number and hold some other text.
    """
    clean = {num: num_text, money: money_text}
    numbers = [c for c, src in columns.items() if src.parse in clean]
    places = files.select(
        "path", "name", "sheet", *[position(src).alias(f"_at_{c}") for c, src in columns.items()],
        *[c for c in ("modified", "heading") if c in files.columns],
    )
    own = ["source_file", "name", *[c for c in ("modified", "heading") if c in files.columns], "block", "seq"]
    texts = rows.join(places, "path").withColumn(
        "source_file", F.concat("name", F.when(F.coalesce("sheet", F.lit("")) != "", F.concat(F.lit("::"), "sheet")).otherwise(""))
    ).select(*own, *[F.nullif(F.get("cells", F.col(f"_at_{c}")), F.lit("")).alias(f"_x_{c}") for c in columns])
    # All numbers of a row by one expression: one for each makes code too long for the JVM to compile.
    values = F.transform(F.array(*[clean[columns[c].parse](f"_x_{c}") for c in numbers]), text_value) if numbers else F.lit(None)
    out = texts.withColumn("_values", values).select(
        *own, *[(F.get("_values", F.lit(numbers.index(c))) if c in numbers else src.parse(F.col(f"_x_{c}"))).alias(c) for c, src in columns.items()],
        *([f"_x_{c}" for c in numbers] if check else []),
    )
    if not check:
        return out
    bad = [F.when(F.col(c).isNull() & F.trim(f"_x_{c}").rlike(r"[^-\s]"), F.lit(columns[c].headers[0])) for c in numbers]
    return out.select(*own, *columns, F.array_compact(F.array(bad) if bad else F.array().cast("array<string>")).alias("bad"))


def adapt(kind: str, rows: DataFrame, files: DataFrame, picked: DataFrame | None = None) -> DataFrame:
    """All files of a kind at once, in canonical columns (before resolution).

    ``rows``: path, block, seq, cells below the header. ``files``: path, name,
    sheet, header. ``picked``: their ``pick_cells`` for the kind, if at hand.
    """
    spec = ADAPTERS[kind]
    out = pick_cells(rows, files, spec.columns) if picked is None else picked.drop("bad")
    if spec.dates:
        out = parse_dates(out, spec.dates, by="source_file")
    out = out.withColumns({c: F.lit(v) for c, v in spec.constants.items()}).withColumn("source_type", F.lit(kind))
    if spec.period == "name":
        p = period_from_name("name")
        out = out.withColumns({"period_start": p["start"].cast("timestamp_ntz"), "period_end": p["end"].cast("timestamp_ntz")})
    elif spec.period:
        out = out.withColumns({"period_start": F.col(spec.period), "period_end": F.col(spec.period)})
    if kind == "uniware_inventory":
        out = out.withColumn("value_on_hand", F.col("qty_on_hand") * F.col("mrp")).withColumn("snapshot_date", warehouse_snapshot("name"))
    elif spec.fact == "inventory":
        out = out.withColumn("snapshot_date", period_from_name("name")["start"].cast("timestamp_ntz"))
    return out


def adapt_flat(profile: StoreProfile, rows: DataFrame, files: DataFrame, year: int | None = None) -> DataFrame:
    """Row-per-line store export, sales or stock, as its profile describes it."""
    stock = profile.kind.endswith("soh")
    wanted = {
        c: Source((h,), num if c.startswith(("qty", "gross", "net", "discount")) else text, True) for c, h in profile.columns.items()
    }
    out = drop_total_rows(pick_cells(rows, files, wanted), "external_id")
    location = trimmed("location") if "location" in wanted else F.lit(profile.location or profile.channel)
    out = out.withColumns({
        "location": location, "channel": F.lit(profile.channel), "channel_type": F.lit(S.STORE_TYPE),
        "flow": F.lit(profile.flow), "grain": F.lit(profile.grain), "external_id_type": F.lit(profile.id_type),
        "source_type": F.lit(profile.kind),
    })
    if stock:
        heading = "heading" if "heading" in files.columns else None
        return out.withColumn("snapshot_date", snapshot_date("name", heading).cast("timestamp_ntz"))
    if "date" in wanted:
        out = parse_dates(out, "date", by="source_file")
        return out.withColumns({"period_start": F.col("date"), "period_end": F.col("date")})
    p = month_to_period("month", F.col("modified"), year) if "month" in wanted else period_from_name("name")
    start = p["start"]
    if "month" not in wanted and profile.period_days:
        start = back_fill_start(p["start"], profile.period_days)
    return out.withColumns({"period_start": start.cast("timestamp_ntz"), "period_end": p["end"].cast("timestamp_ntz")})


def adapt_matrix(profile: StoreProfile, rows: DataFrame, files: DataFrame) -> DataFrame:
    """SKU rows x store columns: each header cell that names a store becomes a location."""
    stores = files.select(
        "path", "name",
        F.filter(
            F.transform("header_text", lambda h, i: F.struct(i.alias("at"), h.alias("location"))),
            lambda s: (s["at"] > 0) & ~F.coalesce(s["location"], F.lit("")).rlike("(?i)grand\\s*total|^total$|^unnamed|^\\s*$"),
        ).alias("stores"),
    )
    long = rows.join(stores, "path").select(
        F.col("name").alias("source_file"), "name", F.get("cells", F.lit(0)).alias("external_id"), "cells", F.explode("stores").alias("s")
    ).select("source_file", "name", "external_id", F.col("s.location").alias("location"), num(F.get("cells", F.col("s.at"))).alias("qty_on_hand"))
    kept = drop_total_rows(long, "external_id").filter(F.coalesce("qty_on_hand", F.lit(0.0)) != 0)
    return kept.withColumns({
        "channel": F.lit(profile.channel), "channel_type": F.lit(S.STORE_TYPE), "source_type": F.lit(profile.kind),
        "external_id_type": F.lit(profile.id_type), "snapshot_date": snapshot_date("name").cast("timestamp_ntz"),
    })


def adapt_blocks(profile: StoreProfile, rows: DataFrame, files: DataFrame) -> DataFrame:
    """Two header lines, one block of columns per store (``files``: labels, measures)."""
    columns = block_columns(files.select(F.col("path").alias("source_file"), "labels", "measures"), profile.measure_label)
    long = unpivot_blocks(rows.select(F.col("path").alias("source_file"), "cells"), columns)
    p = period_from_name("name")
    start = back_fill_start(p["start"], profile.period_days) if profile.period_days else p["start"]
    named = long.join(files.select(F.col("path").alias("source_file"), "name"), "source_file").drop("source_file")
    return named.withColumns({
        "source_file": F.col("name"), "channel": F.lit(profile.channel), "channel_type": F.lit(S.STORE_TYPE),
        "flow": F.lit("sell_out"), "grain": F.lit("period"), "source_type": F.lit(profile.kind),
        "external_id_type": F.lit(profile.id_type),
        "period_start": start.cast("timestamp_ntz"), "period_end": p["end"].cast("timestamp_ntz"),
    })


def adapt_profile(profile: StoreProfile, rows: DataFrame, files: DataFrame) -> tuple[str, DataFrame]:
    """(fact name, canonical rows) of the files a store profile claims."""
    if profile.kind == "store_blocks":
        return "sales", adapt_blocks(profile, rows, files)
    if profile.kind == "store_matrix_soh":
        return "inventory", adapt_matrix(profile, rows, files)
    return ("inventory" if profile.kind.endswith("soh") else "sales"), adapt_flat(profile, rows, files)


def raw_rows(kind: str, profile: StoreProfile | None, rows: DataFrame, files: DataFrame, picked: DataFrame | None = None) -> DataFrame:
    """The numbers of a kind's rows as its files give them, and ``bad``, the headers whose cells hold no number.

    Nothing of what the facts go through has happened yet: no scope, ledger
    map, resolution, value basis. Matrices and blocks have no column per
    measure; their raw rows are the unpivoted ones. ``picked``: ``pick_cells``
    of a kind without profile, checked, if at hand.
    """
    if profile is not None and profile.kind in ("store_blocks", "store_matrix_soh"):
        return adapt_profile(profile, rows, files)[1].withColumn("bad", F.array().cast("array<string>"))
    if profile is not None:
        wanted = {
            c: Source((h,), num if c.startswith(("qty", "gross", "net", "discount")) else text, True) for c, h in profile.columns.items()
        }
        return drop_total_rows(pick_cells(rows, files, wanted, True), "external_id").withColumn("source_type", F.lit(profile.kind))
    picked = pick_cells(rows, files, ADAPTERS[kind].columns, True) if picked is None else picked
    out = picked.withColumn("source_type", F.lit(kind))
    return out.withColumn("value_on_hand", F.col("qty_on_hand") * F.col("mrp")) if kind == "uniware_inventory" else out


def fits(cells: str = "cells", width: str = "width") -> Column:
    """Whether a row has nothing beyond its header's last column; blank cells there do not count."""
    count = F.greatest(F.size(cells) - F.col(width), F.lit(0))
    beyond = F.array_join(F.slice(cells, F.col(width) + 1, count), "")
    return F.coalesce(F.trim(beyond) == "", F.lit(True))


MORE_CELLS = "more cells than the header has columns"


def rejects(raw: DataFrame, overflow: DataFrame) -> DataFrame:
    """(source_file, reason, rows): cells that hold no number, whose rows stay, and rows that were left out as too long.

    ``raw``: rows of ``raw_rows``. ``overflow``: source_file of each row left out.
    """
    bad = raw.select("source_file", F.explode("bad").alias("header")).select("source_file", F.concat(F.lit("not a number: "), "header").alias("reason"))
    return bad.unionByName(overflow.select("source_file", F.lit(MORE_CELLS).alias("reason"))).groupBy("source_file", "reason").agg(F.count(F.lit(1)).alias("rows"))


def skipped_files(files: DataFrame) -> DataFrame:
    """Files no adapter takes, and why."""
    known = [*ADAPTERS, *[p.kind for p in STORE_PROFILES]]
    reason = F.when(F.col("kind").isin(*DIMENSION_KINDS), "dimension file, not a fact table - not loaded by design").otherwise(
        F.coalesce(F.nullif("note", F.lit("")), F.concat(F.lit("no adapter for kind '"), "kind", F.lit("'")))
    )
    return files.filter(~F.col("kind").isin(*known)).select(F.col("name").alias("file"), "sheet", "kind", reason.alias("reason"))


def conformed(fact: str, rows: DataFrame) -> DataFrame:
    return conform(rows, FACT_SCHEMAS[fact])
