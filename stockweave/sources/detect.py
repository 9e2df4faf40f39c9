"""What a file is: rules over its first lines, its name and the store profiles."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from stockweave import schemas as S
from stockweave.sources.scan import HEAD_ROWS


@dataclass(frozen=True)
class StoreProfile:
    """How to read one store's export; a new store is one more entry."""

    profile_id: str
    kind: str
    channel: str
    file_type: str
    match: str
    sheet: str = ""
    probe: tuple[str, ...] = ()
    header: int = 0
    columns: dict = field(default_factory=dict)
    location: str | None = None
    grain: str = "period"
    flow: str = "sell_out"
    id_type: str = "sku_code"
    period_days: int | None = None
    measure_label: str = "sold"


# They name the columns each store really sends.
STORE_PROFILES = (
    StoreProfile(
        "all_sports_sale", "store_flat", "All Sports", "xlsx", r"all\s*sports", r"sale", ("principal code", "invoice"),
        columns={"external_id": "Principal Code", "qty_sold": "Total Sales Qty", "gross_value": "Invoice MRP Value",
                 "net_value": "Invoice Basic Value", "discount_value": "Invoice Discount Value", "date": "Invoice Date"},
        location="All Sports", grain="day"),
    StoreProfile(
        "all_sports_soh", "store_flat_soh", "All Sports", "xlsx", r"all\s*sports", r"soh|stock", ("principal code", "stock on hand"),
        columns={"external_id": "Principal Code", "qty_on_hand": "Total Stock On Hand", "gross_value": "Total MRP Value"},
        location="All Sports"),
    StoreProfile(
        "incs", "store_flat", "INCS", "xlsx", r"incs", r".*", ("item name", "qty"),
        columns={"external_id": "Item Name", "qty_sold": "Qty", "net_value": "Total", "location": "INCS", "month": "Month"},
        grain="month", id_type="style_code"),
    StoreProfile(
        "jack_jill_sale", "store_blocks", "Jack & Jill", "csv", r"salereport", period_days=7, measure_label="sold qty"),
    StoreProfile("jack_jill_soh", "store_matrix_soh", "Jack & Jill", "csv", r"sohreport", header=1),
)


def probe_hits(cells: str | Column, probes) -> Column:
    """How many probe words occur inside some cell."""
    cells = F.col(cells) if isinstance(cells, str) else cells
    low = F.transform(cells, lambda c: F.lower(F.trim(F.replace(F.coalesce(c, F.lit("")), F.lit("\u00a0"), F.lit(" ")))))

    def hit(probe: str) -> Column:
        return F.exists(low, lambda c: c.contains(probe)).cast("int")

    return sum((hit(p) for p in probes), F.lit(0))


def find_header_row(head: DataFrame, probes, keys=("source_file", "sheet"), within: int = HEAD_ROWS) -> DataFrame:
    """First of the leading rows in which at least two probe words occur."""
    hit = (F.col("row_idx") < within) & (probe_hits("cells", probes) >= 2)
    return head.groupBy(*keys).agg(F.min(F.when(hit, F.col("row_idx"))).alias("header_row"))


def _has_all(header: Column, *names: str) -> Column:
    return F.size(F.array_except(F.array(*[F.lit(n) for n in names]), header)) == 0


def _has_any(header: Column, *names: str) -> Column:
    return F.arrays_overlap(header, F.array(*[F.lit(n) for n in names]))


def classify_source(headers: DataFrame, profiles=STORE_PROFILES) -> DataFrame:
    """Kind of every CSV from its first two lines (h0, h1: lower-case cells) and its name.

    A file with a banner line has its header in the second line, so that one is
    tested first; stock is tested before sales, whose columns it also carries.
    """
    none = F.array().cast("array<string>")
    h0, h1 = F.coalesce("h0", none), F.coalesce("h1", none)

    def marketplace(h: Column) -> Column:
        asin = F.array_contains(h, "asin")
        stock = F.exists(h, lambda c: c.contains("on hand") | c.contains("on-hand"))
        sale = _has_any(h, "shipped units", "ordered revenue", "shipped cogs")
        return F.when(asin & stock, "amazon_vc_inventory").when(asin & sale, "amazon_vc_sales")

    second, first = marketplace(h1), marketplace(h0)
    ledger = F.array_contains(h0, "channel ledger")
    kind = (
        F.when(second.isNotNull(), second)
        .when(first.isNotNull(), first)
        .when(_has_all(h0, "product sku code", "channel ledger", "qty"), "uniware_tally_gst")
        .when(ledger & ~F.array_contains(h0, "product sku code"), "uniware_returns")
        .when(F.array_contains(h0, "po code") & _has_any(h0, "item skucode", "order quantity"), "uniware_purchase_orders")
        .when(_has_all(h0, "item skucode", "facility"), "uniware_inventory")
        .when(_has_all(h0, "product code", "category code", "mrp"), "uniware_item_master")
    )
    profile = F.lit(None).cast("string")
    header = F.when(second.isNotNull(), 1).otherwise(0)
    for p in reversed([p for p in profiles if p.file_type == "csv"]):
        hit = kind.isNull() & F.col("name").rlike(f"(?i){p.match}")
        profile = F.when(hit, p.profile_id).otherwise(profile)
        header = F.when(hit, p.header).otherwise(header)
    by_profile = F.coalesce(*[F.when(profile == p.profile_id, p.kind) for p in profiles])
    return headers.withColumns({
        "kind": F.coalesce(kind, by_profile, F.lit("UNRECOGNISED")),
        "profile_id": profile,
        "header_row": header,
        "note": F.when(second.isNotNull(), "header on line 2").when(F.coalesce(kind, by_profile).isNull(), "no rule matched").otherwise(""),
    })


def csv_headers(head: DataFrame) -> DataFrame:
    """First two lines of every file side by side."""
    low = F.transform("cells", lambda c: F.lower(c))
    return head.filter("row_idx < 2").groupBy("path").agg(
        F.min_by(F.when(F.col("row_idx") == 0, low), F.when(F.col("row_idx") == 0, 0)).alias("h0"),
        F.min_by(F.when(F.col("row_idx") == 1, low), F.when(F.col("row_idx") == 1, 0)).alias("h1"),
    )


def match_store_profile(raw_cells: DataFrame, profiles=STORE_PROFILES) -> DataFrame:
    """Kind, profile and header row per workbook sheet.

    The first profile whose name and sheet patterns fit decides; its probe words
    must then locate a header. All probes are counted in one aggregation.
    """
    sheets = [p for p in profiles if p.file_type == "xlsx"]
    rows = raw_cells.filter(F.col("row_idx") < HEAD_ROWS).groupBy("source_file", "sheet").agg(*[
        F.min(F.when(probe_hits("cells", p.probe) >= 2, F.col("row_idx"))).alias(f"_h{i}") for i, p in enumerate(sheets)
    ])
    chosen, header, kind = (F.lit(None).cast(t) for t in ("string", "long", "string"))
    for i, p in reversed(list(enumerate(sheets))):
        fits = F.col("source_file").rlike(f"(?i){p.match}") & F.col("sheet").rlike(f"(?i){p.sheet}")
        chosen = F.when(fits, p.profile_id).otherwise(chosen)
        header = F.when(fits, F.col(f"_h{i}")).otherwise(header)
        kind = F.when(fits, p.kind).otherwise(kind)
    found = header.isNotNull()
    return rows.select(
        "source_file", "sheet",
        F.when(found, kind).otherwise("UNRECOGNISED").alias("kind"),
        F.when(found, chosen).alias("profile_id"), header.alias("header_row"),
        F.when(found, "").otherwise("no profile matched this sheet").alias("note"),
    )


def master_files(raw_cells: DataFrame) -> DataFrame:
    """Workbooks whose first rows name the SKU code and a marketplace id; none of them is an extract."""
    text = F.lower(F.concat_ws(" ", "cells"))

    def says(word):
        return F.bool_or(text.contains(word))

    seen = raw_cells.filter("row_idx < 4").groupBy("source_file").agg(
        says("sku code").alias("sku"), (says("asin") | says("fsn") | says("myntra")).alias("market")
    )
    return seen.filter("sku and market").select("source_file")


def detect_master(raw_cells: DataFrame) -> DataFrame:
    """The master sheet's file; of several the last one."""
    return master_files(raw_cells).agg(F.max("source_file").alias("source_file"))


# ---------------------------------------------------------------- duplicates


def facility_tag(name: str | Column) -> Column:
    """TAG of Report__TAG.csv or Report__TAG_yyyymmdd_hhmm.csv."""
    n = F.col(name) if isinstance(name, str) else name
    return F.upper(F.regexp_extract(n, "__([A-Za-z0-9_]+?)(?:_\\d{8}_\\d{4})?\\.csv$", 1))


def dedupe_files(files: DataFrame, facility: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, superseded): each source once, newest wins, with a reason for every other file.

    ``files``: path, name, kind, sheet, modified, bytes, digest and optionally
    profile_id, which keeps two stores' files of one kind apart. Winners come
    from aggregates that merge map-side and are joined back; no group of copies
    is ever sorted in one task.
    """
    f = files if "profile_id" in files.columns else files.withColumn("profile_id", F.lit(""))
    tag, combined = facility_tag("name"), F.upper("name").contains("__COMBINED")
    f = f.withColumns({
        "sheet": F.coalesce("sheet", F.lit("")), "_profile": F.coalesce("profile_id", F.lit("")),
        "_tag": tag, "_combined": combined, "_seq": F.struct("path", "sheet"),
    })
    want = (facility or "").upper()
    foreign = (F.col("_tag") != "") & (F.col("_tag") != want) & ~F.col("_tag").contains("COMBINED") if want else F.lit(False)
    f = f.withColumn("r_scope", F.when(foreign, F.concat(F.lit("facility "), "_tag", F.lit(f" — this run is scoped to {want}"))))

    # A combined file stands for the per-facility splits of its kind.
    kinds = f.filter("r_scope is null").groupBy(F.col("kind").alias("_k")).agg(F.bool_or("_combined").alias("_has_combined"))
    f = f.join(kinds, F.col("kind") == F.col("_k"), "left").drop("_k")
    split = F.col("r_scope").isNull() & F.col("_has_combined") & (F.col("_tag") != "") & ~F.col("_combined")
    f = f.withColumn("r_split", F.when(split, "per-facility split; a __COMBINED file for this report is present"))

    # Same content under another name: the earliest stays.
    live = "r_scope is null and r_split is null"
    firsts = (
        f.filter(live).filter("digest is not null").groupBy(F.col("digest").alias("_d"), F.col("sheet").alias("_s"), F.col("bytes").alias("_b"))
        .agg(F.min(F.struct("_seq", "name")).alias("_first"))
    )
    f = f.join(firsts, (F.col("digest") == F.col("_d")) & (F.col("sheet") == F.col("_s")) & (F.col("bytes") == F.col("_b")), "left").drop("_d", "_s", "_b")
    copy = F.expr(live) & F.col("_first").isNotNull() & (F.col("_first._seq") != F.col("_seq"))
    f = f.withColumn("r_copy", F.when(copy, F.concat(F.lit("byte-identical duplicate of "), "_first.name")))

    # One file per kind, sheet, facility and profile.
    f = f.withColumn("_group", F.when(F.col("_combined"), "").otherwise(F.col("_tag")))
    keys = ["kind", "sheet", "_group", "_profile"]
    newest = (
        f.filter(live + " and r_copy is null").filter(~F.col("kind").isin("UNRECOGNISED", "UNREADABLE")).groupBy(*keys)
        .agg(F.max(F.struct("modified", "_seq", "name", "bytes")).alias("_win"))
    )
    f = f.join(newest, keys, "left")
    beaten = F.expr(live + " and r_copy is null") & F.col("_win").isNotNull() & (F.col("_win._seq") != F.col("_seq"))
    why = F.when(
        F.col("kind").isin(*S.SNAPSHOT_KINDS), "point-in-time snapshot — summing two would double-count stock"
    ).otherwise("overlapping window — summing two would double-count sales")
    larger = F.when(
        F.col("bytes") > F.col("_win.bytes") * F.lit(1.2),
        F.concat(F.lit("  ** WARNING: the superseded file is larger ("), F.format_number("bytes", 0), F.lit(" vs "),
                 F.format_number("_win.bytes", 0), F.lit(" bytes) — the newer pull may cover a shorter window **")),
    ).otherwise("")
    f = f.withColumn("r_old", F.when(beaten, F.concat(why, F.lit("; superseded by "), "_win.name", larger)))
    judged = f.withColumn("reason", F.coalesce("r_scope", "r_split", "r_copy", "r_old"))
    kept = judged.filter("reason is null").select(*files.columns)
    lost = judged.filter("reason is not null").select("path", F.col("name").alias("file"), "kind", "reason")
    return kept, lost
