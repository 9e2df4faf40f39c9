"""A folder of extracts (and a table of workbook cells) to the three facts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockweave import schemas as S
from stockweave.operators import facts as O
from stockweave.plans import facts as FP
from stockweave.plans import verification as V
from stockweave.plans.reports import fact_exceptions
from stockweave.session import cut_lineage, together
from stockweave.sources import adapters as A
from stockweave.sources import detect as D
from stockweave.sources import dimensions as M
from stockweave.sources import scan as C


#: Note of a file that has no certain rows: it counts among its like, is not loaded and is listed as skipped.
UNCLOSED = "a quoted cell is never closed"


@dataclass
class Intake:
    """What a run read: the facts and the tables that account for every file."""

    sales: DataFrame
    inventory: DataFrame
    purchases: DataFrame
    exceptions: DataFrame
    superseded: DataFrame
    skipped: DataFrame
    facility_drops: DataFrame | None
    files: DataFrame
    raw_totals: DataFrame | None = None  # per source file and metric, before anything was done to the rows
    rejects: DataFrame | None = None  # per source file: rows left out, and cells that hold no number


def detect_csv(spark: SparkSession, root: str, profiles=D.STORE_PROFILES) -> tuple[DataFrame, DataFrame]:
    """(file table, decoded lines). The file table is written once: it steers every later read."""
    files = C.scan_inputs(spark, root).filter("suffix = 'csv'")
    # The place of a line depends on how one scan was split; storing it makes it hold for every later read.
    lines = cut_lineage(C.read_lines(spark, root), "lines")
    # Tables of one row per block or file are written, so that Spark knows they are small and all lines stay where they are.
    profile = cut_lineage(C.content_profile(lines, cut_lineage(C.block_starts(lines), "starts")), "profile")
    text, unclosed = C.join_records(C.decode_lines(lines, profile), profile)
    # Read for the headers and again for the bodies.
    text = cut_lineage(text, "records")
    head = cut_lineage(C.head_rows(text), "head")
    kinds = D.classify_source(files.join(D.csv_headers(head), "path", "left"), profiles)
    kinds = kinds.join(unclosed.withColumn("_note", F.lit(UNCLOSED)), "path", "left").withColumn("note", F.coalesce("_note", "note")).drop("_note")
    blocks = F.col("kind") == "store_blocks"
    wanted = kinds.withColumn("_line", F.when(blocks, 1).otherwise(F.col("header_row"))).select("path", "_line")
    place = (
        head.join(wanted, "path").groupBy("path").agg(
            F.min_by(F.struct("block", "seq", "cells"), F.when(F.col("row_idx") == F.col("_line"), 0)).alias("h"),
            F.min_by("cells", F.when(F.col("row_idx") == 0, 0)).alias("labels"),
            F.min_by("cells", F.when(F.col("row_idx") == 1, 0)).alias("measures"),
        )
    )
    table = (
        kinds.drop("h0", "h1").join(place, "path", "left").join(profile.select("path", "rows", "digest"), "path", "left")
        .select(
            "path", "name", "folder", "modified", "bytes", "kind", "profile_id", "header_row", "note", "digest", "rows",
            F.lit("").alias("sheet"), F.col("h.block").alias("header_block"), F.col("h.seq").alias("header_seq"),
            F.transform("h.cells", lambda c: F.lower(c)).alias("header"), F.col("h.cells").alias("header_text"), "labels", "measures",
        )
    )
    return cut_lineage(table, "files"), text


def detect_sheets(raw_cells: DataFrame, profiles=D.STORE_PROFILES) -> tuple[DataFrame, DataFrame]:
    """(file table, rows) of decoded workbook sheets, in the shape CSV files have.

    ``raw_cells``: source_file, sheet, row_idx, cells, and the time ``modified``
    and size ``bytes`` of the workbook; without them no sheet is newer than another.
    """
    kinds = D.match_store_profile(raw_cells, profiles)
    key = F.concat_ws("::", "source_file", "sheet")
    head = raw_cells.filter(F.col("row_idx") < C.HEAD_ROWS).join(kinds.select("source_file", "sheet", "header_row"), ["source_file", "sheet"])
    place = head.groupBy("source_file", "sheet").agg(
        F.min_by("cells", F.when(F.col("row_idx") == F.col("header_row"), 0)).alias("cells"),
        # Lines above a header: HEAD_ROWS of them at most.
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.when(F.col("row_idx") < F.col("header_row"), F.struct("row_idx", F.concat_ws(" ", "cells").alias("text"))))),
                lambda line: line["text"],
            ),
            " ",
        ).alias("heading"),
    )
    h = F.xxhash64("row_idx", "cells")
    have = raw_cells.columns
    digest = raw_cells.groupBy("source_file", "sheet").agg(
        F.sum(h.cast("decimal(38,0)")).cast("string").alias("digest"), F.count(F.lit(1)).alias("rows"),
        (F.max("modified") if "modified" in have else F.lit(None)).cast("timestamp").alias("modified"),
        (F.max("bytes") if "bytes" in have else F.count(F.lit(1))).cast("long").alias("bytes"),
    )
    table = kinds.join(place, ["source_file", "sheet"], "left").join(digest, ["source_file", "sheet"], "left").select(
        key.alias("path"), F.col("source_file").alias("name"), "sheet", "kind", "profile_id", "header_row", "note", "digest", "rows", "heading", "modified", "bytes",
        F.transform("cells", lambda c: F.lower(F.trim(c))).alias("header"), F.col("cells").alias("header_text"),
    )
    rows = raw_cells.select(key.alias("path"), F.lit(0).cast("long").alias("block"), F.col("row_idx").cast("long").alias("seq"), "cells")
    return cut_lineage(table, "sheets"), rows


def load_folder(
    spark: SparkSession, root: str, lookup: DataFrame | None = None, channel_map: dict = S.CHANNEL_MAP,
    facility: str | None = None, raw_cells: DataFrame | None = None, profiles=D.STORE_PROFILES, master: DataFrame | None = None,
) -> Intake:
    """Detect, drop duplicates, adapt every kind at once, scope, resolve and conform.

    Without a ``lookup`` it is made of ``master``, one row per SKU, and of the
    list prices in the folder's own warehouse stock. Workbooks that are master
    sheets are no extracts.
    """
    # Rows are written once, split by kind, so an adapter reads its own files only.
    staged = partial(cut_lineage, purpose="rows", by=("kind", "profile"))

    def judged(files: DataFrame, certain=F.lit(True)) -> list[DataFrame]:
        kept, lost = D.dedupe_files(files, facility)
        return together(lambda: cut_lineage(kept.filter(certain), "kept"), lambda: cut_lineage(lost, "lost"))

    def from_csv() -> tuple[DataFrame, ...]:
        csv_files, lines = detect_csv(spark, root, profiles)
        kept, lost = judged(csv_files, F.col("note") != UNCLOSED)
        # Distinct kinds and the widest header: a handful of values, whatever the data size.
        width = kept.agg(F.coalesce(F.max(F.size("header")), F.lit(1))).first()[0]
        # One cell more than the widest header: what stands there or beyond a file's own header is seen and reported.
        own_width = F.when(~F.col("kind").isin("store_blocks", "store_matrix_soh"), F.size("header")).alias("width")
        below = C.body_cells(
            lines, kept.select("path", "kind", F.coalesce("profile_id", F.lit("-")).alias("profile"), "header_block", "header_seq", own_width), max(width, 1) + 1
        )
        return kept, lost, csv_files.withColumn("kind", F.when(F.col("note") == UNCLOSED, "UNREADABLE").otherwise(F.col("kind"))), staged(below)

    def from_sheets() -> tuple[DataFrame, ...]:
        sheet_files, sheet_rows = detect_sheets(raw_cells.join(D.master_files(raw_cells), "source_file", "left_anti"), profiles)
        kept, lost = judged(sheet_files)
        below = sheet_rows.join(
            kept.select("path", "kind", F.coalesce("profile_id", F.lit("-")).alias("profile"), "header_row"), "path"
        ).filter("seq > header_row").drop("header_row").withColumn("width", F.lit(None).cast("int"))
        return kept, lost, sheet_files, staged(below)

    def adapted(kind: str, profile_id: str | None, files: DataFrame, rows: DataFrame) -> tuple | None:
        mine = files.filter((F.col("kind") == kind) & F.col("profile_id").eqNullSafe(F.lit(profile_id)))
        every = rows.filter((F.col("kind") == kind) & (F.col("profile") == (profile_id or "-"))).drop("kind", "profile")
        own = every.filter(A.fits()).drop("width")
        profile = next((p for p in profiles if p.profile_id == profile_id), None)
        if profile is None and kind not in A.ADAPTERS:
            return None
        try:
            # Cells become columns once, for the facts and for the tables that account for them.
            picked = cut_lineage(A.pick_cells(own, mine, A.ADAPTERS[kind].columns, True), "picked") if profile is None else None
            fact, out = A.adapt_profile(profile, own, mine) if profile is not None else (A.ADAPTERS[kind].fact, A.adapt(kind, own, mine, picked))
            # Written here, so that a kind whose rows cannot be read fails alone.
            out = cut_lineage(O.map_ledger(out, channel_map) if "ledger" in out.columns else out, "adapted")
        except Exception as why:
            return kind, mine, why
        return kind, mine, own, every, profile, picked, fact, out

    def accounted(kind, mine, own, every, profile, picked, fact, out) -> tuple[DataFrame, DataFrame]:
        """What is turned down of a kind's rows, and their totals."""
        scope = "facility" if fact == "purchase" else "location" if "mrp" in out.columns else None
        raw = A.raw_rows(kind, profile, own, mine, picked)
        if picked is None:
            raw = cut_lineage(raw, "raw")
        overflow = every.filter(~A.fits()).join(mine.select("path", F.col("name").alias("source_file")), "path")
        return A.rejects(raw, overflow), V.source_totals(O.facility_rows(raw, scope, facility) if facility and scope else raw, fact)

    sources = together(from_csv, *([from_sheets] if raw_cells is not None else []))
    lost, found = reduce(DataFrame.unionByName, [s[1] for s in sources]), [s[2] for s in sources]
    steps = []
    for kept, _, _, rows in sources:
        steps += [partial(adapted, *r, kept, rows) for r in kept.select("kind", "profile_id").distinct().collect()]
    parts: dict[str, list[DataFrame]] = {"sales": [], "inventory": [], "purchase": []}
    loaded, broken, prices = [], [], None
    for done in filter(None, together(*steps)):
        if len(done) == 3:
            broken.append(done[1:])
            continue
        kind, mine, own, _, _, _, fact, out = done
        loaded.append(done)
        parts[fact].append(out)
        if kind == "uniware_inventory" and prices is None:
            prices = M.stock_prices(mine, own)
    if broken and not any(parts.values()):
        raise broken[0][1]
    if lookup is None and master is None:
        raise ValueError("either a lookup or a master is needed")

    listed = [f.select("path", "name", "sheet", "kind", "note") for f in found]
    # A workbook comes in through its sheets; one without any is accounted for by name.
    books = C.scan_inputs(spark, root).filter("suffix <> 'csv'").select(
        "path", "name", F.lit("").alias("sheet"), F.lit("workbook").alias("kind"), F.lit("workbook without decoded sheets in raw_cells").alias("note")
    )
    if raw_cells is not None:
        books = books.join(raw_cells.select(F.col("source_file").alias("name")).distinct(), "name", "left_anti")
    all_files = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*listed, books])
    # A file that another one stands for is listed as superseded only.
    skipped = A.skipped_files(all_files.join(lost.select("path"), "path", "left_anti"))
    all_files = all_files.drop("path")
    for files, why in broken:
        reason = F.lit(f"{type(why).__name__}: {str(why).splitlines()[0] if str(why) else ''}"[:300])
        skipped = skipped.unionByName(files.select(F.col("name").alias("file"), "sheet", "kind", reason.alias("reason")))

    lookup, skipped, *accounts = together(
        lambda: lookup if lookup is not None else cut_lineage(FP.lookup_for(master, prices), "lookup"), lambda: cut_lineage(skipped, "skipped"),
        *[partial(accounted, *x) for x in loaded],
    )
    turned_down, totals = [a[0] for a in accounts], [a[1] for a in accounts]
    drops = None
    if facility:
        counted = []
        for fact, column in (("purchase", "facility"), ("inventory", "location")):
            for i, frame in enumerate(parts[fact]):
                if column == "location" and "mrp" not in frame.columns:
                    continue  # only warehouse stock carries its facility as location
                counted.append(O.facility_drops(frame, column, facility))
                parts[fact][i] = O.facility_rows(frame, column, facility)
        drops = reduce(DataFrame.unionByName, counted) if counted else None

    def stacked(fact: str) -> DataFrame:
        schema = A.FACT_SCHEMAS[fact]
        if not parts[fact]:
            # The value cascade asks for a list price, also of no rows.
            return spark.createDataFrame([], schema).withColumn("mrp", F.lit(None).cast("double"))
        raw = O.union_all(parts[fact], schema)
        return FP.resolved_extract(raw, lookup)

    sales = O.conform(O.value_basis(stacked("sales")), S.FACT_SALES)
    inventory = O.conform(stacked("inventory"), S.FACT_INVENTORY)
    purchases = O.conform(stacked("purchase"), S.FACT_PURCHASE)
    return Intake(
        sales=sales, inventory=inventory, purchases=purchases, exceptions=fact_exceptions(sales, inventory, purchases),
        superseded=lost, skipped=skipped, facility_drops=drops, files=all_files,
        raw_totals=reduce(DataFrame.unionByName, totals) if totals else None, rejects=reduce(DataFrame.unionByName, turned_down) if turned_down else None,
    )
