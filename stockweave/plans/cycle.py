"""One full run: intake, facts, reports, merchandising, alerts, publishing."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockweave import schemas as S
from stockweave.functions.dates import windows
from stockweave.operators import resolve as R
from stockweave.operators.lifecycle import alert_diff, empty_state, next_state
from stockweave.plans import alerts as A
from stockweave.plans import merchandising as M
from stockweave.plans import reports as P
from stockweave.session import cut_lineage, together
from stockweave.sinks import publish as W
from stockweave.sources.dimensions import load_items, load_notes, master_sheet
from stockweave.sources.intake import Intake, load_folder
from stockweave.plans import verification as V
from stockweave.sources.scan import input_fingerprint, scan_inputs, should_skip, table_digest
from stockweave.sources.tables import load_facts

#: Folder below the inputs that holds the decoded cells of their workbooks: source_file, sheet, row_idx, cells.
RAW_CELLS = "raw_cells"


def audit(sales: DataFrame, inventory: DataFrame, purchases: DataFrame, drops: DataFrame | None = None) -> DataFrame:
    """Per kind and file: rows, matches and figures of all three facts; a file whose rows were all dropped is listed with 0 rows."""
    parts = [
        P.load_audit(fact, qty, value, drops).withColumn("kind", F.lit(kind))
        for kind, fact, qty, value in (
            ("sales", P.reported_value(sales), "qty_sold", "net_value"), ("inventory", inventory, "qty_on_hand", "value_on_hand"),
            ("purchase", purchases, "qty_ordered", "total"),
        )
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    if drops is None:
        return out
    gone = drops.join(out.select("source_file"), "source_file", "left_anti").select("source_file", F.col("rows_dropped").alias("rows_other_facility"))
    zeros = {c: F.lit(0).cast("long") for c in ("rows", "matched", "unmatched")} | {c: F.lit(0.0) for c in ("qty", "value")}
    gone = gone.withColumns(zeros | {"kind": F.lit("dropped"), "match_pct": F.lit(None).cast("double")})
    return out.unionByName(gone.select(*out.columns))


def report_set(
    sales: DataFrame, inventory: DataFrame, purchases: DataFrame, facility=None, intake: Intake | None = None
) -> dict[str, DataFrame]:
    """Every report of the run; with an intake also the tables that account for its files."""
    drops, extra, figures = None, {}, {}
    if intake is not None:
        drops = intake.facility_drops
        extra = {"skipped_files": intake.skipped, "superseded_files": intake.superseded}
        if intake.rejects is not None:
            extra["rejects"] = intake.rejects
        if intake.raw_totals is not None:
            extra["tie_out_sources"] = verified(intake, sales, inventory, purchases)
        figures = {"files_skipped": intake.skipped.count(), "files_superseded": intake.superseded.count()}
        if drops is not None:
            extra["facility_filter"] = drops
            figures["rows_dropped"] = drops.agg(F.coalesce(F.sum("rows_dropped"), F.lit(0))).first()[0]
    return extra | {
        "summary": P.summary(sales, inventory, purchases, facility=facility, **figures),
        "channel": P.channel(sales),
        "stores": P.store(sales, inventory),
        "sku_performance": P.sku(sales, inventory),
        "inventory": P.inventory_position(inventory),
        "po_by_vendor": P.po_vendor(purchases),
        "inbound_by_sku": P.po_sku(purchases, inventory, sales),
        "open_po_lines": P.open_po_lines(purchases),
        "returns": P.returns(sales),
        "exceptions": P.fact_exceptions(sales, inventory, purchases),
        "load_audit": audit(sales, inventory, purchases, drops),
        "period_coverage": P.period_coverage(sales),
        "snapshot_coverage": P.snapshot_coverage(inventory),
        "value_basis": P.value_basis(sales),
    }


def verified(intake: Intake, sales: DataFrame, inventory: DataFrame, purchases: DataFrame, expected=()) -> DataFrame:
    """Every source file of the run against the written facts; ``expected`` kinds that no file has fail too."""
    loaded = V.source_totals(sales, "sales").unionByName(V.source_totals(inventory, "inventory")).unionByName(V.source_totals(purchases, "purchase"))
    wanted = intake.files.sparkSession.createDataFrame([(k,) for k in expected], "source_type string")
    return V.tie_out_sources(intake.raw_totals, loaded, V.missing_sources(intake.files, wanted))


def settings(asof: dt.date, rules: dict, channel_map: dict, facility: str | None, tables: tuple[DataFrame, ...]) -> str:
    """What besides the input files decides a run's results, as one text; of tables their digest."""
    def hashable(t: DataFrame) -> DataFrame:
        return t.select(*[F.array_sort(F.map_entries(t[c])).alias(c) if kind.startswith("map<") else t[c] for c, kind in t.dtypes])

    digests = [[str(x) for x in row] for row in together(*[table_digest(hashable(t)).first for t in tables])]
    return json.dumps([facility, asof.isoformat(), rules, sorted(channel_map.items()), digests], sort_keys=True, default=str)


def dashboard(reports: dict[str, DataFrame]) -> DataFrame:
    """Payload of the eleven report tables, all columns of all rows but for the four lists that show their top only."""
    by = lambda c, *then: [F.desc_nulls_last(c), *then]
    return W.payload_rows({
        "summary": (reports["summary"], [], None),
        "channel": (P.channel_pivot(reports["channel"]), [], None),
        "store": (reports["stores"], [], None),
        "sku": (reports["sku_performance"], by("net_value_sell_out", "master_sku"), 40),
        "audit": (reports["load_audit"], [], None),
        "coverage": (reports["period_coverage"], [], None),
        "exceptions": (reports["exceptions"], by("value", "source_file", "external_id", "declared_id_type", "reason"), 25),
        "basis": (reports["value_basis"], [], None),
        "returns": (reports["returns"], [], None),
        "po_vendor": (reports["po_by_vendor"], by("pending", "vendor", "po_status"), 20),
        "po_sku": (reports["inbound_by_sku"], by("on_order", "master_sku"), 25),
    }, nulls=True)


def run_cycle(
    spark: SparkSession, facts: tuple[DataFrame, DataFrame, DataFrame], items: DataFrame,
    notes: tuple[DataFrame, DataFrame], out: str, run_id: str, asof: dt.date,
    previous_state: DataFrame | None = None, rules: dict = S.DEFAULT_RULES,
    period_days: int = S.PERIOD_DAYS, recent_days: int = S.RECENT_DAYS, facility: str | None = None, intake: Intake | None = None,
) -> dict[str, DataFrame]:
    """Write facts once, then build everything else from the written tables.

    The facts feed some twenty tables, the SKU table four; both are read back
    from storage, so no join is replayed and a lost executor costs a re-read.
    Readers see the run's tables once all of them are there.
    """
    W.write_facts(f"{out}/facts", *facts)
    sales, inventory, purchases = load_facts(spark, f"{out}/facts")
    write_all_reports(spark, report_set(sales, inventory, purchases, facility, intake), out)
    made = sku_tables(spark, (sales, inventory, purchases), items, notes, out, run_id, asof, previous_state, rules, period_days, recent_days)
    W.switch(spark, out, run_id)
    return made


def write_all_reports(spark: SparkSession, reports: dict[str, DataFrame], out: str) -> None:
    """The reports and the payload made of them."""
    written = W.write_reports(f"{out}/reports", reports)
    # The payload reads the written reports; one that was left out has no rows.
    stored = {
        n: spark.read.schema(W.flatten_headers(df).schema).parquet(f"{out}/reports/{n}") if n in written else df.limit(0) for n, df in reports.items()
    }
    W.write_reports(f"{out}/reports", {"dashboard": dashboard(stored)})


def sku_tables(
    spark: SparkSession, facts: tuple[DataFrame, DataFrame, DataFrame], items: DataFrame, notes: tuple[DataFrame, DataFrame], out: str, run_id: str,
    asof: dt.date, previous_state: DataFrame | None, rules: dict, period_days: int, recent_days: int,
) -> dict[str, DataFrame]:
    """SKU and style tables, action list and alerts, written under the run's id; readers see them after ``switch``."""
    sales, inventory, purchases = facts
    by_sku, by_style = notes
    sku_path = f"{out}/work/{run_id}/svs_sku"
    skus = M.svs_sku(sales, inventory, purchases, items, by_sku, by_style, asof, period_days, recent_days)
    skus.write.mode("overwrite").parquet(sku_path)
    skus = spark.read.schema(skus.schema).parquet(sku_path)
    start, _ = windows(asof, period_days, recent_days)

    def by_style_tables() -> DataFrame:
        article_path = f"{out}/work/{run_id}/svs_article"
        articles = M.svs_article(skus, by_style, asof, period_days, recent_days)
        articles.write.mode("overwrite").parquet(article_path)
        articles = spark.read.schema(articles.schema).parquet(article_path)
        together(
            lambda: W.publish(M.lay_out(articles, M.ARTICLE_LAYOUT, start, asof), out, "article_wise", run_id),
            lambda: W.publish(M.action_list(articles), out, "action_list", run_id),
        )
        return articles

    def alert_tables() -> tuple[DataFrame, DataFrame]:
        raised = A.evaluate(A.prepare(skus, rules.get("valuation", {}).get("fallback_to_asp", True)), rules)
        alert_path = f"{out}/work/{run_id}/alerts"
        raised.write.mode("overwrite").parquet(alert_path)
        raised = spark.read.schema(raised.schema).parquet(alert_path)
        diff = alert_diff(raised, previous_state if previous_state is not None else empty_state(spark), run_id)
        labelled = raised.join(diff.select("key", "status", "first_seen", "cycles"), "key")
        together(
            lambda: W.publish(diff, out, "alert_lifecycle", run_id),
            lambda: next_state(diff).write.mode("overwrite").parquet(f"{out}/alert_state/run_id={run_id}"),
            lambda: W.publish(A.alert_summary(labelled), out, "alert_summary", run_id),
            lambda: W.publish(A.top_alerts(labelled), out, "alert_digest", run_id),
        )
        return labelled, diff

    articles, (labelled, diff), _ = together(
        by_style_tables, alert_tables, lambda: W.publish(M.lay_out(skus, M.SKU_LAYOUT, start, asof), out, "sku_wise", run_id)
    )
    return {"skus": skus, "articles": articles, "alerts": labelled, "lifecycle": diff}


def run_folder(
    spark: SparkSession, root: str, out: str, lookup: DataFrame | None = None, items: DataFrame | None = None,
    notes: tuple[DataFrame, DataFrame] | None = None, run_id: str | None = None, asof: dt.date | None = None, facility: str | None = None, raw_cells: DataFrame | None = None, channel_map: dict = S.CHANNEL_MAP,
    previous_state: DataFrame | None = None, rules: dict = S.DEFAULT_RULES, force: bool = False,
) -> dict[str, DataFrame] | None:
    """From a folder of extracts to all published tables; None when nothing changed since the last good run.

    Nothing means: no input file, no rule, date, ledger or dimension table, and
    no table that a run writes is missing. Alerts continue from the state the
    last good run left in ``out``, unless ``previous_state`` is given.

    What is not given comes from the folder: decoded workbook cells from its
    Parquet folder ``raw_cells``, the master from one of those workbooks, the
    item master and the notes from their CSV files, list prices from warehouse
    stock. ``run_id`` is the time of the start, ``asof`` its day.

    A status row is written in every case, also for a run that fails, and runs
    beyond the newest ``S.RUNS_KEPT`` leave the archive.
    """
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    run_id, asof = run_id or started.strftime("%Y%m%d-%H%M%S-%f"), asof or started.date()
    if raw_cells is None and W.exists(spark, f"{root}/{RAW_CELLS}"):
        raw_cells = spark.read.parquet(f"{root}/{RAW_CELLS}")
    files = scan_inputs(spark, root).select("folder", "name", F.col("path").alias("file_id"), F.col("modified").cast("string").alias("version"), "bytes")
    # Master and item master of the folder are in raw_cells and the listing; the notes' file is in neither.
    own_notes = notes if notes is not None else load_notes(spark, root)
    given = tuple(t for t in (lookup, items, *own_notes, raw_cells) if t is not None)
    print_ = input_fingerprint(files, settings(asof, rules, channel_map, facility, given))
    seen = print_.first()

    def status(ok: bool, notes_: str = "", skipped: bool = False) -> None:
        took = (dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - started).total_seconds()
        W.write_status(spark, out, run_id, started, took, ok, seen["fingerprint"], seen["files"], notes_, skipped)

    last = W.read_status(spark, out)
    if not force and should_skip(print_, last, W.complete(spark, out)).first()["skip"]:
        status(True, "inputs unchanged", skipped=True)
        return None
    try:
        def extracts() -> Intake:
            master = R.load_master(master_sheet(raw_cells))[0] if lookup is None and raw_cells is not None else None
            return load_folder(spark, root, lookup, channel_map, facility, raw_cells, master=master)

        intake, own_items = together(extracts, lambda: items if items is not None else cut_lineage(load_items(spark, root), "items"))
        facts = (intake.sales, intake.inventory, intake.purchases)
        if previous_state is None:
            previous_state = W.last_state(spark, out, run_id, empty_state(spark))
        tables = run_cycle(spark, facts, own_items, own_notes, out, run_id, asof, previous_state, rules, facility=facility, intake=intake)
    except Exception as why:
        status(False, str(why)[:500])
        raise
    status(True)
    W.prune(spark, out, W.PUBLISHED)
    return tables
