"""Writers: facts, report sets, run-partitioned publishing, status rows."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stockweave import schemas as S
from stockweave.functions.text import flatten_headers
from stockweave.session import together

# Report name -> written only when it has rows.
REPORTS = {
    "summary": False, "channel": False, "stores": False, "sku_performance": False, "inventory": False,
    "po_by_vendor": True, "inbound_by_sku": True, "open_po_lines": True, "returns": False, "exceptions": False,
    "load_audit": False, "period_coverage": False, "snapshot_coverage": False, "value_basis": False,
    "skipped_files": True, "superseded_files": True, "facility_filter": True, "rejects": True, "tie_out_sources": True,
}
#: Tables of a run that are kept as latest copy and by run.
PUBLISHED = ("sku_wise", "article_wise", "action_list", "alert_lifecycle", "alert_summary", "alert_digest")


def write_facts(root: str, sales: DataFrame, inventory: DataFrame, purchases: DataFrame) -> None:
    """Full overwrite of the three facts; sales split by flow, so a flow is one folder to read."""
    together(
        lambda: sales.write.mode("overwrite").partitionBy("flow").parquet(f"{root}/fact_sales"),
        lambda: inventory.write.mode("overwrite").parquet(f"{root}/fact_inventory"),
        lambda: purchases.write.mode("overwrite").parquet(f"{root}/fact_purchase"),
    )


def write_reports(root: str, reports: dict[str, DataFrame]) -> list[str]:
    """One folder per report; reports that only matter with rows are left out when empty."""
    def write(name: str, df: DataFrame) -> bool:
        path, optional = f"{root}/{name}", REPORTS.get(name, False)
        flatten_headers(df).write.mode("overwrite").parquet(path)
        # Computed once: an optional report without rows is dropped after it was written.
        if optional and df.sparkSession.read.schema(flatten_headers(df).schema).parquet(path).isEmpty():
            files, place = _folder(df.sparkSession, path)
            files.delete(place, True)
            return False
        return True

    kept = together(*[partial(write, name, df) for name, df in reports.items()])
    return [name for name, there in zip(reports, kept) if there]


def publish(df: DataFrame, root: str, name: str, run_id: str) -> None:
    """One stamped copy per run, computed once; readers see it after ``switch``. Re-publishing a run replaces it."""
    flatten_headers(df).write.mode("overwrite").parquet(f"{root}/archive/{name}/run_id={run_id}")


VERSION = "name string, run_id string"


def switch(spark: SparkSession, root: str, run_id: str, names=PUBLISHED) -> int:
    """Let readers see a run's tables, all at once; the number of the version.

    A version is a new folder of one row per table, and it counts once its
    ``_SUCCESS`` is there, so a job that dies before leaves readers the version
    they had. The plain copies under ``latest`` are made afterwards.
    """
    places = {n: f"{root}/archive/{n}/run_id={run_id}" for n in names}
    absent = [n for n, place in places.items() if not exists(spark, f"{place}/_SUCCESS")]
    if absent:
        raise ValueError(f"run {run_id} has not written {', '.join(absent)}")
    number = max(versions(spark, root), default=0) + 1
    manifest = spark.createDataFrame([(n, run_id) for n in names], VERSION)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{root}/versions/version={number}")
    together(*[
        lambda n=n, place=place: spark.read.parquet(place).write.mode("overwrite").parquet(f"{root}/latest/{n}") for n, place in places.items()
    ])
    return number


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions, one small folder each."""
    files, place = _folder(spark, f"{root}/versions")
    found = [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []
    return sorted(int(n.split("=")[1]) for n in found if n.startswith("version=") and exists(spark, f"{root}/versions/{n}/_SUCCESS"))


def published_runs(spark: SparkSession, root: str, version: int | None = None) -> dict[str, str]:
    """Table -> run of a version, the newest unless told; empty before the first."""
    known = versions(spark, root)
    if not known:
        return {}
    at = known[-1] if version is None else version
    return {r.name: r.run_id for r in spark.read.schema(VERSION).parquet(f"{root}/versions/version={at}").collect()}  # one row per table


def read_published(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A table as the newest (or a given) version shows it."""
    runs = published_runs(spark, root, version)
    if name not in runs:
        raise ValueError(f"{name} has not been published below {root}")
    return spark.read.parquet(f"{root}/archive/{name}/run_id={runs[name]}")


def latest_runs(df: DataFrame, run_column: str = "run_id", keep: int = S.RUNS_KEPT) -> DataFrame:
    """Rows of the newest runs. The runs are ranked on their distinct ids only."""
    runs = df.select(run_column).distinct().orderBy(F.desc(run_column)).limit(keep)
    return df.join(F.broadcast(runs), run_column, "left_semi")  # ``keep`` rows


def prunable_runs(df: DataFrame, run_column: str = "run_id", keep: int = S.RUNS_KEPT) -> DataFrame:
    """Run ids older than the newest ``keep``."""
    runs = df.select(run_column).distinct()
    newest = runs.orderBy(F.desc(run_column)).limit(keep)
    return runs.join(F.broadcast(newest), run_column, "left_anti")  # ``keep`` rows


def payload_rows(tables: dict[str, tuple[DataFrame, list, int | None]], nulls: bool = False) -> DataFrame:
    """Dashboard payload as (table, position, json): name -> (rows, order, how many).

    One JSON text per report row keeps the payload a table, however long it is.
    ``nulls``: whether columns without a value stand in it too.
    """
    parts = []
    for name, (df, order, n) in tables.items():
        top = df.orderBy(*order).limit(n) if n else df
        numbered = top.withColumn("position", F.row_number().over(Window.orderBy(*order))) if n else top.withColumn("position", F.lit(None).cast("int"))
        parts.append(numbered.select(F.lit(name).alias("table"), "position", F.to_json(F.struct(*df.columns), {"ignoreNullFields": str(not nulls).lower()}).alias("json")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


STATUS = "run_id string, started timestamp, seconds double, verdict string, ok boolean, fingerprint string, files long, notes string"


def write_status(
    spark: SparkSession, root: str, run_id: str, started, seconds: float, ok: bool, fingerprint: str,
    files: int, notes: str = "", skipped: bool = False,
) -> None:
    """One row per run; writing a run again replaces its row."""
    verdict = "SKIPPED" if skipped else "OK" if ok else "FAILED"
    row = spark.createDataFrame([(run_id, started, float(seconds), verdict, ok, fingerprint, files, notes)], STATUS)
    row.write.mode("overwrite").parquet(f"{root}/run_status/run={run_id}")


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _folder(spark, path)
    return files.exists(place)


def complete(spark: SparkSession, root: str) -> bool:
    """Whether every table that a run always writes is there."""
    wanted = [f"latest/{n}" for n in PUBLISHED] + [f"reports/{n}" for n, optional in REPORTS.items() if not optional] + ["reports/dashboard"]
    return all(exists(spark, f"{root}/{place}/_SUCCESS") for place in wanted)


def last_state(spark: SparkSession, root: str, run_id: str, empty: DataFrame) -> DataFrame:
    """The alert state that the last good run before this one left; ``empty`` before the first."""
    good = read_status(spark, root).filter((F.col("verdict") == "OK") & (F.col("run_id") != run_id))
    last = good.agg(F.max_by("run_id", F.struct("started", "run_id"))).first()[0]
    path = f"{root}/alert_state/run_id={last}"
    return spark.read.schema(empty.schema).parquet(path) if last is not None and exists(spark, path) else empty


def read_status(spark: SparkSession, root: str) -> DataFrame:
    """All status rows; none before the first run."""
    if not exists(spark, f"{root}/run_status"):
        return spark.createDataFrame([], STATUS)
    return spark.read.schema(STATUS).option("recursiveFileLookup", True).parquet(f"{root}/run_status")


def prune(spark: SparkSession, root: str, names, keep: int = S.RUNS_KEPT) -> list[str]:
    """Remove archived copies of runs beyond the newest ``keep``, but not what the newest version shows; folders are read, no rows.

    Versions that show a removed run go too.
    """
    removed, shown = [], set(published_runs(spark, root).values())
    for name, under in [*((n, f"archive/{n}") for n in names), ("alert_state", "alert_state")]:
        files, place = _folder(spark, f"{root}/{under}")
        if not files.exists(place):
            continue
        runs = sorted(s.getPath().getName() for s in files.listStatus(place) if s.getPath().getName().startswith("run_id="))
        for run in runs[:-keep]:
            if run.removeprefix("run_id=") in shown:
                continue
            files.delete(_folder(spark, f"{root}/{under}/{run}")[1], True)
            removed.append(f"{name}/{run}")
    gone = {r.split("/run_id=")[1] for r in removed}
    for number in versions(spark, root)[:-1]:
        if gone & set(published_runs(spark, root, number).values()):
            files, place = _folder(spark, f"{root}/versions/version={number}")
            files.delete(place, True)
    return removed
