"""Keyed state between runs: PO history upsert and alert NEW / ONGOING / RESOLVED."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stockweave.operators.dedup import keep_last


def merge_history(
    history: DataFrame | None, slices: DataFrame, keys: Sequence[str], newest_by: Sequence[str], arrival: Sequence[str] = ()
) -> DataFrame:
    """History plus new slices, newest version of each key.

    ``newest_by`` ranks versions. Of equally new ones a slice beats the
    history, and the slice row that came later (``arrival``: file, then row)
    beats an earlier one. Rows with a null key are dropped.
    """
    late = "_late"
    rows = slices.withColumn(late, F.lit(1))
    if history is not None:
        rows = history.withColumn(late, F.lit(0)).unionByName(rows, allowMissingColumns=True)
    present = " and ".join(f"`{k}` is not null" for k in keys)
    return keep_last(rows.filter(present), keys, [*newest_by, late, *arrival]).drop(late)


def merge_counts(history: DataFrame, merged: DataFrame) -> DataFrame:
    before = history.agg(F.count(F.lit(1)).alias("before"))
    after = merged.agg(F.count(F.lit(1)).alias("after"))
    return before.crossJoin(F.broadcast(after)).withColumn("added", F.col("after") - F.col("before"))  # 1 x 1 row


STATE = ("key", "alert", "sku", "label", "item", "first_seen", "cycles", "priority")


def alert_diff(current: DataFrame, previous: DataFrame, run_id: str) -> DataFrame:
    """Current and previous alerts side by side with a status for every key.

    One full outer join on the alert key: present in both is ONGOING, only now
    is NEW, only before is RESOLVED.
    """
    now = current.select("key", "alert", "sku", "label", "item", "priority")
    was = previous.select(
        "key", *[F.col(c).alias(f"was_{c}") for c in ("alert", "sku", "label", "item", "first_seen", "cycles", "priority")]
    )
    both = now.withColumn("_now", F.lit(True)).join(was.withColumn("_was", F.lit(True)), "key", "full_outer")
    status = F.when(F.col("_now") & F.col("_was"), "ONGOING").when(F.col("_now"), "NEW").otherwise("RESOLVED")
    cycles = (
        F.when(status == "ONGOING", F.col("was_cycles") + 1).when(status == "NEW", F.lit(1)).otherwise(F.col("was_cycles"))
    )
    return both.select(
        "key",
        *[F.coalesce(c, f"was_{c}").alias(c) for c in ("alert", "sku", "label", "item")],
        status.alias("status"),
        F.coalesce("was_first_seen", F.lit(run_id)).alias("first_seen"),
        cycles.cast("long").alias("cycles"),
        F.coalesce("priority", "was_priority").alias("priority"),
    )


def next_state(diff: DataFrame) -> DataFrame:
    """What the next run compares with: the open keys only."""
    return diff.filter("status <> 'RESOLVED'").select(*STATE)


def resolved(diff: DataFrame) -> DataFrame:
    return diff.filter("status = 'RESOLVED'")


def empty_state(spark) -> DataFrame:
    return spark.createDataFrame(
        [], "key string, alert string, sku string, label string, item string, first_seen string, cycles long, priority double"
    )


def retired(previous: DataFrame, current: DataFrame, protected: str) -> DataFrame:
    """Files of the previous pull that this one no longer lists; the history file never is."""
    return previous.join(current.select("file_id"), "file_id", "left_anti").filter(F.col("name") != protected)
