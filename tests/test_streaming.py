"""Streams give the batch answer, and replaying a batch changes nothing."""

import datetime as dt

from stockweave.streaming import alert_state as SA
from stockweave.streaming import po_history as SH

KEYS, ORDER = ["po", "sku"], ["updated", "qty"]
SCHEMA = "po string, sku string, qty int, updated timestamp"


def slices(spark, root, n, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{root}/in/slice={n}")


def when(day):
    return dt.datetime(2026, 1, day)


def test_history_accumulates_late_data_and_replays(spark, tmp_path):
    root = str(tmp_path)

    def run():
        SH.run_slices(spark.readStream.schema(SCHEMA).parquet(f"{root}/in").drop("slice"), f"{root}/log", f"{root}/cp", KEYS, ORDER)
        return {(r.po, r.sku): r.qty for r in SH.read_history(spark, f"{root}/log", KEYS, ORDER).collect()}

    slices(spark, root, 1, [("P1", "S1", 5, when(9)), ("P2", "S1", 1, when(1)), (None, "S1", 1, when(1))])
    assert run() == {("P1", "S1"): 5, ("P2", "S1"): 1}
    slices(spark, root, 2, [("P1", "S1", 3, when(2)), ("P2", "S1", 8, when(3))])  # the first one is late
    assert run() == {("P1", "S1"): 5, ("P2", "S1"): 8}
    assert run() == {("P1", "S1"): 5, ("P2", "S1"): 8}  # nothing new arrived
    again = spark.createDataFrame([("P1", "S1", 3, when(2)), ("P2", "S1", 8, when(3))], SCHEMA)
    SH.fold_batch(again, 1, f"{root}/log", KEYS, ORDER)
    assert {r.qty for r in SH.read_history(spark, f"{root}/log", KEYS, ORDER).collect()} == {5, 8}
    assert SH.compact(spark, f"{root}/log", f"{root}/base", KEYS, ORDER).count() == 2


def test_live_newest_matches_batch(spark, tmp_path):
    root = str(tmp_path)
    slices(spark, root, 1, [("P1", "S1", 5, when(9)), ("P1", "S1", 7, when(10)), ("P2", "S1", 1, when(1))])
    stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in").drop("slice")
    q = SH.live_newest(stream, KEYS, ORDER).writeStream.format("memory").queryName("live").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.po, r.qty) for r in spark.sql("select * from live").collect()} == {("P1", 7), ("P2", 1)}


def alerts(spark, *keys):
    rows = [(f"a|{k}", "a", k, "A", "", 1.0) for k in keys]
    return spark.createDataFrame(rows, "key string, alert string, sku string, label string, item string, priority double")


def test_alert_state_replay_adds_no_cycle(spark, tmp_path):
    root = str(tmp_path)

    def outcome(n):
        return {r.sku: (r.status, r.cycles) for r in spark.read.parquet(f"{root}/outcome/batch={n}").collect()}

    SA.advance(alerts(spark, "1", "2"), 0, root)
    SA.advance(alerts(spark, "2", "3"), 1, root)
    assert outcome(1) == {"1": ("RESOLVED", 1), "2": ("ONGOING", 2), "3": ("NEW", 1)}
    SA.advance(alerts(spark, "2", "3"), 1, root)  # replay
    assert outcome(1) == {"1": ("RESOLVED", 1), "2": ("ONGOING", 2), "3": ("NEW", 1)}
    SA.advance(alerts(spark), 2, root)
    assert outcome(2) == {"2": ("RESOLVED", 2), "3": ("RESOLVED", 1)}
    SA.advance(alerts(spark, "2"), 3, root)
    assert outcome(3) == {"2": ("NEW", 1)}
