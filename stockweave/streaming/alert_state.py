"""Alert lifecycle over a stream of runs.

A micro-batch holds the open alerts of one or more runs, told apart by
``run_id``. Its runs are classified in order, each against the state after the
run before it. The state after batch n is stored below n and is always derived
from the state after n - 1, so a replayed batch gives the same states again and
never counts an extra cycle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockweave.operators.lifecycle import STATE, alert_diff, empty_state, next_state


def state_after(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    if batch_id < 0:
        return empty_state(spark)
    return spark.read.schema(empty_state(spark).schema).parquet(f"{root}/state/batch={batch_id}").select(*STATE)


def advance(alerts: DataFrame, batch_id: int, root: str) -> None:
    """Classify the runs of a batch one after the other; store each outcome and the state after the last.

    Without a column ``run_id`` the batch is one run, which may have no alerts.
    The loop goes over the runs that wait, a handful whatever their size.
    """
    spark = alerts.sparkSession
    state = state_after(spark, root, batch_id - 1)
    if "run_id" in alerts.columns:
        runs = [r[0] for r in alerts.select("run_id").distinct().orderBy("run_id").collect()]
    else:
        runs, alerts = [f"run-{batch_id}"], alerts.withColumn("run_id", F.lit(f"run-{batch_id}"))
    for run in runs:
        diff = alert_diff(alerts.filter(F.col("run_id") == run).drop("run_id"), state, run)
        outcome = f"{root}/outcome/batch={batch_id}/run={run}"
        diff.write.mode("overwrite").parquet(outcome)
        state = next_state(spark.read.schema(diff.schema).parquet(outcome))
    state.write.mode("overwrite").parquet(f"{root}/state/batch={batch_id}")


def run_alerts(stream: DataFrame, root: str, checkpoint: str) -> None:
    """``stream``: run_id, key, alert, sku, label, item, priority; several runs may wait before one trigger."""
    (
        stream.writeStream.foreachBatch(lambda df, n: advance(df, n, root))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    )
