"""Purchase-order history from a stream of slices.

Each micro-batch is reduced to its newest version per key and written below
its own batch id, so replaying a batch after a failure rewrites the same files
and changes nothing. Reading folds all batches with the same newest-wins rule
the batch form uses: of equally new versions the one of the later batch wins,
and within a batch the one that ``arrival`` ranks last. A batch costs what the
batch holds, not what the history holds; ``compact`` folds the batches when
there are many.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockweave.operators.lifecycle import merge_history


def fold_batch(
    batch: DataFrame, batch_id: int, root: str, keys: Sequence[str], newest_by: Sequence[str], arrival: Sequence[str] = ()
) -> None:
    merge_history(None, batch, keys, newest_by, arrival).write.mode("overwrite").parquet(f"{root}/batch={batch_id}")


def run_slices(
    stream: DataFrame, root: str, checkpoint: str, keys: Sequence[str], newest_by: Sequence[str], arrival: Sequence[str] = ()
) -> None:
    """Absorb every slice that has arrived, then stop; the checkpoint remembers them."""
    (
        stream.writeStream.foreachBatch(lambda df, n: fold_batch(df, n, root, keys, newest_by, arrival))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    )


def read_history(
    spark: SparkSession, root: str, keys: Sequence[str], newest_by: Sequence[str], seed: DataFrame | None = None
) -> DataFrame:
    slices = spark.read.option("basePath", root).parquet(root)
    return merge_history(seed, slices, keys, newest_by, ["batch"]).drop("batch")


def compact(spark: SparkSession, root: str, into: str, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """Fold all batches into one new table; readers move over once it is complete."""
    read_history(spark, root, keys, newest_by).write.mode("errorifexists").parquet(into)
    return spark.read.parquet(into)


def live_newest(stream: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """Newest version per key as a running aggregate (update or complete output mode)."""
    payload = [c for c in stream.columns if c not in keys]
    newest = F.max_by(F.struct(*payload), F.struct(*newest_by)).alias("v")
    return stream.groupBy(*keys).agg(newest).select(*keys, "v.*")
