"""Helpers the operators share: tables, staging in the shared folder, numbering without one task per group."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stockweave.session import work_dir

#: Fixed by the result contracts: a word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of one slice of a group; a window never sees more of a group than about this.
SLICE_ROWS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_COLLECTING: list[list[str]] = []


@contextmanager
def collected() -> Iterator[list[str]]:
    """The paths staged meanwhile, in order, for ``discard``."""
    _COLLECTING.append(made := [])
    try:
        yield made
    finally:
        _COLLECTING.pop()


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables that no later step reads."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the folder all executors share and read back: computed once, and a lost executor costs a re-read."""
    path = work_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    for made in _COLLECTING:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(step):
    """A mapInArrow step that gives freed memory back when its task ends, as the Python worker lives on for other stages."""

    def run(batches):
        import ctypes
        import gc

        import pyarrow

        try:
            yield from step(batches)
        finally:
            gc.collect()
            pyarrow.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_of(text: Column) -> Column:
    """The words of a text as an array; none of a null text."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit(bits: Column) -> Column:
    """A 64-bit hash as a fraction in [0, 1)."""
    return F.shiftrightunsigned(bits, 11).cast("double") / F.lit(float(1 << 53))


def slices(rows: DataFrame, group: str, fraction: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Add ``__slice``: ranges of ``fraction`` that cut each group into about ``slice_rows`` rows.

    A group with a third of all rows gets a third of all slices, so no task
    holds a group. ``group`` must not be null.
    """
    sizes = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / F.lit(slice_rows)).alias("__slices"))
    return rows.join(sizes, group).withColumn("__slice", F.floor(F.col(fraction) * F.col("__slices"))).drop("__slices")


def slice_starts(sliced: DataFrame, group: str, measure: Column) -> DataFrame:
    """For each slice, the sum of ``measure`` over the earlier slices of its group."""
    sums = sliced.groupBy(group, "__slice").agg(F.sum(measure).alias("__sum"))
    before = Window.partitionBy(group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(group, "__slice", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))


def running(sliced: DataFrame, starts: DataFrame, group: str, order: list, measure: Column, name: str) -> DataFrame:
    """Add the running sum of ``measure`` within each group, this row included."""
    within = Window.partitionBy(group, "__slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        sliced.withColumn("__within", F.sum(measure).over(within))
        .join(starts, [group, "__slice"])
        .withColumn(name, (F.col("__start") + F.col("__within")).cast("long"))
        .drop("__within", "__start")
    )


def repeated(rows: DataFrame, copies: str, nth: str) -> DataFrame:
    """Each row ``copies`` times, numbered from 0 as ``nth``.

    A row makes blocks of ``SLICE_ROWS`` copies; the further blocks of long runs
    are dealt over all tasks, so none writes out a run alone.
    """
    spark, last = rows.sparkSession, F.floor((F.col(copies) - 1) / F.lit(SLICE_ROWS))
    rows = staged(rows, "repeated")

    def block(of: DataFrame) -> DataFrame:
        first = F.col("__block") * F.lit(SLICE_ROWS)
        places = F.sequence(first, F.least(first + F.lit(SLICE_ROWS), F.col(copies)) - F.lit(1))
        return of.withColumn(nth, F.explode(places)).drop("__block")

    first = block(rows.withColumn("__block", F.lit(0).cast("long")))
    long = rows.filter(last > 0).withColumn("__block", F.explode(F.sequence(F.lit(1).cast("long"), last)))
    return first.unionByName(block(long.repartition(partitions(spark))))
