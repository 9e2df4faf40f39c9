"""Pivoted store exports back to rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window, functions as F

from stockweave.functions.numbers import num

NOT_A_STORE = re.compile(r"grand\s*total|^total$|^unnamed", re.I)


def unpivot_matrix(df: DataFrame, id_column: str, measure: str = "qty_on_hand") -> DataFrame:
    """SKU rows x store columns to (external_id, location, measure); empty and zero cells go."""
    stores = [c for c in df.columns if c != id_column and not NOT_A_STORE.search(c)]
    typed = dict(df.dtypes)
    cells = [(num(f"`{c}`") if typed[c] == "string" else F.col(f"`{c}`").cast("double")).alias(c) for c in stores]
    wide = df.select(F.col(f"`{id_column}`").alias("external_id"), *cells)
    long = wide.unpivot(["external_id"], stores, "location", measure)
    return long.filter(F.coalesce(F.col(measure), F.lit(0.0)) != 0)


def block_columns(header: DataFrame, want: str = "sold qty") -> DataFrame:
    """Measure columns of a two-line header: (source_file, col_idx, location).

    ``header`` has one row per file with the cell arrays ``labels`` and
    ``measures``. The store label fills forward over its block; total labels
    do not open a block. The arrays hold one header line each.
    """
    usable = F.when(
        (F.trim("label") != "") & (F.lower(F.trim("label")) != "nan") & ~F.col("label").rlike("(?i)grand\\s*total|row labels"),
        F.trim("label"),
    )
    cells = header.select(
        "source_file",
        F.posexplode(F.arrays_zip("labels", "measures")).alias("col_idx", "cell"),
    ).select("source_file", "col_idx", F.coalesce("cell.labels", F.lit("")).alias("label"), F.col("cell.measures").alias("measure"))
    forward = Window.partitionBy("source_file").orderBy("col_idx").rowsBetween(Window.unboundedPreceding, 0)
    return (
        cells.withColumn("location", F.last(usable, ignorenulls=True).over(forward))
        .filter(F.col("location").isNotNull() & F.lower(F.trim("measure")).contains(want))
        .select("source_file", "col_idx", "location")
    )


def unpivot_blocks(body: DataFrame, columns: DataFrame) -> DataFrame:
    """Body rows (source_file, cells) to one row per store block with sales in it.

    ``columns`` is header-sized, one entry per store of a file, and is folded
    into one array per file so each body row is joined once and exploded.
    """
    per_file = columns.groupBy("source_file").agg(
        F.sort_array(F.collect_list(F.struct("col_idx", "location"))).alias("blocks")
    )
    long = body.join(per_file, "source_file").select(
        "source_file", F.get("cells", F.lit(0)).alias("external_id"), "cells", F.explode("blocks").alias("b")
    ).select("source_file", "external_id", "b.location", num(F.get("cells", F.col("b.col_idx"))).alias("qty_sold"))
    total = "(?i)grand\\s*total|^total$|^sum\\b"
    return long.filter(
        F.col("external_id").isNotNull() & ~F.col("external_id").rlike(total)
        & (F.coalesce(F.col("qty_sold"), F.lit(0.0)) != 0)
    )
