"""Master, item master, notes, facts and purchase-order files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockweave import schemas as S
from stockweave.functions.numbers import num
from stockweave.functions.text import clean_columns, fold_name, norm, pick_column
from stockweave.operators.dedup import keep_first


def read_csv_table(spark: SparkSession, path: str, row_order: str = "row_seq") -> DataFrame:
    """A CSV with one header line, all text, with a column that orders its rows."""
    raw = spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE").option("escape", '"').csv(path)
    return clean_columns(raw).withColumn(row_order, F.monotonically_increasing_id())


def load_item_master(raw: DataFrame, row_order: str = "row_seq") -> DataFrame:
    """SKU to category, gender, list price and product year; first row of a SKU wins."""
    def col(name):
        hit = pick_column(raw, name)
        return F.col(f"`{hit}`") if hit else F.lit(None).cast("string")

    rows = raw.select(
        norm(col("Product Code")).alias("master_sku"), col("Category Name").alias("Category"), col("Gender").alias("Gender"),
        num(col("MRP")).alias("MRP"), num(col("Year")).alias("_year"), F.col(row_order).alias("row_seq"),
    ).filter("master_sku is not null")
    return keep_first(rows, ["master_sku"], ["row_seq"]).drop("row_seq")


def newest_matching(files: DataFrame, pattern: str) -> DataFrame:
    """One row: the newest file whose name matches."""
    hits = files.filter(F.col("name").rlike(f"(?i){pattern}"))
    return hits.agg(F.max_by(F.struct("path", "name", "modified"), F.struct("modified", "name")).alias("f")).select("f.*")


def load_facts(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Published facts with their fixed schemas; nothing is inferred."""
    names = (("fact_sales", S.FACT_SALES), ("fact_inventory", S.FACT_INVENTORY), ("fact_purchase", S.FACT_PURCHASE))
    return tuple(spark.read.schema(schema).parquet(f"{root}/{name}").select(schema.names) for name, schema in names)


PO_KEYS = ("PO Code", "Item SkuCode")
PO_HISTORY_NAME = "Purchase_Orders_history.csv"


def alias_headers(df: DataFrame) -> DataFrame:
    """Known header spellings to the canonical ones, unless the real one is there too; keys trimmed."""
    taken, rename = set(df.columns), {}
    for column in df.columns:
        target = S.PO_HEADER_ALIASES.get(fold_name(column))
        if target and target not in taken:
            rename[column] = target
            taken.add(target)
    out = df.withColumnsRenamed(rename) if rename else df
    return out.withColumns({k: F.trim(F.col(f"`{k}`")) for k in PO_KEYS if k in out.columns})


def looks_like_po(df: DataFrame) -> bool:
    return set(PO_KEYS) <= set(alias_headers(df).columns)


def discover_po_files(files: DataFrame) -> DataFrame:
    """Purchase-order files by name, or by carrying both key columns; never the history itself.

    ``files``: name, header (cells of the header line).
    """
    by_name = F.col("name").rlike("(?i)purchase[\\s_\\-]*orders?")
    folded = F.transform("header", lambda h: F.regexp_replace(F.lower(h), "[^a-z0-9]+", ""))

    def carries(key: str):
        spellings = [s for s, target in S.PO_HEADER_ALIASES.items() if target == key]
        return F.arrays_overlap(folded, F.array(*[F.lit(s) for s in spellings]))

    by_shape = F.coalesce(carries(PO_KEYS[0]) & carries(PO_KEYS[1]), F.lit(False))
    return files.filter((by_name | by_shape) & (F.col("name") != PO_HISTORY_NAME)).withColumn(
        "found_by", F.when(by_name, "name").otherwise("columns")
    )
