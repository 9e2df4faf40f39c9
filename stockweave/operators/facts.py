"""Row-level fact operators: ledger map, facility scope, value basis, conform."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from stockweave import schemas as S
from stockweave.functions.text import norm_id
from stockweave.operators.dedup import top_per_group


def channel_table(spark: SparkSession, channel_map: dict = S.CHANNEL_MAP) -> DataFrame:
    rows = ", ".join(
        "struct(" + ", ".join("'" + part.replace("\\", "\\\\").replace("'", "\\'") + "'" for part in (k.strip().upper(), *v)) + ")"
        for k, v in channel_map.items()
    )
    return spark.range(1).selectExpr(f"inline(array({rows})) as (_ledger_key, _channel, _type, _flow)")


def map_ledger(df: DataFrame, channel_map: dict = S.CHANNEL_MAP, ledger: str = "ledger") -> DataFrame:
    """Ledger to channel, type and flow; an unlisted ledger keeps its name, flow unknown."""
    table = channel_table(df.sparkSession, channel_map)
    joined = df.join(table, F.upper(F.trim(F.col(ledger))) == F.col("_ledger_key"), "left")
    return (
        joined.withColumn("channel", F.coalesce("_channel", F.trim(ledger)))
        .withColumn("channel_type", F.coalesce("_type", F.lit("unknown")))
        .withColumn("flow", F.coalesce("_flow", F.lit("unknown")))
        .drop("_ledger_key", "_channel", "_type", "_flow", ledger)
    )


def in_scope(facility_column: str, facility: str) -> Column:
    return norm_id(facility_column).eqNullSafe(F.lit(facility.upper())) | F.col(facility_column).isNull()


def facility_rows(df: DataFrame, facility_column: str, facility: str) -> DataFrame:
    """Rows of one facility; rows without a facility stay."""
    return df.filter(in_scope(facility_column, facility))


def facility_drops(
    df: DataFrame, facility_column: str, facility: str, list_at_most: int = 6
) -> DataFrame:
    """Per file: how many rows the scope drops, and the first few foreign facilities."""
    foreign = (
        df.filter(~in_scope(facility_column, facility))
        .groupBy("source_file", norm_id(facility_column).alias("other"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    named = top_per_group(
        foreign.filter("other is not null"), "source_file", [F.col("other")], list_at_most
    ).groupBy("source_file").agg(
        F.array_join(F.sort_array(F.collect_list("other")), ", ").alias("facilities_found")
    )
    totals = foreign.groupBy("source_file").agg(F.sum("n").alias("rows_dropped"))
    return totals.join(named, "source_file", "left").withColumn("scope", F.lit(facility))


def value_basis(df: DataFrame, list_price: str = "mrp") -> DataFrame:
    """Fill a missing net value: from gross, else units times list price; label which."""
    blank = F.coalesce(F.col("net_value"), F.lit(0.0)) == 0
    use_gross = blank & (F.coalesce(F.col("gross_value"), F.lit(0.0)) != 0)
    impute = blank & ~use_gross & F.col(list_price).isNotNull() & F.col("qty_sold").isNotNull()
    label = (
        F.when(use_gross, "gross_fallback").when(impute, "imputed_mrp").otherwise("as_reported")
    )
    net = (
        F.when(use_gross, F.col("gross_value"))
        .when(impute, F.col("qty_sold") * F.col(list_price))
        .otherwise(F.col("net_value"))
    )
    return df.withColumns({"value_basis": label, "net_value": net}).drop(list_price)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exact projection to a fact schema; absent columns are null."""
    have = dict(df.dtypes)
    kinds = {f.name: f.dataType.simpleString() for f in schema}
    return df.selectExpr(*[
        f"`{name}`" if have.get(name) == kind else f"cast({f'`{name}`' if name in have else 'null'} as {kind}) as `{name}`"
        for name, kind in kinds.items()
    ])


def union_all(frames: list[DataFrame], schema: T.StructType) -> DataFrame:
    """Adapter outputs of one fact as one table."""
    out = conform(frames[0], schema)
    for frame in frames[1:]:
        out = out.unionByName(conform(frame, schema))
    return out


def mapped(sales: DataFrame) -> DataFrame:
    """The base of every sales report: resolved to a SKU and in a real flow."""
    return sales.filter(F.col("master_sku").isNotNull() & F.col("flow").isin("sell_in", "sell_out"))


def drop_total_rows(df: DataFrame, key: str) -> DataFrame:
    """Pivot exports carry total lines that would count everything twice."""
    total = "(?i)grand\\s*total|^total$|^sum\\b"
    return df.filter(F.col(key).isNotNull() & ~F.col(key).cast("string").rlike(total))
