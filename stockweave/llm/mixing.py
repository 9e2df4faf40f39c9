"""Mixing sources to target weights by weighted fair queueing.

The documents of each source are shuffled by a hash; a document's virtual
finish time is the source's words up to and including it, divided by the
source's target. Documents are taken in order of finish time over all sources
until the budget is spent. A source whose target exceeds its size is queued
again, up to ``max_repeats`` times. DataFrame functions only.

Defined cases: null and empty texts have 0 words and are taken with 0 words;
null is a source, ordered last; equal rows are interchangeable; documents with
equal finish times are taken together; a source larger than every budget slice
is numbered in slices; an empty table gives an empty result. Columns of the
input that carry result names do not clash: work columns start with ``__``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stockweave.llm import common as C

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix-1"


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Add ``__target`` to one row per source (``__source``, ``__source_size``).

    Sources by code point, null last, weigh ``weights`` in turn. Shares above
    ``max_repeats`` times a source's size stop there and the rest is shared
    anew. In order of cap / weight the capped sources come first, so running
    sums over the sources (one row each) give the fixed point without a loop.
    """
    by_name = Window.orderBy(F.col("__source").isNull(), "__source")
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int")).cast("long")
    rows = sizes.withColumn("__weight", weight).withColumn("__cap", F.col("__source_size") * F.lit(max_repeats))
    order = [F.col("__cap") / F.col("__weight"), F.col("__source").isNull(), F.col("__source")]
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    free = F.sum("__source_size").over(everything) - F.coalesce(F.sum("__cap").over(earlier), F.lit(0))
    rows = rows.withColumn("__capped", F.col("__cap") * F.sum("__weight").over(rest) <= free * F.col("__weight"))
    left = F.sum("__source_size").over(everything) - F.sum(F.when(F.col("__capped"), F.col("__cap")).otherwise(0)).over(everything)
    open_weight = F.sum(F.when(F.col("__capped"), 0).otherwise(F.col("__weight"))).over(everything)
    share = (F.col("__weight") * left).cast("double") / open_weight.cast("double")
    return rows.withColumn("__target", F.when(F.col("__capped"), F.col("__cap").cast("double")).otherwise(share)).select(
        "__source", "__source_size", "__target"
    )


def _queued(rows: DataFrame, catalog: DataFrame, starts: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Rows with their source's figures and ``__upto``, the source's words up to and including the row."""
    known = catalog.select("__key", "__source_size", "__target", "__slices")
    sliced = rows.join(known, "__key").withColumn("__slice", F.floor(F.col("__at") * F.col("__slices"))).drop("__slices")
    starts = starts if starts is not None else C.staged(C.slice_starts(sliced, "__key", F.col("__size")), "mix-starts")
    order = ["__shuffle", "__size"]
    return C.running(sliced, starts, "__key", order, F.col("__size"), "__upto"), starts


def _prepared(docs: DataFrame, key: str, text: str, source: str, seed: str) -> DataFrame:
    """Work columns: size, a non-null source key, and the hash that shuffles."""
    named = F.col(source).cast("string")
    return (
        docs.withColumn("__size", C.word_count(F.col(text)))
        .withColumn("__key", F.when(named.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), named)))
        .withColumn("__shuffle", F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(key).cast("string"), F.lit("")))))
        .withColumn("__at", F.conv(F.substring("__shuffle", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32)))
    )


def _finish(turn: int | Column) -> Column:
    turn = F.lit(turn) if isinstance(turn, int) else turn
    return (turn * F.col("__source_size") + F.col("__upto")).cast("double") / F.col("__target")


def _cut(queued: DataFrame, budget: int, max_repeats: int) -> float:
    """The largest finish time at which the copies finished by then hold at most ``budget`` words.

    Finish times are cut into ranges of about equal words; range sums give the
    range that holds the cut, and only that range is looked into.
    """
    copies = (
        queued.filter("__target > 0 and __size > 0")
        .select("__size", F.explode(F.array(*[_finish(k) for k in range(max_repeats)])).alias("__finish"))
        .filter("__finish <= 2")
    )
    ranges = max(1, -(-queued.count() // C.SLICE_ROWS)) * 2
    ranged = copies.withColumn("__range", F.floor(F.col("__finish") * F.lit(ranges)))
    sums = ranged.groupBy("__range").agg(F.sum("__size").alias("__sum"))
    upto = F.sum("__sum").over(Window.orderBy("__range"))
    over = sums.withColumn("__upto", upto).filter(F.col("__upto") > F.lit(budget)).orderBy("__range").first()
    if over is None:
        return 2.0
    before = over["__upto"] - over["__sum"]
    inside = ranged.filter(F.col("__range") == over["__range"]).groupBy("__finish").agg(F.sum("__size").alias("__sum"))
    inside = inside.withColumn("__upto", F.lit(before) + F.sum("__sum").over(Window.orderBy("__finish")))
    last = inside.filter(F.col("__upto") <= F.lit(budget)).agg(F.max("__finish")).first()[0]
    return last if last is not None else over["__range"] / ranges


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED,
    key: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """``docs`` with ``__size``, ``__source_size``, ``__target`` and ``__copies``, how often the mix takes the row.

    Plans on a narrow table (key hash, source, size); the wide rows are
    shuffled once, by source slice.
    """
    wide = _prepared(docs, key, text, source, seed)
    narrow = C.staged(wide.select("__key", "__size", "__shuffle", "__at"), "mix-rows")
    sizes = narrow.groupBy("__key").agg(
        F.sum("__size").alias("__source_size"), F.ceil(F.count(F.lit(1)) / F.lit(C.SLICE_ROWS)).alias("__slices")
    )
    sizes = sizes.withColumn("__source", F.when(F.col("__key") != "-", F.expr("substring(__key, 2)")))
    named = C.staged(sizes, "mix-sources")
    catalog = C.staged(
        targets(named.select("__source", "__source_size"), weights, max_repeats).join(
            named.select(F.col("__source").alias("__s"), "__key", "__slices"), F.col("__source").eqNullSafe(F.col("__s"))
        ).drop("__s", "__source"),
        "mix-targets",
    )
    queued, starts = _queued(narrow, catalog, None)
    queued = C.staged(queued.select("__size", "__source_size", "__target", "__upto"), "mix-queue")
    budget = catalog.agg(F.coalesce(F.sum("__source_size"), F.lit(0))).first()[0]
    cut = _cut(queued, budget, max_repeats)
    served, _ = _queued(wide, catalog, starts)
    taken = sum(((_finish(k) <= F.lit(cut)).cast("int") for k in range(max_repeats)), F.lit(0))
    return served.withColumn("__copies", F.when(F.col("__target") > 0, taken).otherwise(F.lit(0))).drop("__key", "__shuffle", "__at", "__slice", "__upto")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each taken document as often as it is taken, with the columns of ``docs``."""
    rows = mix(docs, **options).filter("__copies > 0")
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)


def report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target (of its source), taken (words, repeats counted)."""
    key, text, source = options.get("key", "doc_id"), options.get("text", "text"), options.get("source", "source")
    return mix(docs.select(key, text, source), **options).select(
        F.col(key).alias("doc_id"),
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__copies") * F.col("__size")).cast("long").alias("taken"),
    )
