"""Document fingerprints from improbable features.

Every window of ``FEATURE`` bytes has an entropy; how rare its entropy is over
all windows of all documents ranks it. In each stretch of ``STRETCH`` windows
the rarest wins, and windows that win often are the document's features. They
go, in text order, into a chain of Bloom filters of ``FILTER_BITS`` bits with
``FILTER_FEATURES`` features each. Two documents are compared filter by filter
on the overlap of their bits beyond what chance gives.

Two passes: the first counts entropies over all windows (a table of ``LEVELS``
numbers whatever the input), the second makes the fingerprints.

Defined cases: a null text is empty and has no feature; a text shorter than
a window has one feature, the text itself; two texts without features have
likeness 1, one with and one without 0; equal texts have equal fingerprints;
in order of key, equal keys are told apart by the text, nulls come last; a
single document is its own next one; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from stockweave.llm import common as C
from stockweave.llm.packed import mix

#: Longest window whose entropy can be measured.
WINDOW = 64
#: Bytes of a window of any text, short or long: features of two lengths would never meet.
FEATURE = 16
STRETCH = 64
#: A window is a feature if it wins at least one in so many of the stretches it could win.
WINS = 4
#: A short text has shorter stretches, so that it still has about so many.
STRETCHES = 16
LEVELS = 1024
FILTER_BITS = 2048
FILTER_FEATURES = 160
HASHES = 5
#: Bytes whose windows are measured together.
CHUNK_BYTES = 1 << 18
#: Rows whose texts are measured together.
ROWS_AT_ONCE = 256
BUCKETS_PER_PARTITION = 2

#: c * log2(c) in whole steps, so that running sums are exact.
_STEPS = np.array([0] + [round(c * math.log2(c) * (1 << 20)) for c in range(1, WINDOW + 1)], dtype=np.int64)


def levels(data: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Entropy of each window as a level from 0 (one byte value) to LEVELS - 1 (all different)."""
    n = len(data)
    before, after = np.zeros(n, dtype=np.uint8), np.zeros(n, dtype=np.uint8)
    for lag in range(1, window):
        same = (data[lag:] == data[:-lag]).view(np.uint8)
        before[lag:] += same
        after[: n - lag] += same
    # A byte that comes in with k equals changes the sum of c * log2(c) by step(k + 1) - step(k); one that goes out likewise.
    gain, top = np.diff(_STEPS), int(_STEPS[window])
    added = gain[np.minimum(before, window - 1)]
    removed = gain[np.minimum(after, window - 1)]
    sums = np.cumsum(added)
    sums[window:] -= np.cumsum(removed[: n - window])
    return ((top - sums[window - 1 :]) * (LEVELS - 1) // top).astype(np.int16)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


def levels_of(texts: list[np.ndarray], window: int = FEATURE) -> list[np.ndarray]:
    """Levels of all windows of each text. Short texts are measured together, long ones chunk by chunk."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    block: list[tuple[int, np.ndarray]] = []
    held = 0

    def measure() -> None:
        found, at = levels(np.concatenate([part for _, part in block]), window), 0
        for i, part in block:
            out[i].append(found[at : at + len(part) - window + 1])
            at += len(part)

    for i, data in enumerate(texts):
        for at in range(0, len(data) - window + 1, CHUNK_BYTES):
            part = data[at : at + CHUNK_BYTES + window - 1]
            block.append((i, part))
            held += len(part)
            if held >= CHUNK_BYTES:
                measure()
                block, held = [], 0
    if block:
        measure()
    return [np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.zeros(0, dtype=np.int16) for parts in out]


def features(data: np.ndarray, level: np.ndarray, ranks: np.ndarray, window: int = FEATURE) -> np.ndarray:
    """Hashes of the selected windows of one text, in order."""
    if len(data) < window:
        return np.array([xxhash.xxh3_64_intdigest(data.tobytes())] if len(data) else [], dtype=np.uint64)
    n = len(level)
    # The leftmost of the rarest wins: rank first, then place.
    keyed = ranks[level] * np.int64(1 << 40) + np.arange(n)
    stretch = min(STRETCH, max(WINS, n // STRETCHES), n)
    winner = _sliding_min(keyed, stretch) & np.int64((1 << 40) - 1)
    cut = np.flatnonzero(np.concatenate([[True], winner[1:] != winner[:-1]]))
    wins = np.diff(np.concatenate([cut, [len(winner)]]))
    # At a text's ends few stretches can be won: the most frequent winner is a feature all the same.
    places = winner[cut][wins >= min(-(-stretch // WINS), int(wins.max()))]
    parts = np.lib.stride_tricks.sliding_window_view(data, window)[places]
    words = np.ascontiguousarray(parts).view("<u8")
    out = np.full(len(places), 0x9E3779B97F4A7C15, dtype=np.uint64)
    for k in range(words.shape[1]):
        out = mix(out ^ words[:, k]) * np.uint64(0x9E3779B97F4A7C15)
    return mix(out)


def chains(texts: list[str], ranks: np.ndarray) -> list[np.ndarray]:
    """The filters of each text."""
    data = [_bytes(t) for t in texts]
    return [chain(features(d, level, ranks)) for d, level in zip(data, levels_of(data), strict=True)]


def chain(hashes: np.ndarray) -> np.ndarray:
    """The Bloom filters, one row of bits each."""
    count = -(-len(hashes) // FILTER_FEATURES)
    bits = np.zeros((count, FILTER_BITS), dtype=np.uint8)
    row = np.arange(len(hashes)) // FILTER_FEATURES
    for k in range(HASHES):
        bits[row, ((hashes >> np.uint64(k * 12)) % np.uint64(FILTER_BITS)).astype(np.int64)] = 1
    return bits


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Mean over the filters of the shorter chain of the best normalised overlap with one of the other's."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    ones_a, ones_b = a.sum(axis=1, dtype=np.int64), b.sum(axis=1, dtype=np.int64)
    both = a.astype(np.float32) @ b.astype(np.float32).T
    least = np.minimum(ones_a[:, None], ones_b[None, :])
    chance = ones_a[:, None] * ones_b[None, :] / FILTER_BITS
    # A full filter overlaps everything: it says nothing beyond chance.
    score = np.clip((both - chance) / np.maximum(least - chance, 1e-9), 0, 1)
    return float(np.average(score.max(axis=1), weights=ones_a))


def spelled(bits: np.ndarray) -> str:
    return f"{len(bits)}:" + base64.b64encode(np.packbits(bits, axis=1).tobytes()).decode()


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow step: per task, the number of windows at each level."""
    counts = np.zeros(LEVELS, dtype=np.int64)
    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_ONCE):
            texts = [_bytes(t or "") for t in batch.column("text").slice(at, ROWS_AT_ONCE).to_pylist()]
            counts += np.bincount(np.concatenate(levels_of(texts)), minlength=LEVELS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], ["level", "windows"])


def ranks(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Rank of each level: the rarer among all windows of all documents, the smaller."""
    rows = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(C.released(_count), "level long, windows long")
    counts = np.zeros(LEVELS, dtype=np.int64)
    for r in rows.groupBy("level").agg(F.sum("windows").alias("windows")).collect():
        counts[r["level"]] = r["windows"]
    # Windows of nearly one byte value and of a single level's noise are no better for being rare: low entropy ranks last.
    order = np.lexsort((np.arange(LEVELS), counts, np.arange(LEVELS) < LEVELS // 10))
    out = np.empty(LEVELS, dtype=np.int64)
    out[order] = np.arange(LEVELS)
    return out


def _edited(text: str, after: str) -> str:
    """The text with its second half replaced by as much of the beginning of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _compared(known) -> object:
    """mapInArrow step over rows in order of (bucket, key): fingerprints and likenesses of each own row."""

    def judged(rows: list[tuple], rank: np.ndarray) -> Iterator[tuple]:
        """Rows (bucket, doc_id, text) and the row after them; nothing for the last one."""
        pairs = [i for i in range(len(rows) - 1) if rows[i][0] == rows[i + 1][0]]
        edits = [_edited(rows[i][2], rows[i + 1][2]) for i in pairs]
        made = chains([r[2] for r in rows] + edits, rank)
        for k, i in enumerate(pairs):
            own, edited, after = made[i], made[len(rows) + k], made[i + 1]
            yield (
                rows[i][1], len(rows[i][2]), hashlib.sha256(_bytes(edits[k]).tobytes()).hexdigest(),
                spelled(own), spelled(edited), likeness(own, edited), likeness(own, after),
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, last = np.frombuffer(known.value, dtype=np.int64), []
        for batch in batches:
            kind = batch.column("doc_id").type
            for at in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                rows = last + list(zip(*(part.column(c).to_pylist() for c in ("bucket", "doc_id", "text")), strict=True))
                last = rows[-1:]
                results = list(zip(*judged(rows, rank), strict=True))
                if results:
                    types = (kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(results, types, strict=True)], NAMES)

    return run


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def compare(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is that of the next larger key (numbers), after the last
    the first. Documents are cut into buckets of consecutive keys; the first
    of each bucket also goes, as a last row, to the bucket before it, so every
    text is shuffled once and no task needs the whole order.
    """
    spark = docs.sparkSession
    rank = spark.sparkContext.broadcast(ranks(docs, text).tobytes())
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    buckets = C.partitions(spark) * BUCKETS_PER_PARTITION
    at = F.col("doc_id").cast("double")
    # The bounds only balance the buckets; any would give the same result.
    bounds = sorted(set(rows.select(at.alias("at")).filter("at is not null").approxQuantile("at", [k / buckets for k in range(1, buckets)], 0.1 / buckets)))
    bucket = F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(
        F.size(F.filter(F.array(*map(F.lit, bounds)).cast("array<double>"), lambda x: x <= at))
    )
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text")
    dealt = rows.withColumn("bucket", bucket.cast("int"))
    # One row per bucket: its first document, for the bucket before it; the very first goes to the last bucket.
    firsts = C.staged(dealt.groupBy("bucket").agg(F.min(place).alias("first")), "fingerprint-firsts")
    order = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("bucket").over(Window.orderBy("bucket")), F.max("bucket").over(order))
    guests = firsts.select("first.doc_id", "first.text", before.alias("bucket"), F.lit(True).alias("guest"))
    everything = dealt.select("doc_id", "text", "bucket", F.lit(False).alias("guest")).unionByName(guests)
    sorted_ = everything.repartition(buckets, "bucket").sortWithinPartitions("bucket", "guest", F.col("doc_id").asc_nulls_last(), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return sorted_.select("bucket", "doc_id", "text").mapInArrow(C.released(_compared(rank)), schema)
