"""Substring dedup: remove every word covered by a repeated window of words.

Rabin-Karp hashes of all windows of ``width`` words are counted in Spark, and
the repeated windows of a document merge into maximal intervals.

Shuffling a row per window would move many times the text, so windows travel
in runs. The anchor of a window is its smallest hash of ``ANCHOR`` words;
neighbours mostly share it, equal windows always do. A run is a maximal
stretch of windows with one anchor, and one record (anchor, hash of the run's
words, document, place) stands for it:

* an anchor met once: none of its windows is repeated;
* an equal run met again: all its windows are repeated;
* an anchor met with other runs: its windows are counted one by one, again as
  records (anchor, window hash, document, place).

Each task first settles what it can alone and ships one record per different
run, so a passage in a third of all documents reaches a bucket once per task.
Records cross the shuffle packed by bucket. Documents are named by 128 bits of
hash of their text, so copies share their results and doc_id may be null or
repeated. Windows are told apart by 128 bits of hash (anchor and window).

Defined cases: a null or empty text has no words and the digest of the empty
text; a text of fewer than ``width`` words loses nothing; windows are judged
on the input; rows with equal texts all lose all windows; an empty table gives
an empty result; other input columns are ignored, or kept by ``deduplicated``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from stockweave.llm import common as C, packed as P

WIDTH = 35
ANCHOR = 8
#: Words hashed together, and records a task settles together.
BLOCK_WORDS = 1 << 16
FLUSH_RECORDS = 1 << 20
#: Bytes of text finished together; a row counts for ROW_BYTES at least.
PART_BYTES = 1 << 20
ROW_BYTES = 1 << 11
#: Different runs of one anchor that a task ships; beyond them it already knows the anchor needs a count by window.
SHIPPED_KINDS = 8
BUCKETS_PER_PARTITION = 2

FULL, COUNTED = 1, 2  # a run's windows are all repeated; its windows are to be counted
BASE = np.uint64(0x9E3779B97F4A7C15)
UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class _Hasher:
    """Rabin-Karp hashes over a block of documents."""

    def __init__(self, width: int):
        self.width = width
        self.anchor = min(ANCHOR, width)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = 1 << n.bit_length()
            self.up = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, BASE)]))
            self.down = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, UNBASE)]))

    def windows(self, docs: list[list[bytes]]):
        """Place, document, anchor and hash of all windows; and the run hash as a function of place and length."""
        sizes = np.array([len(d) for d in docs], dtype=np.int64)
        n = int(sizes.sum())
        self._powers(n + 1)
        words = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(docs)), dtype=np.uint64, count=n)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(words * self.up[:n], dtype=np.uint64)])

        def grams(at: np.ndarray, length) -> np.ndarray:
            return P.mix((sums[at + length] - sums[at]) * self.down[at])

        ends = np.repeat(np.cumsum(sizes), sizes)
        owner = np.repeat(np.arange(len(docs)), sizes)
        place = np.flatnonzero(np.arange(n) + self.width <= ends)
        if not len(place):
            empty = np.zeros(0, dtype=np.uint64)
            return place, place, empty, empty, grams, sizes
        low = grams(np.arange(n - self.anchor + 1), self.anchor)
        span, size = self.width - self.anchor + 1, 1
        while size * 2 <= span:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < span:
            low = np.minimum(low[: len(low) - (span - size)], low[span - size :])
        return place, owner[place], low[place], grams(place, self.width), grams, sizes


def _blocks(rows, weight) -> Iterator[list]:
    block, held = [], 0
    for row in rows:
        block.append(row)
        held += weight(row)
        if held >= BLOCK_WORDS:
            yield block
            block, held = [], 0
    if block:
        yield block


def _parts(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of about ``PART_BYTES`` of the column ``text``; a longer one stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(np.maximum(sizes, ROW_BYTES)) // PART_BYTES
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(part) != 0, [True]])) if len(batch) else []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(a, b - a)


def _stretches(flags: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of each stretch of consecutive flagged places."""
    at = place[flags]
    first = np.flatnonzero(np.concatenate([[True], np.diff(at) != 1])) if len(at) else np.zeros(0, dtype=np.int64)
    return at[first], np.diff(np.concatenate([first, [len(at)]]))


def _pack(held: list[np.ndarray], settled: list[np.ndarray], buckets: int, by_key: bool) -> Iterator[pa.RecordBatch]:
    """Settle records within the task; rows (bucket, decided, payload) of the rest and of what is settled. Empties both lists."""
    records, decided = P.join(held), P.join(settled)
    held.clear()
    settled.clear()
    if len(records):
        r, first, same, kinds, rank = P.groups(records)
        del records
        extra = (rank >= SHIPPED_KINDS) if by_key else np.zeros(len(r), dtype=bool)
        repeated = (same > 1) | (r["many"] > 0)
        # A copy of a shipped run is repeated; runs beyond the shipped ones need a count by window, one of each kind.
        status = np.where(~first, FULL, np.where(extra, COUNTED + repeated * FULL, 0))
        decided = np.concatenate([decided, P.marked(r, status)])
        records = r[first & ~extra]
        records["many"] = repeated[first & ~extra]
        del r, first, same, kinds, rank, extra, repeated, status
    yield from P.dealt(records, records["key"] if by_key else records["key"] ^ records["rest"], 0, buckets)
    yield from P.dealt(decided, decided["d1"].view(np.uint64), 1, buckets)


def _runs(width: int, buckets: int):
    """mapInArrow step: texts -> packed run records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen, held, decided, size = _Hasher(width), {}, [], [], 0

        def fresh() -> Iterator[tuple[int, int, list[bytes]]]:
            """Texts not seen since the last records went out, cut into words only when their block is filled."""
            for batch in batches:
                for text, d1, d2 in zip(*(batch.column(c) for c in ("__text", "__d1", "__d2")), strict=True):
                    name = d1.as_py(), d2.as_py()
                    copies = seen.get(name, 0)
                    seen[name] = copies + 1
                    if copies > 1:
                        continue
                    words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                    if copies == 0:
                        yield *name, words
                    elif len(words) >= width:
                        # A second copy in this task: every window of the text is repeated.
                        decided.append(P.records(0, 0, *name, np.zeros(1, dtype=np.uint32), len(words) - width + 1, FULL))

        # Short texts make few records or none, but their names are held too.
        for block in _blocks(fresh(), lambda row: len(row[2]) + 1):
            d1, d2 = (np.array([row[k] for row in block], dtype=np.int64) for k in (0, 1))
            place, owner, key, window, grams, sizes = hasher.windows([row[2] for row in block])
            if len(place):
                begin = np.cumsum(sizes) - sizes
                cut = np.concatenate([[True], (np.diff(place) != 1) | (key[1:] != key[:-1])])
                first = np.flatnonzero(cut)
                n = np.diff(np.concatenate([first, [len(place)]]))
                at, who = place[first], owner[first]
                held.append(P.records(key[first], grams(at, n + width - 1), d1[who], d2[who], at - begin[who], n))
                size += len(first)
                # Windows repeated within one document may stand in one run; settle them here.
                order = np.lexsort((window, owner))
                equal = (window[order][1:] == window[order][:-1]) & (owner[order][1:] == owner[order][:-1])
                twice = np.zeros(len(place), dtype=bool)
                twice[order[1:][equal]] = twice[order[:-1][equal]] = True
                at, n = _stretches(twice, place)
                if len(at):
                    who = np.searchsorted(np.cumsum(sizes), at, side="right")
                    decided.append(P.records(0, 0, d1[who], d2[who], at - begin[who], n, FULL))
            if size + len(seen) + len(decided) >= FLUSH_RECORDS:
                yield from _pack(held, decided, buckets, True)
                seen.clear()
                size = 0
        yield from _pack(held, decided, buckets, True)

    return run


VERDICT = T.StructType([T.StructField(n, T.LongType()) for n in ("d1", "d2", "at", "n", "status")])


def _judge(table: pa.Table) -> pa.Table:
    """applyInArrow step over a bucket: what is repeated (FULL) and what is to be counted by window (COUNTED)."""
    records, decided = P.opened(table)
    if len(records):
        r, first, same, kinds, _ = P.groups(records)
        full = (same > 1) | (r["many"] > 0)
        # One run of each kind stands for its windows when the anchor has several kinds.
        counted = (kinds > 1) & (~full | first)
        decided = np.concatenate([decided, P.marked(r, full * FULL + counted * COUNTED)])
    columns = [decided[c].astype(np.int64) for c in ("d1", "d2", "at", "n", "many")]
    return pa.Table.from_arrays([pa.array(c) for c in columns], ["d1", "d2", "at", "n", "status"])


def _verdicts(packed: DataFrame) -> DataFrame:
    """d1, d2 and the distinct (at, n, status) of each text with any."""
    return packed.groupBy("bucket").applyInArrow(_judge, VERDICT).groupBy("d1", "d2").agg(
        F.collect_set(F.struct("at", "n", "status")).alias("found")
    )


def _spans(found, status: int) -> list[tuple[int, int]]:
    return [(f["at"], f["n"]) for f in found or () if f["status"] & status]


def _covered(n_words: int, spans: list[tuple[int, int]], width: int) -> np.ndarray:
    """Mask of the words under windows that start in the spans."""
    edges = np.zeros(n_words + 1, dtype=np.int64)
    for at, n in spans:
        edges[at] += 1
        edges[at + n - 1 + width] -= 1
    return np.cumsum(edges[:-1]) > 0


def _final(text: str | None, words: list[bytes], gone: np.ndarray, keep_text: bool) -> dict:
    """A result row; a text that loses nothing is kept as it is."""
    changed = bool(gone.any())
    kept = b" ".join(compress(words, (~gone).tolist()) if changed else words)
    return {
        "n_words": len(words), "n_removed": int(gone.sum()), "kept_sha256": hashlib.sha256(kept).hexdigest(),
        "kept": (kept.decode("utf-8", "surrogatepass") if changed else text) if keep_text else None,
    }


RESULT = "n_words long, n_removed long, kept_sha256 string, kept string"


def _first_pass(width: int, buckets: int, carried: list[str], keep_text: bool, schema: pa.Schema):
    """mapInArrow step: texts with their verdicts -> finished rows; where windows must be counted, the row and their records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, size = _Hasher(width), [], 0
        for batch in chain.from_iterable(_parts(large, "__text") for large in batches):
            rows, waiting = [], []
            texts, founds = batch.column("__text"), batch.column("__found")
            d1s, d2s = batch.column("__d1"), batch.column("__d2")
            for i in range(len(batch)):
                text, found = texts[i].as_py(), founds[i].as_py()
                words = (text or "").encode("utf-8", "surrogatepass").split()
                sure, open_ = _spans(found, FULL), _spans(found, COUNTED)
                if open_:
                    waiting.append((d1s[i].as_py(), d2s[i].as_py(), words, open_))
                    rows.append({"__packed": zstandard.compress((text or "").encode("utf-8", "surrogatepass"), 3), "__sure": np.array(sure, dtype=np.int64).tobytes(), "__open": True})
                else:
                    rows.append(_final(text, words, _covered(len(words), sure, width), keep_text))
            results = pa.RecordBatch.from_pylist(rows, pa.schema([schema.field(n) for n in LATER]))
            own = dict(zip(batch.schema.names, batch.columns, strict=True)) | dict(zip(LATER, results.columns, strict=True))
            yield _shaped(own, len(batch), schema)
            for block in _blocks(waiting, lambda row: len(row[2])):
                place, owner, key, window, _, sizes = hasher.windows([row[2] for row in block])
                begin = np.cumsum(sizes) - sizes
                wanted = np.zeros(int(sizes.sum()) + 1, dtype=np.int64)
                for k, row in enumerate(block):
                    for at, n in row[3]:
                        wanted[begin[k] + at] += 1
                        wanted[begin[k] + at + n] -= 1
                pick = np.cumsum(wanted)[place] > 0
                who = owner[pick]
                d1, d2 = (np.array([row[k] for row in block], dtype=np.int64)[who] for k in (0, 1))
                held.append(P.records(key[pick], window[pick], d1, d2, place[pick] - begin[who], 1))
                size += len(who)
                if size >= FLUSH_RECORDS:
                    yield from shaped(_pack(held, [], buckets, False))
                    size = 0
        yield from shaped(_pack(held, [], buckets, False))

    def shaped(packed: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in packed:
            yield _shaped(dict(zip(rows.schema.names, rows.columns, strict=True)), len(rows), schema)

    return run


LATER = ("n_words", "n_removed", "kept_sha256", "kept", "__packed", "__sure", "__open")


def _shaped(columns: dict, n: int, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _second_pass(width: int, carried: list[str], keep_text: bool, schema: pa.Schema):
    """mapInArrow step: rows that waited, with the verdicts on their windows -> finished rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(_parts(large, "__packed") for large in batches):
            rows = []
            for text, sure, found in zip(batch.column("__packed"), batch.column("__sure"), batch.column("__found"), strict=True):
                whole = zstandard.decompress(text.as_py())
                words = whole.split()
                spans = [tuple(s) for s in np.frombuffer(sure.as_py(), dtype=np.int64).reshape(-1, 2).tolist()] + _spans(found.as_py(), FULL)
                rows.append(_final(whole.decode("utf-8", "surrogatepass"), words, _covered(len(words), spans, width), keep_text))
            results = pa.RecordBatch.from_pylist(rows, pa.schema([schema.field(n) for n in LATER[:4]]))
            own = dict(zip(batch.schema.names, batch.columns, strict=True)) | dict(zip(LATER[:4], results.columns, strict=True))
            yield _shaped(own, len(batch), schema)

    return run


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def remove(docs: DataFrame, width: int = WIDTH, text: str = "text", keep: list[str] | None = None, keep_text: bool = True) -> DataFrame:
    """The columns ``keep`` of ``docs`` as ``c0``, ``c1``, ... with n_words, n_removed, kept_sha256 and (``keep_text``) the text kept."""
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    buckets = C.partitions(spark) * BUCKETS_PER_PARTITION
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    named = [F.xxhash64(whole).alias("__d1"), F.xxhash64(F.lit("second"), whole).alias("__d2")]
    carried = [f"c{i}" for i in range(len(keep))]
    texts = docs.select(F.col(text).cast("string").alias("__text"), *named)
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("__text"), *named)

    verdicts = _verdicts(texts.mapInArrow(C.released(_runs(width, buckets)), P.PACKED))
    known = verdicts.select(F.col("d1").alias("__d1"), F.col("d2").alias("__d2"), F.col("found").alias("__found"))
    met = rows.join(known, ["__d1", "__d2"], "left").select(*carried, "__text", "__d1", "__d2", "__found")
    # Rows of packed records leave all else null, also columns that are never null in the input.
    own = [T.StructField(f.name, f.dataType) for f in rows.select(*carried).schema]
    body = T.StructType(list(own))
    for field in T.StructType.fromDDL(f"__d1 long, __d2 long, {RESULT}, __packed binary, __sure binary, __open boolean, {P.PACKED}"):
        body = body.add(field)
    passed = C.staged(met.mapInArrow(C.released(_first_pass(width, buckets, carried, keep_text, _arrow(body))), body), "substrings")

    results = ["n_words", "n_removed", "kept_sha256", "kept"]
    windows = _verdicts(passed.filter("bucket is not null").select("bucket", "decided", "payload"))
    counted = windows.select(F.col("d1").alias("__d1"), F.col("d2").alias("__d2"), F.col("found").alias("__found"))
    waiting = passed.filter("__open").select(*carried, "__packed", "__d1", "__d2", "__sure").join(counted, ["__d1", "__d2"], "left")
    after = T.StructType(list(own))
    for field in T.StructType.fromDDL(RESULT):
        after = after.add(field)
    last = waiting.mapInArrow(C.released(_second_pass(width, carried, keep_text, _arrow(after))), after)
    return passed.filter("bucket is null and __open is null").select(*carried, *results).unionAll(last.select(*carried, *results))


def report(docs: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    return remove(docs, width, text, [key], keep_text=False).select(F.col("c0").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def deduplicated(docs: DataFrame, width: int = WIDTH, text: str = "text") -> DataFrame:
    """``docs`` with repeated passages removed; untouched texts stay as they are, and texts left empty go."""
    kept = [c for c in docs.columns if c != text]
    done = remove(docs, width, text, kept).filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    names = {c: f"c{i}" for i, c in enumerate(kept)} | {text: "kept"}
    return done.select(*[F.col(names[c]).alias(c) for c in docs.columns])
