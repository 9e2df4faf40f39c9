"""Hard negatives: an inverted multi-index searched by certified windows.

A vector's two halves are each assigned to the nearest of ``CODEWORDS``
codewords of their own codebook; the pair is the row's cell. A row's score
with an anchor is at most the sum over the halves of (anchor . codeword) +
|anchor| * radius, the radius being the largest distance of a row in that
codeword's cells. A heap walks the grid of cells in falling order of that sum
(the multi-sequence order), so what has not been visited is bounded by the top
of the heap. A window of scores is certified, and needs no further cells, when
it holds as many rows as asked for and the bound is below the last of them, or
when the bound is below the window's lower edge.

The codebooks are fitted on the ``SAMPLE`` rows of smallest hash; every row is
indexed. Rows lie in shards of about ``SHARD_ROWS``, dealt at random, so equal
vectors, ids and labels spread; each shard is an index of its own, with radii
over its own rows. Anchors come in blocks of about ``BLOCK_ANCHORS``; each
block meets each shard once, in a task of bounded size, and a window of ranks
merges what the shards found. First the positives are searched (the same label,
no window), then one window for each positive (other labels). Whatever the
codebooks are like, results are those of comparing everything: bounds only
decide how early a search stops.

Scores are exact integers: products of whole numbers are summed in doubles
while they stay below 2^53, else in 64-bit integers.

Defined cases: rows with a null label or vector, a null or non-finite
component, or one of ``LARGEST`` or more after scaling (sums could leave 64
bits), take no part; vectors of different lengths are compared as if the
shorter went on with zeros; a null id is no anchor and comes last among ties;
rows with equal ids are rows of their own, also among an anchor's positives;
an empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stockweave.llm import common as C

POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
SCALE, LARGEST = 256, 1 << 27
CODEWORDS, ROUNDS, SAMPLE = 16, 8, 4096
SHARD_ROWS, BLOCK_ANCHORS, WAVE_ROWS = 1 << 14, 1 << 10, 512
LAST = (1 << 63) - 1
FOUND = "anchor bigint, w int, id bigint, score bigint"


def prepared(rows: DataFrame, key: Column, vector: Column, label: Column) -> DataFrame:
    """(id, label, vec): the rows that take part, vectors in whole numbers."""
    whole = F.transform(vector.cast("array<double>"), lambda x: F.floor(x * SCALE))
    sound = label.isNotNull() & vector.isNotNull() & F.forall(
        vector.cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < LARGEST)
    )
    return rows.filter(F.coalesce(sound, F.lit(False))).select(
        key.cast("long").alias("id"), label.alias("label"), F.transform(whole, lambda x: x.cast("int")).alias("vec")
    )


def _matrix(column, dim: int) -> np.ndarray:
    """Vectors as rows of doubles, cut or filled with zeros to ``dim``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), dim))
    inside = np.arange(dim)[None, :] < lengths[:, None]
    at = offsets[:-1, None] + np.arange(dim)[None, :]
    out[inside] = flat[at[inside]]
    return out


def _nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.argmin((words * words).sum(axis=1)[None, :] - 2 * (x @ words.T), axis=1)


def _codebook(x: np.ndarray) -> np.ndarray:
    """Codewords by Lloyd's rounds, from the first distinct rows."""
    words = np.unique(x, axis=0)[:CODEWORDS] if len(x) else np.zeros((1, x.shape[1]))
    if len(x) > CODEWORDS:
        words = x[:: len(x) // CODEWORDS][:CODEWORDS].copy()
    for _ in range(ROUNDS if len(x) else 0):
        code = _nearest(x, words)
        count = np.bincount(code, minlength=len(words))
        for j in np.flatnonzero(count):
            words[j] = x[code == j].mean(axis=0)
    return words


class Shard:
    """The inverted multi-index of one shard."""

    def __init__(self, rows: pa.Table, dim: int, books: tuple[np.ndarray, np.ndarray]):
        x = _matrix(rows["vec"], dim)
        half = dim // 2
        a, b = _nearest(x[:, :half], books[0]), _nearest(x[:, half:], books[1])
        order = np.lexsort((b, a))
        self.x, a, b = x[order], a[order], b[order]
        ids = rows["id"].to_numpy()[order] if not rows["id"].null_count else rows["id"].fill_null(LAST).to_numpy()[order]
        self.ids, self.rows = ids.astype(np.int64), rows["row"].to_numpy()[order]
        self.label = rows["label"].to_numpy()[order]
        self.books, self.half = books, half
        cell = a * len(books[1]) + b
        self.starts = np.searchsorted(cell, np.arange(len(books[0]) * len(books[1]) + 1)).tolist()
        #: Per half and codeword the largest distance of a row; below 0 where there is none.
        self.radius = []
        for code, part, words in ((a, self.x[:, :half], books[0]), (b, self.x[:, half:], books[1])):
            r = np.full(len(words), -1.0)
            np.maximum.at(r, code, np.sqrt(((part - words[code]) ** 2).sum(axis=1)))
            self.radius.append(r)
        self.most = float(np.abs(self.x).max(initial=0))

    def scores(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.most * float(np.abs(q).max(initial=0)) * max(1, len(q)) < 2.0**53:
            return (self.x[at] @ q).astype(np.int64)
        return self.x[at].astype(np.int64) @ q.astype(np.int64)

    def waves(self, q: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """Rows in waves of cells, and with each a bound on the scores of all rows not yet seen."""
        sides = []
        for part, words, radius in ((q[: self.half], self.books[0], self.radius[0]), (q[self.half :], self.books[1], self.radius[1])):
            size = float(np.sqrt(part @ part))
            bound = words @ part + size * radius
            bound += 1e-9 * (np.abs(words) @ np.abs(part) + size * radius) + 0.5  # rounding must not lose a row
            live = np.flatnonzero(radius >= 0)
            live = live[np.argsort(-bound[live], kind="stable")]
            sides.append((bound[live].tolist(), live.tolist()))
        (above, rows), (beside, columns) = sides
        if not rows:
            return
        heap, wave, size, want, width = [(-above[0] - beside[0], 0, 0)], [], 0, WAVE_ROWS, len(self.books[1])
        while heap:
            _, i, j = heapq.heappop(heap)
            if j + 1 < len(columns):
                heapq.heappush(heap, (-above[i] - beside[j + 1], i, j + 1))
            if not j and i + 1 < len(rows):
                heapq.heappush(heap, (-above[i + 1] - beside[0], i + 1, 0))
            cell = rows[i] * width + columns[j]
            if self.starts[cell] < self.starts[cell + 1]:
                wave.append(np.arange(self.starts[cell], self.starts[cell + 1]))
                size += len(wave[-1])
            if size >= want or (not heap and wave):
                yield (-heap[0][0] if heap else -np.inf), np.concatenate(wave)
                wave, size, want = [], 0, 2 * want

    def search(self, q: np.ndarray, same: bool, label, row: int, windows: list[tuple[int, int, int]], count: int) -> list[tuple[int, int, int]]:
        """(window, id, score) of the first ``count`` rows in each window (number, least, most)."""
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {w: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for w, _, _ in windows}
        open_ = list(windows)
        for bound, at in self.waves(q):
            at = at[((self.label[at] == label) & (self.rows[at] != row)) if same else (self.label[at] != label)]
            score = self.scores(at, q)
            rest = []
            for w, least, most in open_:
                ids, known = best[w]
                inside = (score >= least) & (score <= most)
                if len(known) == count:
                    inside &= score >= known[-1]
                if inside.any():
                    ids, known = np.concatenate([ids, self.ids[at[inside]]]), np.concatenate([known, score[inside]])
                    first = np.lexsort((ids, -known))[:count]
                    best[w] = ids, known = ids[first], known[first]
                if bound >= least and (len(known) < count or bound >= known[-1]):
                    rest.append((w, least, most))
            open_ = rest
            if not open_:
                break
        return [(w, int(i), int(s)) for w, (ids, known) in best.items() for i, s in zip(ids, known, strict=True)]


def _search(index: DataFrame, queries: DataFrame, shards: int, dim: int, books, same: bool, count: int) -> DataFrame:
    """Each block of queries against each shard: rows of ``FOUND``, at most ``count`` for each shard and window."""
    blocks = max(1, -(-queries.count() // BLOCK_ANCHORS))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    shared = index.sparkSession.sparkContext.broadcast(books)

    def run(key, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and anchors.num_rows:
            shard = Shard(rows, dim, shared.value)
            q = _matrix(anchors["vec"], dim)
            for k, (row, label, windows) in enumerate(zip(*(anchors[c].to_pylist() for c in ("row", "label", "windows")), strict=True)):
                hits = shard.search(q[k], same, label, row, [(w["w"], w["least"], w["most"]) for w in windows], count)
                out += [(row, w, None if i == LAST else i, s) for w, i, s in hits]
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["anchor", "w", "id", "score"])

    found = held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(run, FOUND)
    rank = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= count)


def mine(
    rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score over rows (id, label, vec); ``anchor`` tells the anchors by id.

    Negatives have other labels and scores between ``low`` and ``high`` hundredths of the positive's.
    """
    spark = rows.sparkSession
    numbered = C.staged(rows.withColumn("row", F.monotonically_increasing_id()), "negatives")
    total, dim = numbered.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    shards, dim = max(1, -(-total // SHARD_ROWS)), max(2, dim)
    sample = numbered.orderBy(F.xxhash64("row", "vec"), "row").limit(SAMPLE).select("vec").toArrow()
    x = _matrix(sample["vec"], dim) if sample.num_rows else np.zeros((0, dim))
    books = _codebook(x[:, : dim // 2]), _codebook(x[:, dim // 2 :])
    index = C.staged(numbered.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")), "negatives")
    anchors = numbered.filter(anchor).select("row", "id", "label", "vec")
    everything = F.array(F.struct(F.lit(0).alias("w"), F.lit(-LAST).alias("least"), F.lit(LAST).alias("most")))
    nearest = C.staged(_search(index, anchors.withColumn("windows", everything), shards, dim, books, True, positives), "negatives")
    # In whole numbers: low * p <= 100 * n <= high * p; p = 100 * tens + rest keeps products small.
    hundreds, rest = F.expr("score div 100"), F.expr("score % 100")
    least = hundreds * low + F.ceil(rest * low / F.lit(100)).cast("long")
    most = hundreds * high + F.floor(rest * high / F.lit(100)).cast("long")
    windows = nearest.filter("score >= 0").groupBy("anchor").agg(
        F.collect_list(F.struct(F.col("rank").alias("w"), least.alias("least"), most.alias("most"))).alias("windows")
    )
    asked = C.staged(anchors.join(windows.withColumnRenamed("anchor", "row"), "row"), "negatives")
    found = _search(index, asked, shards, dim, books, False, negatives)
    named = nearest.select("anchor", F.col("rank").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        found.join(named, ["anchor", "w"])
        .join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", F.col("rank").cast("int"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )


def report(embeddings: DataFrame) -> DataFrame:
    """Over ``embeddings``: labels of every seventh id are shifted by one before; anchors are the ids divisible by 100."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(prepared(embeddings, F.col("vec_id"), F.col("embedding"), label), F.col("id") % 100 == 0)
