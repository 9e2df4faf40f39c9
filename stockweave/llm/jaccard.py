"""N-gram Jaccard join: count vectors in an R-tree, survivors verified.

A text is the set of hashes of its distinct word n-grams. The hashes fall into
``GROUPS`` groups; the counts per group make the set a point, and no two sets
can share more than the sum over the groups of the smaller count. Trees of
points with their coordinate maxima cut off whole branches by that bound, and
pairs that pass it are verified on their n-grams.

Hashed counts of long texts lie so close together that one tree over all
points would prune next to nothing, so trees are built per shared n-gram. Sets
as similar as asked share one of their rarest n-grams: with n elements and
similarity t, one of the n - ceil(t * n) + 1 first in any common order. The
order is by the frequency of the n-gram's rarest word, counted over all
documents in a table of fixed size, so passages that many texts share come
last. The join then goes from cheap to dear, and only ever needs connections:

1. Texts with equal sets are one class; only classes go on.
2. Each class is compared with one class of each n-gram it shares, the
   smallest, then in a second turn with a few others, as far as the two are not
   connected yet: a group of near copies costs its size, not its square.
3. N-grams whose classes are not yet connected are searched in full by tree,
   between components only. Groups above ``TREE_ROWS`` are cut into parts: the
   largest component is spread over the parts, the others visit each.

Links from 2 and 3 are all verified, and no link that would connect two
components is missed, so the components are exact.

Defined cases: a null or empty text has an empty set and is linked with
nothing; with fewer words than n the whole sequence is one n-gram; equal rows
are linked when their set is not empty; a null key is never the smallest; an
empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stockweave.llm import common as C, packed as P
from stockweave.llm.components import components

SHINGLE = 3
PERCENT = 90
GROUPS = 256
#: Slots of the word-frequency table; collisions only blur the order.
SLOTS = 1 << 18
TREE_ROWS = 4096
LEAF, FAN = 16, 8
#: Turns before the full search, with the salts of the classes that each is compared with per shared n-gram; 0 is the smallest class.
STAR_TURNS = ((0,), (1, 2))
#: Groups of up to so many classes are compared without a tree.
SIDE = 12
BUCKETS_PER_PARTITION = 2
#: Smallest n-grams a class carries, so that its pairs are named under one n-gram; shorter lists are filled up.
LEAST, NO_GRAM = 8, (1 << 63) - 1
#: Pairs a task of the tree search holds to tell repeated ones.
HELD_PAIRS = 1 << 18
FLUSH_RECORDS = 1 << 19
#: Words and texts hashed together.
BLOCK_WORDS, BLOCK_TEXTS = 1 << 16, 512
#: Bits of the broadcast filter that says which texts a verification may need; false hits only cost time.
FILTER_BITS = 1 << 24
STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
FULL_COUNT = 65535


def _words(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _hashes(words: list[bytes]) -> np.ndarray:
    # Digests joined: quicker than a Python number per word.
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), dtype=">u8").astype(np.uint64)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the word n-grams, in text order; one for a shorter text."""
    n = max(1, len(words) - k + 1) if len(words) else 0
    if not n:
        return words
    width = min(k, len(words))
    out = np.full(n, width, dtype=np.uint64)
    for j in range(width):
        out = P.mix(out * STEPS[0] + words[j : j + n])
    return out


def _names(grams: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """128 bits that name each of the sets, which start at ``at`` and are not empty."""
    return [np.add.reduceat(P.mix(grams ^ step), at).view(np.int64) for step in STEPS]


def _blocks(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """The words of the texts, some texts at once: a numpy call a text costs more than its work on a short one."""
    block, held = [], 0
    for text in texts:
        block.append(_words(text.as_py()))
        held += len(block[-1])
        if held >= BLOCK_WORDS or len(block) >= BLOCK_TEXTS:
            yield block
            block, held = [], 0
    if block:
        yield block


def _grams(texts: list[list[bytes]], k: int, worth=None) -> tuple[np.ndarray, ...]:
    """Hashes of all words; of the distinct n-grams text after text in ascending order; how many each text has.

    With ``worth``, a number per word hash, last the least worth of each n-gram's words.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    words = _hashes(list(chain.from_iterable(texts)))
    begin, n = np.cumsum(sizes) - sizes, np.where(sizes < k, np.minimum(sizes, 1), sizes - k + 1)
    to = np.cumsum(n)
    grams, least = np.zeros(int(n.sum()), dtype=np.uint64), None
    often = worth(words) if worth else None
    if worth:
        least = np.zeros(len(grams), dtype=np.int64)
    long = np.repeat(sizes >= k, sizes) & (np.arange(len(words)) + k <= np.repeat(begin + sizes, sizes))
    into = np.repeat(sizes >= k, n)
    if into.any():
        grams[into] = shingles(words, k)[long[: len(words) - k + 1]]
        if worth:
            fewest = often[: len(words) - k + 1]
            for j in range(1, k):
                fewest = np.minimum(fewest, often[j : j + len(fewest)])
            least[into] = fewest[long[: len(words) - k + 1]]
    for i in np.flatnonzero((sizes < k) & (sizes > 0)):
        part = slice(begin[i], begin[i] + sizes[i])
        grams[to[i] - 1] = shingles(words[part], k)[0]
        if worth:
            least[to[i] - 1] = often[part].min()
    for a, b in zip((to - n).tolist(), to.tolist(), strict=True):
        if worth:
            order = np.lexsort((grams[a:b], least[a:b]))
            grams[a:b], least[a:b] = grams[a:b][order], least[a:b][order]
        else:
            grams[a:b].sort()
    new = np.ones(len(grams), dtype=bool)
    new[1:] = grams[1:] != grams[:-1]
    new[(to - n)[n > 0]] = True
    count = np.bincount(np.repeat(np.arange(len(texts)), n)[new], minlength=len(texts))
    return words, grams[new], count, None if least is None else least[new]


def needed(a, b, percent: int):
    """The overlap that sets of a and b elements need: the least o with 100 * o >= percent * (a + b - o)."""
    return -(-percent * (a + b) // (100 + percent))


# ---------------------------------------------------------------- 1. classes


POINT_TYPES = {n: pa.int64() for n in ("h1", "h2", "n", "d1", "d2")} | {"point": pa.binary(), "slot": pa.int64(), "count": pa.int64()}


def _points(k: int, groups: int, slots: int):
    """mapInArrow step: per text the name, size and point of its set; per task the counts of its words by slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(slots, dtype=np.int64)
        kind = pa.null()
        for batch in batches:
            kind, done = batch.column("doc_id").type, 0
            for block in _blocks(batch.column("text")):
                words, grams, n, _ = _grams(block, k)
                _count(counts, words, slots)
                some = n > 0
                d1, d2 = (np.zeros(len(n), dtype=np.int64) for _ in range(2))
                if some.any():
                    d1[some], d2[some] = _names(grams, (np.cumsum(n) - n)[some])
                cell = np.repeat(np.arange(len(n)), n) * groups + (grams % np.uint64(groups)).astype(np.int64)
                point = np.minimum(np.bincount(cell, minlength=len(n) * groups), FULL_COUNT).astype("<u2").reshape(len(n), groups)
                own = {"n": n, "d1": pa.array(d1, mask=~some), "d2": pa.array(d2, mask=~some)}
                own["point"] = [row.tobytes() if full else None for row, full in zip(point, some.tolist(), strict=True)]
                part = batch.slice(done, len(block))
                done += len(block)
                yield shaped(len(part), {c: part.column(c) for c in ("doc_id", "h1", "h2")} | own, kind)
        used = np.flatnonzero(counts)
        for at in range(0, len(used), 65536):
            part = used[at : at + 65536]
            yield shaped(len(part), {"slot": part, "count": counts[part]}, kind)

    def shaped(size: int, columns: dict, kind: pa.DataType) -> pa.RecordBatch:
        own = {n: c if isinstance(c, pa.Array) else pa.array(c, POINT_TYPES[n]) for n, c in columns.items()}
        types = {"doc_id": kind} | POINT_TYPES
        return pa.RecordBatch.from_arrays([own[n] if n in own else pa.nulls(size, t) for n, t in types.items()], list(types))

    return run


def _count(counts: np.ndarray, words: np.ndarray, slots: int) -> None:
    np.add.at(counts, (words % np.uint64(slots)).astype(np.int64), 1)


# ------------------------------------------------- 2. shared rare n-grams


def _prefixes(k: int, percent: int, slots: int, buckets: int, shared):
    """mapInArrow step: texts -> packed records (n-gram, class, size) of the rarest n-grams.

    An n-gram that two classes of the task share is known to be shared; the
    task ships one record of it for the others and passes its rows on.
    """

    def settle(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = P.join(held, GRAM)
        if not len(rows):
            return
        r, first, _, kinds, rank = P.groups(rows, "d1")
        r, kinds, rank = r[first], kinds[first], rank[first]
        met = kinds > 1
        ship = r[rank == 0].copy()
        ship["many"] = met[rank == 0]
        yield from P.dealt(ship, ship["key"], 0, buckets)
        yield from P.dealt(r[met], r[met]["key"], 1, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.frombuffer(shared.value, dtype=np.int64)
        held, size = [], 0
        for batch in batches:
            for block in _blocks(batch.column("text")):
                _, grams, n, _ = _grams(block, k, lambda words: counts[(words % np.uint64(slots)).astype(np.int64)])
                begin, some = np.cumsum(n) - n, n > 0
                if not some.any():
                    continue
                begin, n = begin[some], n[some]
                names = _names(grams, begin)
                rarest = n - (percent * n + 99) // 100 + 1
                who = np.repeat(np.arange(len(n)), rarest)
                own = np.zeros(len(who), dtype=GRAM)
                own["key"] = grams[begin[who] + np.arange(len(who)) - (np.cumsum(rarest) - rarest)[who]]
                own["n"], own["d1"], own["d2"] = n[who], names[0][who], names[1][who]
                held.append(own)
                size += len(own)
                if size >= FLUSH_RECORDS:
                    yield from settle(held)
                    held, size = [], 0
        yield from settle(held)

    return run


#: An n-gram of a class, its size, and whether the task that ships it met other classes with it.
GRAM = np.dtype([("key", "<u8"), ("d1", "<i8"), ("d2", "<i8"), ("n", "<u4"), ("many", "u1")])
SHARED = "gram long, d1 long, d2 long, n long"


def _met(table: pa.Table) -> pa.Table:
    """applyInArrow step over a bucket: the classes of n-grams that at least two have.

    N-grams of the same classes, as those of a passage mostly are, lead to the
    same pairs: they go by one name, a hash of their classes, and are one group.
    Were two lists of classes to share a name, their group would hold both.
    """
    r = np.concatenate(P.opened(table, GRAM))
    if len(r):
        r = r[np.lexsort((r["d2"], r["d1"], r["key"]))]
        new = np.concatenate([[True], r["key"][1:] != r["key"][:-1]])
        kind = new | np.concatenate([[True], (r["d1"][1:] != r["d1"][:-1]) | (r["d2"][1:] != r["d2"][:-1])])
        r, new = r[kind], new[kind]
        r["many"] = 0
        at = np.flatnonzero(new)
        kinds = np.diff(np.concatenate([at, [len(r)]]))
        names = np.add.reduceat(P.mix(r["d1"].view(np.uint64) ^ P.mix(r["d2"].view(np.uint64) ^ STEPS[0])), at)
        r["key"] = np.repeat(names, kinds)
        r = r[np.repeat(kinds > 1, kinds)]
        r = r[np.lexsort((r["d2"], r["d1"], r["key"]))]
        again = (r[1:] == r[:-1]) if len(r) else np.zeros(0, dtype=bool)
        r = r[~np.concatenate([np.zeros(min(1, len(r)), dtype=bool), again])]
    return pa.Table.from_arrays([pa.array(r["key"].view(np.int64)), *(pa.array(r[c].astype(np.int64)) for c in ("d1", "d2", "n"))], ["gram", "d1", "d2", "n"])


# --------------------------------------------------------- 3. trees of points


class Tree:
    """Points in order of size, then of coordinates, under nodes with the maxima of their coordinates and their range of sizes."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, percent: int):
        self.percent = percent
        self.order = np.lexsort((points[:, 1], points[:, 0], sizes))
        self.levels = [(points[self.order], sizes[self.order], sizes[self.order])]
        step = LEAF
        while len(self.levels[-1][0]) > step:
            below, low, high = self.levels[-1]
            at = np.arange(0, len(below), step)
            self.levels.append((np.maximum.reduceat(below, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))
            step = FAN

    def near(self, point: np.ndarray, size: int) -> np.ndarray:
        """Rows whose overlap with the point may suffice."""
        top = len(self.levels) - 1
        rows = np.arange(len(self.levels[top][0]))
        for k in range(top, -1, -1):
            maxima, low, high = self.levels[k]
            rows = rows[(100 * high[rows] >= self.percent * size) & (100 * size >= self.percent * low[rows])]
            bound = np.minimum(maxima[rows], point).sum(axis=1, dtype=np.int64)
            # A count at the top of its range may stand for more.
            bound[(maxima[rows] >= FULL_COUNT).any(axis=1)] = np.iinfo(np.int64).max
            rows = rows[bound >= needed(size, np.maximum(low[rows], -(-self.percent * size // 100)), self.percent)]
            if k:
                step = LEAF if k == 1 else FAN
                rows = (rows[:, None] * step + np.arange(step)).ravel()
                rows = rows[rows < len(self.levels[k - 1][0])]
        return self.order[rows]


def _decode(points: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(points.to_pylist()), dtype="<u2").reshape(len(points), -1)


def _passes(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Whether the summed minima of the points allow the overlap that sets of these sizes need."""
    least = np.minimum(a, b)
    # A count at the top of its range may stand for more.
    return (least.sum(axis=1, dtype=np.int64) >= needed(na, nb, percent)) | (least >= FULL_COUNT).any(axis=1)


PAIRS = "a1 long, a2 long, b1 long, b2 long"
PAIR_NAMES = ["a1", "a2", "b1", "b2"]
#: Pairs with the hashes of the texts that stand for their classes.
HASHED = PAIRS + ", ah1 long, ah2 long, bh1 long, bh2 long"
HASHED_NAMES = [*PAIR_NAMES, "ah1", "ah2", "bh1", "bh2"]


def _meet_here(least: np.ndarray, gram: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the pairs are named under this n-gram: the smallest they share, as far as both lists of smallest ones tell.

    Any n-gram of both that is smaller than one in both lists would be in both
    lists itself, so what they have in common starts with the smallest shared one.
    """
    out = np.empty(len(i), dtype=bool)
    for at in range(0, len(i), 1 << 14):
        a, b = least[i[at : at + (1 << 14)]], least[j[at : at + (1 << 14)]]
        both = np.where((a[:, :, None] == b[:, None, :]).any(axis=2), a, NO_GRAM).min(axis=1)
        out[at : at + (1 << 14)] = (both == NO_GRAM) | (both == gram[i[at : at + (1 << 14)]])
    return out


def _searched(percent: int):
    """mapInArrow step over rows in order of (gram, part): pairs of different components that pass the bound.

    Small groups are compared side by side, ``SIDE`` rows apart at most;
    larger ones by tree. A pair that shares many n-grams is named under one of
    them, see ``_meet_here``. A group that a batch cuts waits for its rest.
    """

    def search(rows: pa.Table) -> np.ndarray:
        gram, part = np.array(rows.column("gram")), np.array(rows.column("part"))
        cut = np.concatenate([[True], (gram[1:] != gram[:-1]) | (part[1:] != part[:-1])])
        group = np.cumsum(cut) - 1
        sizes, root, own = np.array(rows.column("n")), np.array(rows.column("r1")), np.array(rows.column("own"), dtype=bool)
        name = np.stack([np.array(rows.column("d1")), np.array(rows.column("d2"))], axis=1)
        points = _decode(rows.column("point"))
        least = np.frombuffer(b"".join(rows.column("least").to_pylist()), dtype=">i8").reshape(len(gram), LEAST).astype(np.int64)
        count = np.bincount(group)
        found = [np.zeros((0, 2), dtype=np.int64)]
        for apart in range(1, min(SIDE, int(count.max()))):
            i = np.flatnonzero((group[apart:] == group[:-apart]) & (count[group[apart:]] <= SIDE))
            j = i + apart
            fits = (root[i] != root[j]) & (own[i] | own[j])
            fits &= (100 * sizes[i] >= percent * sizes[j]) & (100 * sizes[j] >= percent * sizes[i])
            i, j = i[fits], j[fits]
            here = _meet_here(least, gram, i, j)
            i, j = i[here], j[here]
            good = _passes(points[i], points[j], sizes[i], sizes[j], percent)
            found.append(np.stack([i[good], j[good]], axis=1))
        for g in np.flatnonzero(count > SIDE):
            at = np.flatnonzero(group == g) if len(count) < 64 else np.arange(*np.searchsorted(group, [g, g + 1]))
            tree = Tree(points[at].astype(np.int64), sizes[at], percent)
            for k in np.flatnonzero(own[at]):
                near = at[tree.near(points[at[k]].astype(np.int64), int(sizes[at[k]]))]
                # Two own rows meet twice; the smaller one reports them.
                near = near[(root[near] != root[at[k]]) & (~own[near] | (near > at[k]))]
                near = near[_meet_here(least, gram, np.full(len(near), at[k]), near)]
                found.append(np.stack([np.full(len(near), at[k]), near], axis=1))
        pairs = np.concatenate(found)
        a, b = name[pairs[:, 0]], name[pairs[:, 1]]
        # One way round, whatever order the rows came in: the same pair meets under many n-grams.
        turned = (a[:, 0] > b[:, 0]) | ((a[:, 0] == b[:, 0]) & (a[:, 1] > b[:, 1]))
        a[turned], b[turned] = b[turned], a[turned]
        return np.unique(np.concatenate([a, b], axis=1), axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        held, size = [], 0

        def sent() -> Iterator[pa.RecordBatch]:
            pairs = np.unique(np.concatenate(held), axis=0)
            for at in range(0, len(pairs), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in pairs[at : at + (1 << 16)].T], PAIR_NAMES)

        for batch in batches:
            if not len(batch):
                continue
            waiting.append(batch)
            same = np.array(batch.column("gram")) == batch.column("gram")[len(batch) - 1].as_py()
            same &= np.array(batch.column("part")) == batch.column("part")[len(batch) - 1].as_py()
            rest = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if rest:
                rows = pa.Table.from_batches([*waiting[:-1], batch.slice(0, rest)]).combine_chunks()
                held.append(search(rows))
                size += len(held[-1])
                waiting = [batch.slice(rest)]
                if size >= HELD_PAIRS:
                    yield from sent()
                    held, size = [], 0
        if waiting:
            held.append(search(pa.Table.from_batches(waiting).combine_chunks()))
        if held:
            yield from sent()

    return run


def _bounded(percent: int):
    """mapInArrow step: pairs with both points -> the pairs that pass the bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                a, b = _decode(batch.column("pa")), _decode(batch.column("pb"))
                keep = _passes(a, b, np.array(batch.column("na")), np.array(batch.column("nb")), percent)
                yield batch.select(HASHED_NAMES).filter(pa.array(keep))

    return run


# ------------------------------------------------------------ 4. verification


def _verify(k: int, percent: int):
    """mapInArrow step: pairs with both texts -> the pairs that are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, known = [], None, None
            for ta, tb in zip(batch.column("ta"), batch.column("tb"), strict=True):
                b = tb.as_py()
                if b != last:
                    last, known = b, np.unique(shingles(_hashes(_words(b)), k))
                a = np.unique(shingles(_hashes(_words(ta.as_py())), k))
                both = len(np.intersect1d(a, known, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(known) - both))
            yield batch.select(PAIR_NAMES).filter(pa.array(keep, pa.bool_()))

    return run


def _hit(flags: np.ndarray, hashes: pa.Array, bits: int) -> np.ndarray:
    h = np.array(hashes, dtype=np.int64).view(np.uint64) % np.uint64(bits)
    return (flags[(h >> np.uint64(3)).astype(np.int64)] >> (h & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _filtered(shared, bits: int):
    """mapInArrow step: the texts whose hash the filter may contain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(shared.value, dtype=np.uint8)
        for batch in batches:
            yield batch.filter(pa.array(_hit(flags, batch.column("h1"), bits)))

    return run


def _filter_for(wanted: DataFrame, bits: int) -> bytes:
    """A bitmap of the hashes ``h1``, built from at most bits / 8 distinct byte numbers whatever the number of rows."""
    slot = F.pmod(F.col("h1"), F.lit(bits))
    # pmod of a signed number and % of an unsigned one agree where bits is a power of two.
    rows = wanted.groupBy(F.shiftright(slot, 3).alias("byte")).agg(F.bit_or(F.pow(F.lit(2), slot % 8).cast("int")).alias("bits"))
    out = np.zeros(bits // 8, dtype=np.uint8)
    table = rows.toArrow()
    out[np.array(table.column("byte"))] = np.array(table.column("bits")).astype(np.uint8)
    return out.tobytes()


def _pair(a1: str, a2: str) -> Column:
    return F.struct(F.col(a1).alias("d1"), F.col(a2).alias("d2"))


class Join:
    """The stages of one join; tables between them are staged."""

    def __init__(self, docs: DataFrame, key: str, text: str, k: int, percent: int):
        self.spark: SparkSession = docs.sparkSession
        self.k, self.percent = k, percent
        self.buckets = C.partitions(self.spark) * BUCKETS_PER_PARTITION
        whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
        self.rows = docs.select(
            F.col(key).alias("doc_id"), F.xxhash64(whole).alias("h1"), F.xxhash64(F.lit("second"), whole).alias("h2"), whole.alias("text")
        )
        self.texts = self.rows.select("h1", "h2", "text")
        kind = docs.schema[key].dataType.simpleString()
        out = self.rows.mapInArrow(
            C.released(_points(k, GROUPS, SLOTS)), f"doc_id {kind}, h1 long, h2 long, n long, d1 long, d2 long, point binary, slot long, count long"
        )
        seen = C.staged(out, "jaccard-points")
        self.docs = seen.filter("n is not null").select("doc_id", "h1", "h2", "n", "d1", "d2")
        # One row per class: any of its texts will do.
        classes = seen.filter("n > 0").groupBy("d1", "d2", "n").agg(F.min(F.struct("h1", "h2", "point")).alias("one"))
        self.classes = C.staged(classes.select("d1", "d2", "n", "one.h1", "one.h2", "one.point"), "jaccard-classes")
        counts = np.zeros(SLOTS, dtype=np.int64)
        table = seen.filter("slot is not null").groupBy("slot").agg(F.sum("count").alias("count")).toArrow()
        counts[np.array(table.column("slot"))] = np.array(table.column("count"))
        self.counts = counts.tobytes()

    def shared(self) -> DataFrame:
        """gram, d1, d2, n of the rare n-grams that several classes have."""
        known = self.spark.sparkContext.broadcast(self.counts)
        packed = self.texts.select("text").mapInArrow(C.released(_prefixes(self.k, self.percent, SLOTS, self.buckets, known)), P.PACKED)
        return C.staged(packed.groupBy("bucket").applyInArrow(_met, SHARED).distinct(), "jaccard-grams")

    def star(self, rows: DataFrame, salts: tuple[int, ...]) -> DataFrame:
        """Each class with one class per salt of each n-gram it shares, if that is of another component.

        Salt 0 picks the smallest class, another one the class of smallest salted hash.
        """
        ranks = [F.struct(*([F.xxhash64("d1", "d2", F.lit(salt)).alias("h")] if salt else []), "n", "d1", "d2") for salt in salts]
        chosen = rows.groupBy("gram").agg(*[F.min_by(F.struct("n", "d1", "d2", "root"), r).alias(f"m{i}") for i, r in enumerate(ranks)])
        pairs = rows.join(chosen, "gram").withColumn("m", F.explode(F.array(*[f"m{i}" for i in range(len(salts))])))
        pairs = pairs.filter(F.col("root") != F.col("m.root"))
        pairs = pairs.filter((F.col("m.n") * 100 >= F.col("n") * self.percent) & (F.col("n") * 100 >= F.col("m.n") * self.percent))
        pairs = pairs.select(F.col("d1").alias("a1"), F.col("d2").alias("a2"), F.col("m.d1").alias("b1"), F.col("m.d2").alias("b2"))
        # Dealt by class a, as the join that follows needs them: one shuffle for both.
        return pairs.repartition("a1", "a2").distinct()

    def open_rows(self, rows: DataFrame, labels: DataFrame) -> DataFrame:
        """The rows with the components they are in now, of n-grams with at least two components."""
        known = labels.select(F.col("node.d1").alias("d1"), F.col("node.d2").alias("d2"), F.col("root").alias("now"))
        rows = rows.join(known, ["d1", "d2"], "left").withColumn("root", F.coalesce("now", "root")).drop("now")
        several = rows.groupBy("gram").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("gram")
        return C.staged(rows.join(several, "gram", "left_semi"), "jaccard-open")

    def hashed(self, pairs: DataFrame, points: bool = False) -> DataFrame:
        """The pairs with the text hashes of both classes, and if asked for with their sizes and points."""
        for end in "ab":
            names = {"d1": f"{end}1", "d2": f"{end}2", "h1": f"{end}h1", "h2": f"{end}h2"}
            names |= {"n": f"n{end}", "point": f"p{end}"} if points else {}
            pairs = pairs.join(self.classes.select(*[F.col(c).alias(n) for c, n in names.items()]), [f"{end}1", f"{end}2"])
        return pairs.select(*HASHED_NAMES, *(["na", "nb", "pa", "pb"] if points else []))

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """The pairs that the summed minima of their points let pass."""
        return self.hashed(pairs, points=True).mapInArrow(_bounded(self.percent), HASHED)

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The hashed pairs whose n-grams are similar enough; only texts of candidate classes are shuffled."""
        with C.collected() as made:
            links = self._verified(C.staged(pairs, "jaccard-pairs"))
        C.discard(self.spark, made[:-1])
        return links

    def _verified(self, pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("ah1").alias("h1"), F.col("ah2").alias("h2")).union(pairs.select("bh1", "bh2"))
        flags = self.spark.sparkContext.broadcast(_filter_for(wanted, FILTER_BITS))
        some = self.texts.mapInArrow(_filtered(flags, FILTER_BITS), self.texts.schema)
        # Copies of a text become one before they are shuffled.
        texts = some.groupBy("h1", "h2").agg(F.first("text").alias("text")).join(wanted, ["h1", "h2"], "left_semi")
        texts = C.staged(texts, "jaccard-texts")
        both = pairs
        for end in "ab":
            own = texts.select(F.col("h1").alias(f"{end}h1"), F.col("h2").alias(f"{end}h2"), F.col("text").alias(f"t{end}"))
            both = both.join(own, [f"{end}h1", f"{end}h2"])
        both = both.select(*PAIR_NAMES, "ta", "tb")
        return C.staged(both.mapInArrow(C.released(_verify(self.k, self.percent)), PAIRS), "jaccard-links")

    def rest(self, known: DataFrame) -> DataFrame:
        """Pairs of different components that share an n-gram and pass the bound, by tree."""
        sides = known.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("rows"))
        open_ = sides.groupBy("gram").agg(
            F.max(F.struct("rows", "root")).alias("most"), F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("sides")
        )
        open_ = open_.filter("sides > 1").select("gram", F.col("most.root").alias("main"), F.ceil(F.col("rows") / TREE_ROWS).cast("int").alias("parts"))
        rows = C.staged(known.join(open_, "gram").withColumn("home", F.pmod(F.xxhash64("d1", "d2"), F.col("parts")).cast("int")), "jaccard-rest")
        # An n-gram per row, each class once: a class has as many n-grams as its text allows.
        grams = F.slice(F.array_sort(F.collect_list("gram")), 1, LEAST)
        filled = F.concat(grams, F.array_repeat(F.lit(NO_GRAM).cast("long"), LEAST))
        least = rows.groupBy("d1", "d2").agg(filled.alias("least"))
        eight = F.concat(*[F.unhex(F.lpad(F.hex(F.col("least")[i]), 16, "0")) for i in range(LEAST)])
        points = self.classes.select("d1", "d2", "point").join(least, ["d1", "d2"]).select("d1", "d2", "point", eight.alias("least"))
        # The largest component is spread over the parts; all others visit every part and are searched for in one.
        visits = F.when(F.col("root") == F.col("main"), F.array("home")).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
        rows = rows.withColumn("part", F.explode(visits))
        rows = rows.withColumn("own", F.when(F.col("root") == F.col("main"), F.lit(True)).otherwise(F.col("part") == F.col("home")))
        rows = rows.join(points, ["d1", "d2"]).select("gram", "part", "own", "d1", "d2", "n", F.xxhash64("root").alias("r1"), "point", "least")
        ordered = rows.repartition(C.partitions(self.spark), "gram", "part").sortWithinPartitions("gram", "part")
        return ordered.mapInArrow(_searched(self.percent), PAIRS).distinct()

    def linked(self) -> DataFrame:
        """node, root of every class with a link; both are structs (d1, d2)."""
        rows = self.shared().withColumn("root", F.struct("d1", "d2"))
        labels, before = None, []
        for salts in STAR_TURNS:
            labels = self.joined(labels, self.bounded(self.star(rows, salts)))
            with C.collected() as made:
                rows = self.open_rows(rows, labels)
            C.discard(self.spark, before)
            before = made
            if rows.isEmpty():
                return labels
        return self.joined(labels, self.hashed(self.rest(rows)))

    def joined(self, labels: DataFrame | None, pairs: DataFrame) -> DataFrame:
        """The components (node, root) that ``labels`` and those of the pairs that are links make."""
        return components(self.edges(self.verified(pairs)), labels)

    def edges(self, pairs: DataFrame) -> DataFrame:
        return pairs.select(_pair("a1", "a2").alias("a"), _pair("b1", "b2").alias("b"))

    def documents(self) -> DataFrame:
        """doc_id, h1, h2, n, root: the component's name, null for an empty set."""
        labels = self.linked().select(F.col("node.d1").alias("d1"), F.col("node.d2").alias("d2"), "root")
        named = self.docs.join(labels, ["d1", "d2"], "left")
        own = F.when(F.col("n") > 0, F.coalesce("root", F.struct("d1", "d2")))
        return C.staged(named.select("doc_id", "h1", "h2", "n", own.alias("root")), "jaccard-docs")


def _documents(docs: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    """``Join.documents`` without the tables that led there."""
    with C.collected() as made:
        rows = Join(docs, key, text, k, percent).documents()
    C.discard(docs.sparkSession, made[:-1])
    return rows


def report(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest doc_id reachable by links, itself included)."""
    rows = _documents(docs, key, text, k, percent)
    least = rows.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    )


def _marked(shared, bits: int, text_hash: str, mark: str):
    """mapInArrow step: rows with ``mark``, whether the filter may contain their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(shared.value, dtype=np.uint8)
        for batch in batches:
            yield batch.append_column(mark, pa.array(_hit(flags, batch.column(text_hash), bits)))

    return run


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: that of the smallest key, and among equal keys the smallest text hash.

    Documents without words are alone and stay; of rows equal in key and text
    one stays. Only rows that may have to go are shuffled: a bitmap of fixed
    size tells them, and an exact join decides.
    """
    spark = docs.sparkSession
    rows = _documents(docs, key, text, k, percent)
    name = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2")
    least = rows.filter("root is not null").groupBy("root").agg(F.min(name).alias("one"))
    same = rows.filter("root is not null").groupBy("doc_id", "h1", "h2", "root").agg(F.count(F.lit(1)).alias("copies"))
    judged = same.join(least, "root").withColumn("stays", name == F.col("one"))
    special = C.staged(judged.filter("not stays or copies > 1").select("doc_id", "h1", "h2", "stays"), "jaccard-special")
    flags = spark.sparkContext.broadcast(_filter_for(special, FILTER_BITS))
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    wide = docs.withColumn("__h1", F.xxhash64(whole)).withColumn("__h2", F.xxhash64(F.lit("second"), whole))
    marked = wide.mapInArrow(_marked(flags, FILTER_BITS, "__h1", "__maybe"), T.StructType([*wide.schema.fields, T.StructField("__maybe", T.BooleanType())]))
    on = marked[key].eqNullSafe(special["doc_id"]) & (marked["__h1"] == special["h1"]) & (marked["__h2"] == special["h2"])
    decided = marked.filter("__maybe").join(special.select("doc_id", "h1", "h2", F.col("stays").alias("__stays")), on, "left")
    kept = decided.filter("__stays is null or __stays").select(*[marked[c] for c in marked.columns]).dropDuplicates([key, "__h1", "__h2"])
    return marked.filter("not __maybe").select(*docs.columns).unionByName(kept.select(*docs.columns))
