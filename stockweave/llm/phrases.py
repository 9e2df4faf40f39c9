"""Phrase collocations: Apriori levels counted by broadcast double-array tries.

Texts become arrays of word numbers (0 for a rare word or a break), one row
per language and batch of texts. A phrase of k + 1 words can only be frequent
if its first k and its last k words are, so the candidates of a level are those
continuations of frequent phrases that the texts hold often enough. They
go into a double array: the state of a position and the number of the word
that comes next add up to a slot, and the slot's check says whether it belongs
to that state. All positions of a batch step together, one numpy lookup for
each word of the phrase; the slots reached are counted by ``bincount``, and
Spark sums the tasks' counts. The same pass gathers the continuations of the
level above, as pairs (phrase, next word) with counts.

Dictionary and tries are broadcast in chunks of at most ``CHUNK`` entries, one
pass over the texts for each chunk, so what is broadcast and what a task counts
in stays bounded however many phrases there are. A chunk is cut by ranges of
the sorted phrases; a continuation is only kept if its last k words are in the
same chunk's trie or belong to another chunk.

Scores are exact: counts stay below 2^53, products are 38-digit decimals.

Defined cases: a null or empty text has no words; a null language counts as
``und``, together with that label itself; repeated rows count as often as they
stand there; a text of any length is one sequence, cut into ``SPAN`` bytes only
while its words are looked up; an empty table or one without frequent phrases
gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stockweave.llm import common as C

MIN_COUNT, MAX_WORDS, TOP = 100, 5, 2000
UNKNOWN = "und"
#: Entries of one broadcast chunk, bytes of text cut into words at once, distinct entries a task holds, positions of one step.
CHUNK, SPAN, HELD, POSITIONS = 1 << 18, 1 << 20, 1 << 20, 1 << 21

#: Fixed by the result contract: pieces end at [.,;:!?\\x0A-\\x0D], words at blank and tab. 0xFF never stands in UTF-8.
BREAK = b"\xff"
TO_WORDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b" " * 11)
TO_PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", BREAK * 10 + b" ")


def _spans(text: bytes) -> Iterator[bytes]:
    """Parts of a text that end at a blank; words and breaks stay whole."""
    at = 0
    while len(text) - at > SPAN:
        end = text.find(b" ", at + SPAN)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def _lower(text: str) -> bytes:
    return text.encode("utf-8", "replace").lower()  # of bytes: A to Z only


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, count) of a task's texts, sent on whenever ``HELD`` words are held."""
    held: dict[str, Counter] = {}

    def flush():
        for lang, counts in held.items():
            words = [w.decode("utf-8") for w in counts]
            if not words:
                continue
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(words), "word": words, "count": pa.array(counts.values(), pa.int64())})
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            counts = held.setdefault(lang, Counter())
            for span in _spans(_lower(text.as_py()).translate(TO_WORDS)):
                counts.update(span.split())
                if sum(map(len, held.values())) > HELD:
                    yield from flush()
                    counts = held.setdefault(lang, Counter())
    yield from flush()


def _numbered(frame: DataFrame, order: list[str]) -> DataFrame:
    """Add chunk and at, a place within it from 0: ranges of the order with about ``CHUNK`` rows each, written. Rows are distinct in the order."""
    rows = C.staged(frame, "phrases")
    chunks = max(1, -(-rows.count() // CHUNK))
    ranged = rows.repartitionByRange(chunks, *order) if chunks > 1 else rows.coalesce(1)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).cast("int")
    return C.staged(ranged.sortWithinPartitions(*order).withColumn("chunk", F.spark_partition_id()).withColumn("at", place), "phrases")


def _chunks(frame: DataFrame) -> list[int]:
    return sorted(r.chunk for r in frame.select("chunk").distinct().collect())


def _encoded(texts: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, ids): the numbers of the words of a batch of texts, with 0 between texts, at breaks and for rare words."""
    spark = texts.sparkSession
    out, chunks = None, _chunks(words)
    for chunk in chunks:
        part = words.filter(F.col("chunk") == chunk).select("lang", "word", "id").toArrow()
        numbers: dict[str, dict[bytes, int]] = {}
        for lang, word, i in zip(part["lang"].to_pylist(), part["word"].to_pylist(), part["id"].to_pylist(), strict=True):
            numbers.setdefault(lang, {})[word.encode()] = i
        shared = spark.sparkContext.broadcast(numbers)

        def run(batches, shared=shared, first=chunk == chunks[0], last=chunk == chunks[-1]):
            for batch in batches:
                if first:
                    rows = zip(batch.column("lang").to_pylist(), batch.column("text"), [None] * len(batch), strict=True)
                else:
                    rows = zip(batch.column("lang").to_pylist(), batch.column("text"), batch.column("ids"), strict=True)
                found: dict[str, list[np.ndarray]] = {}
                one = []
                for lang, text, before in rows:
                    look = shared.value.get(lang, {})
                    parts = []
                    for span in _spans(_lower(text.as_py()).translate(TO_PIECES)):
                        tokens = span.replace(BREAK, b" \xff ").split()
                        parts.append(np.array([look.get(w, 0) for w in tokens], np.int32))
                    ids = np.concatenate([*parts, np.zeros(1, np.int32)])
                    if before is not None:
                        ids = np.maximum(ids, np.frombuffer(before.as_py(), np.int32))
                    if last:
                        found.setdefault(lang, []).append(ids)
                    else:
                        one.append(ids.tobytes())
                if last:
                    for lang, arrays in found.items():
                        yield pa.RecordBatch.from_pydict({"lang": [lang], "ids": [np.concatenate(arrays).tobytes()]})
                else:
                    yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("text"), pa.array(one, pa.binary())], ["lang", "text", "ids"])

        source = texts if out is None else out
        kept = "lang string, ids binary" if chunk == chunks[-1] else "lang string, text string, ids binary"
        out = C.staged(source.mapInArrow(C.released(run), kept), "phrases")
        shared.unpersist()
    return out


class Trie:
    """A double array over phrases of equal length: the state after (state, letter) is base[state] + letter where check agrees.

    A word's number is spelled in ``digits`` bytes, its letters, so no state has more than 256 successors.
    """

    def __init__(self, phrases: np.ndarray):
        """``phrases``: sorted distinct rows of word numbers."""
        self.depth, self.top = phrases.shape[1], int(phrases.max())
        self.digits = max(1, -(-self.top.bit_length() // 8))
        shifts = 8 * np.arange(self.digits - 1, -1, -1)
        letters = ((phrases[:, :, None] >> shifts) & 255).reshape(len(phrases), -1)
        # Nodes level by level: the phrases below a node are one run of the sorted rows.
        parents, last, node, total = [], [], np.zeros(len(phrases), np.int64), 1
        for column in letters.T:
            new = np.ones(len(phrases), bool)
            new[1:] = (node[1:] != node[:-1]) | (column[1:] != column[:-1])
            parents.append(node[new])
            last.append(column[new])
            node = total + np.cumsum(new) - 1
            total += int(new.sum())
        parent, letter = np.concatenate(parents), np.concatenate(last)
        starts = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
        sizes = np.diff(np.append(starts, len(parent)))
        slot, base, free, low = np.zeros(total, np.int64), np.full(total, -(1 << 40)), np.ones(2 * total + 1024, bool), 1
        free[0] = False
        for run in np.argsort(-sizes, kind="stable")[: int((sizes > 1).sum())]:
            a, own = starts[run], letter[starts[run] : starts[run] + sizes[run]]
            steps, place = own - own[0], None
            while place is None:
                if low + 1024 > len(free):
                    free = np.concatenate([free, np.ones(len(free), bool)])
                open_ = np.flatnonzero(free[low : low + 512]) + low
                fits = open_[free[open_[:, None] + steps].all(axis=1)] if len(open_) else open_
                if len(fits):
                    place = int(fits[0])
                else:
                    low += 256  # what stays free below is for the single successors
            base[parent[a]] = place - own[0]
            slot[a + 1 : a + 1 + len(own)] = place + steps
            free[place + steps] = False
        ones = starts[sizes == 1]
        holes = np.flatnonzero(free)[: len(ones)]
        holes = np.concatenate([holes, len(free) + np.arange(len(ones) - len(holes))])
        slot[ones + 1] = holes
        base[parent[ones]] = holes - letter[ones]
        self.base, self.check, self.place = (np.full(int(slot.max()) + 1, empty, np.int64) for empty in (-(1 << 40), -1, -1))
        self.base[slot] = base
        self.check[slot[1:]] = slot[parent]
        self.place[slot[node]] = np.arange(len(phrases))  # of a whole phrase: its row

    def walk(self, ids: np.ndarray) -> np.ndarray:
        """For each position the row of the phrase that starts there, or -1."""
        out = np.full(len(ids), -1, np.int64)
        known = (ids > 0) & (ids <= self.top)
        at = np.flatnonzero(known[: max(0, len(ids) - self.depth + 1)])
        state = np.zeros(len(at), np.int64)
        for k in range(self.depth):
            word = ids[at + k]
            for shift in range(8 * (self.digits - 1), -1, -8):
                to = self.base[state] + ((word >> shift) & 255)
                inside = (to >= 0) & (to < len(self.check))
                to[~inside] = 0  # the root follows from nothing
                inside &= self.check[to] == state
                at, state, word = at[inside], to[inside], word[inside]
            if k + 1 < self.depth:
                more = known[at + k + 1]
                at, state = at[more], state[more]
        out[at] = self.place[state]
        return out


def _pass(encoded: DataFrame, trie: Trie, sole: bool, go_on: bool) -> DataFrame:
    """One step of all positions: rows (at, word, count), with word 0 for the phrase itself and else for its continuation."""
    shared = encoded.sparkSession.sparkContext.broadcast(trie)

    def run(batches):
        trie = shared.value
        counts = np.zeros(len(trie.place), np.int64)
        held, size = [], 0

        def sums():
            codes, n = np.concatenate([c for c, _ in held]), np.concatenate([n for _, n in held])
            order = np.argsort(codes, kind="stable")
            codes, n = codes[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            return codes[first], np.add.reduceat(n, first)

        def rows(codes, n):
            for a in range(0, len(codes), 1 << 16):
                c = codes[a : a + (1 << 16)]
                yield pa.RecordBatch.from_pydict({"at": (c >> 32).astype(np.int32), "word": (c & 0xFFFFFFFF).astype(np.int32), "count": n[a : a + (1 << 16)]})

        for batch in batches:
            for packed in batch.column("ids"):
                ids = np.frombuffer(packed.as_buffer(), np.int32)
                # Steps overlap by the words that a phrase and its continuation reach on.
                for a in range(0, len(ids), POSITIONS):
                    part = ids[a : a + POSITIONS + trie.depth]
                    found = trie.walk(part)
                    own = found[:POSITIONS]
                    counts += np.bincount(own[own >= 0], minlength=len(counts))
                    if not go_on:
                        continue
                    at = np.flatnonzero(own >= 0)
                    at = at[at + trie.depth < len(part)]
                    then = part[at + trie.depth]
                    good = then > 0
                    if sole:
                        good &= found[at + 1] >= 0
                    if not good.any():
                        continue
                    codes, n = np.unique((own[at[good]] << 32) | then[good], return_counts=True)
                    held.append((codes, n))
                    size += len(codes)
                    if size > HELD:
                        codes, n = sums()
                        held, size = [(codes, n)], len(codes)
                        if size > HELD // 2:
                            yield from rows(codes, n)
                            held, size = [], 0
        whole = np.flatnonzero(counts)
        yield from rows(whole << 32, counts[whole])
        if held:
            yield from rows(*sums())

    return encoded.mapInArrow(C.released(run), "at int, word int, count bigint")


def _level(encoded: DataFrame, phrases: DataFrame, depth: int, go_on: bool) -> tuple[DataFrame, DataFrame]:
    """Counts of the phrases (chunk, at, f), and candidates of the next level (chunk, at, next)."""
    chunks, out = _chunks(phrases), []
    for chunk in chunks:
        own = phrases.filter(F.col("chunk") == chunk).select("at", "words").toArrow().sort_by("at")
        flat = own["words"].combine_chunks().flatten().to_numpy().reshape(-1, depth)
        # A phrase's last words end a continuation's: with all phrases in one trie the second half of Apriori is at hand.
        rows = _pass(encoded, Trie(flat), len(chunks) == 1, go_on)
        sums = rows.groupBy("at", "word").agg(F.sum("count").alias("f")).filter(f"word = 0 or f >= {MIN_COUNT}")
        out.append(C.staged(sums.withColumn("chunk", F.lit(chunk)), "phrases"))
    both = out[0]
    for more in out[1:]:
        both = both.unionByName(more)
    return both.filter("word = 0").drop("word"), both.filter("word > 0").withColumnRenamed("word", "next").drop("f")


def frequent(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) for all phrases of up to ``MAX_WORDS`` words that occur ``MIN_COUNT`` times; (lang, n) of all words."""
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).cast("string").alias("text")).filter("text <> ''")
    counted = C.staged(
        texts.mapInArrow(C.released(_word_rows), "lang string, word string, count bigint").groupBy("lang", "word").agg(F.sum("count").alias("f")), "phrases"
    )
    totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    words = _numbered(counted.filter(F.col("f") >= MIN_COUNT), ["lang", "word"])
    # Numbers follow the sorted order, so that sorting by numbers and chunks agree.
    sizes = {r.chunk: r["count"] for r in words.groupBy("chunk").count().collect()}
    start, starts = 1, {}
    for chunk in sorted(sizes):
        starts[chunk], start = start, start + sizes[chunk]
    found = words.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), "f")
    if not starts:
        return found, totals
    begins = F.element_at(F.create_map(*[F.lit(x) for pair in starts.items() for x in pair]), F.col("chunk"))
    words = words.withColumn("id", (F.col("at") + begins).cast("int"))
    encoded = _encoded(texts, words)
    level = words.select("lang", F.col("word").alias("phrase"), F.array("id").alias("words"), "chunk", "at")
    for depth in range(1, MAX_WORDS + 1):
        counts, more = _level(encoded, level, depth, depth < MAX_WORDS)
        if depth > 1:
            both = level.join(counts, ["chunk", "at"])
            found = found.unionByName(both.select("lang", "phrase", F.lit(depth).alias("size"), "f").filter(F.col("f") >= MIN_COUNT))
        if depth == MAX_WORDS:
            break
        grown = level.join(more, ["chunk", "at"]).drop("chunk", "at").join(words.select(F.col("id").alias("next"), "word"), "next")
        grown = grown.select("lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), F.concat("words", F.array("next")).alias("words"))
        level = _numbered(grown, ["words"])
        if not level.take(1):
            break
    return C.staged(found, "phrases"), totals


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases."""
    known, totals = frequent(docs, text, lang)
    longer = known.filter("size > 1")
    # One word less at either end: counts only fall as a phrase grows, so the next size up decides.
    inner = longer.filter("size > 2").select(
        "lang", F.col("f").alias("outer"),
        F.expr("explode(array(substring_index(phrase, ' ', size - 1), substring_index(phrase, ' ', 1 - size)))").alias("phrase"),
    ).groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    kept = longer.join(inner, ["lang", "phrase"], "left").filter("outer is null or 100 * outer < 100 * f")
    cuts = kept.select("lang", "phrase", "size", F.col("f").alias("a"), "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("left"), F.expr("substring_index(phrase, ' ', k - size)").alias("right"),
    )
    scored = (
        cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
        .join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
        .join(totals, "lang")
        .withColumn("score", F.expr("(cast(1000 * a as decimal(19, 0)) * cast(n as decimal(18, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))"))
    )
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    flat = lowest.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return flat.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def report(docs: DataFrame) -> DataFrame:
    return collocations(docs)
