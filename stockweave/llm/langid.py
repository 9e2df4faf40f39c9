"""Language identification by cross-parsing.

A suffix automaton holds every substring of a language's training text. A text
is cut greedily into the longest phrases the automaton knows; the language
that needs the fewest describes the text best. A phrase has one price in all
languages, that of a pointer into all training texts together, and a letter a
language does not know costs a phrase: little training text is no advantage.
Texts are folded to letters in lower case and parsed in blocks
of ``BLOCK`` characters, so many blocks step through the automata side by side
and a very long text is only more blocks.

The training text is a bounded sample: at most ``SAMPLE_DOCS`` documents per
language, chosen by hash, ``SAMPLE_CHARS`` folded characters of each. It is broadcast
(languages * SAMPLE_DOCS * SAMPLE_CHARS characters, for at most
``MAX_LANGUAGES`` languages, the most frequent; rarer ones are never told) and each Python worker builds
the automata once.

Defined cases: a null text and a text without a letter are ``und`` with score
0; so is every text if there is no training text; ties go to the language
first in code-point order; rows are judged one by one.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stockweave.llm import common as C

SAMPLE_DOCS = 64
SAMPLE_CHARS = 768
MAX_LANGUAGES = 200
BLOCK = 256
BLOCKS_AT_ONCE = 8192
ROWS_AT_ONCE = 1024
UNDETERMINED = "und"


def fold(text: str) -> str:
    """Letters in lower case, and one space for each run of anything else: marks and digits say nothing of the language."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


@lru_cache(maxsize=1)
def _lower() -> np.ndarray:
    """Code point -> lower-case letter, or a space where the character is no letter."""
    small = (chr(i).lower() if chr(i).isalpha() else " " for i in range(sys.maxunicode + 1))
    return np.fromiter((ord(c[0]) for c in small), dtype=np.uint32, count=sys.maxunicode + 1)


def held_out(key: Column, folds: int = 5) -> Column:
    """Whether the key falls into fold 0 of the CRC-32 of its text; a null key does."""
    return F.coalesce(F.crc32(key.cast("string")) % folds, F.lit(0)) == 0


def sample(docs: DataFrame, docs_per_language: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS, languages: int = MAX_LANGUAGES) -> dict[str, str]:
    """Training text per language from columns doc_id, text, lang; held-out documents are never read.

    Only the hash of the key picks documents, so the sample does not depend on
    how the table is split.
    """
    labelled = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    common = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).select("lang")
    marked = labelled.join(common, "lang", "left_semi").select("lang", F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("t"), "text")
    first = Window.partitionBy("lang").orderBy("h", "t")
    nth = F.row_number().over(first)
    # The documents are chosen before any text is folded or moved.
    picked = marked.select("lang", "h", "t").withColumn("n", nth).filter(F.col("n") <= docs_per_language).select("lang", "h", "t").distinct()
    chosen = marked.join(F.broadcast(picked), ["lang", "h", "t"], "left_semi")  # languages * docs_per_language rows
    letters = F.substring(F.trim(F.regexp_replace("text", r"[^\p{L}]+", " ")), 1, chars)
    short = chosen.select("lang", "h", "t", letters.alias("letters"))
    rows = short.withColumn("n", nth).filter(F.col("n") <= docs_per_language).orderBy("lang", "n").collect()
    texts: dict[str, list[str]] = {}
    for r in rows:
        texts.setdefault(r["lang"], []).append(fold(r["letters"])[:chars])
    return {lang: " ".join(parts) for lang, parts in sorted(texts.items())}


def _automaton(codes: list[int], letters: int) -> np.ndarray:
    """Transition table of the suffix automaton: state x letter -> state, -1 where no substring goes on; a last row of -1."""
    size = 2 * len(codes) + 2
    step = np.full((size, letters), -1, dtype=np.int32)
    link, length = [-1] * size, [0] * size
    states, last = 1, 0
    for c in codes:
        new, states = states, states + 1
        length[new] = length[last] + 1
        at = last
        while at != -1 and step[at, c] < 0:
            step[at, c] = new
            at = link[at]
        if at == -1:
            link[new] = 0
        else:
            to = int(step[at, c])
            if length[at] + 1 == length[to]:
                link[new] = to
            else:
                copy, states = states, states + 1
                length[copy], link[copy] = length[at] + 1, link[to]
                step[copy] = step[to]
                while at != -1 and step[at, c] == to:
                    step[at, c] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return step[: states + 1]


class Parser:
    """The automata of all languages over one alphabet; letter 0 stands for characters no training text has."""

    def __init__(self, texts: dict[str, str]):
        self.languages = sorted(texts)
        alphabet = sorted({ord(c) for t in texts.values() for c in t} | {ord(" ")})
        self.letters = len(alphabet) + 1
        known = np.zeros(sys.maxunicode + 1, dtype=np.uint16)
        known[alphabet] = np.arange(1, self.letters)
        self.codes, self.space = known[_lower()], int(known[ord(" ")])
        self.tables = [_automaton(known[_points(texts[k])].tolist(), self.letters).ravel() for k in self.languages]

    def read(self, text: str) -> np.ndarray:
        """The folded text as letters of the alphabet."""
        letters = self.codes[_points(text)]
        gap = letters == self.space
        return letters[~(gap & np.roll(gap, 1))] if len(letters) > 1 else letters

    def phrases(self, blocks: np.ndarray) -> np.ndarray:
        """Phrases each language needs for each row of ``blocks``, longest first (letters, -1 past the end)."""
        out = np.zeros((len(blocks), len(self.languages)))
        columns = np.ascontiguousarray(blocks.T)
        for k, table in enumerate(self.tables):
            # The last state goes nowhere: a block begins there, and so does what follows a letter this language lacks.
            none = len(table) // self.letters - 1
            state, count = np.full(len(blocks), none, dtype=np.int32), np.zeros(len(blocks), dtype=np.int32)
            for column in columns:
                alive = len(column) if column[-1] >= 0 else int(np.count_nonzero(column >= 0))
                c, s = column[:alive], state[:alive]
                to = table[s * self.letters + c]
                stuck = to < 0
                count[:alive] += stuck
                # A phrase ends before the letter that does not fit; that letter starts the next one.
                start = table[c]
                state[:alive] = np.where(stuck, np.where(start < 0, none, start), to)
            out[:, k] = count
        return out

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        known = [False] * len(texts)
        totals = np.zeros((len(texts), max(1, len(self.languages))))
        waiting: list[tuple[int, np.ndarray]] = []
        held = 0
        for i, t in enumerate(texts):
            letters = self.read(t) if t and self.languages else self.codes[:0]
            known[i] = bool((letters != self.space).any())
            if not known[i]:
                continue
            waiting.append((i, letters))
            held += len(letters) // BLOCK + 1
            if held >= BLOCKS_AT_ONCE:
                self._count(waiting, totals)
                waiting, held = [], 0
        if waiting:
            self._count(waiting, totals)
        langs, scores = [], []
        for i in range(len(texts)):
            if not known[i]:
                langs.append(UNDETERMINED)
                scores.append(0.0)
                continue
            order = np.argsort(totals[i], kind="stable")
            langs.append(self.languages[order[0]])
            scores.append(float(1 - totals[i][order[0]] / totals[i][order[1]]) if len(order) > 1 else 1.0)
        return langs, scores

    def _count(self, waiting: list[tuple[int, np.ndarray]], totals: np.ndarray) -> None:
        parts, owners = [], []
        for i, letters in waiting:
            for at in range(0, len(letters), BLOCK):
                parts.append(letters[at : at + BLOCK])
                owners.append(i)
        lengths = np.array([len(p) for p in parts])
        order = np.argsort(-lengths, kind="stable")
        for at in range(0, len(order), BLOCKS_AT_ONCE):
            rows = order[at : at + BLOCKS_AT_ONCE]
            blocks = np.full((len(rows), int(lengths[rows[0]])), -1, dtype=np.int32)
            for r, j in enumerate(rows):
                blocks[r, : lengths[j]] = parts[j]
            np.add.at(totals, np.asarray(owners)[rows], self.phrases(blocks))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


@lru_cache(maxsize=1)
def _parser(texts: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(dict(texts))


def predict(docs: DataFrame, training: dict[str, str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every whole text; reads nothing but the text."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(tuple(sorted(training.items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(shared.value)
        for batch in _slices(batches):
            langs, scores = parser.judge(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(C.released(run), f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the labelled documents outside fold 0 and predict all: doc_id, held_out, lang_pred, score."""
    return predict(docs, sample(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, min_score: float = 0.0) -> DataFrame:
    """The documents that are not undetermined, with the columns of ``docs``; texts without a letter go.

    At ``min_score`` 0 nothing else goes: the parse names the best language of
    any text with a letter, however badly that describes it. A higher one
    rejects texts that the second-best language describes almost as well.
    Without any training text nothing is learned, and only texts without a
    letter go.
    """
    training = sample(docs)
    if not training:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    shared = docs.sparkSession.sparkContext.broadcast(tuple(sorted(training.items())))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(shared.value)
        for batch in _slices(batches):
            langs, scores = parser.judge(batch.column(names.index("text")).to_pylist())
            yield batch.filter(pa.array([k != UNDETERMINED and s >= min_score for k, s in zip(langs, scores, strict=True)], pa.bool_()))
        _parser.cache_clear()  # other stages follow in the same worker

    return docs.mapInArrow(C.released(run), docs.schema)
