"""Token counts: batch encoding in Arrow tasks that hand back lengths only.

A text is cut where no token can reach across. For a byte-level vocabulary
whose pattern lets a blank only begin a match, every blank after a character
that is not white space is such a place; so are a line break after one, and a
stop after a letter or digit. The counts of the pieces then add up to that of
the whole text, so each distinct piece is encoded once and its length kept.
New pieces go to the library in batches of ``ENCODE_BYTES``; texts are taken
in groups of ``GROUP_BYTES``, and longer texts are cut at safe places into
spans of that size, so a worker never holds the pieces of a long text at once.
Vocabularies without safe places, and sentencepiece models, get whole texts in
batches of the same size. A worker keeps the lengths for its later tasks, at
most two generations of ``KEPT`` pieces of at most ``KEPT_CHARS`` characters.

Special strings inside texts count as the library counts them by default; no
begin, end or added special tokens, no truncation, no padding.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows
each keep their row; nulls in other columns pass through; input columns named
like a result column are replaced; an empty table gives an empty result; one
unbroken word is one piece, whatever its length.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from stockweave.llm import common as C

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 1024
#: Bytes of text taken at once, and bytes that the library gets in one call.
GROUP_BYTES, ENCODE_BYTES = 1 << 22, 1 << 18
KEPT, KEPT_CHARS = 1 << 19, 64
#: Safe blanks, and the further safe places within a piece. Python takes for white space all that the pattern does.
SAFE = re.compile(r"(?<=\S) ")
FINE = re.compile(r"(?=[\n.,;:!?])(?:(?<=\S)(?=\n)|(?<=[0-9A-Za-zÀ-ÖØ-öø-ÿ])(?=[.,;:!?]))")
RESULT = ("n_bytes", "n_tokens", "over_limit")


def divisible(vocabulary: dict) -> bool:
    """Whether counts add up over pieces cut at ``SAFE`` and ``FINE``: byte level, its own pattern, no change of the text before."""
    cut = vocabulary.get("pre_tokenizer") or {}
    return (
        cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
        and vocabulary.get("normalizer") is None and vocabulary.get("post_processor") is None
        and all(not (a["lstrip"] or a["rstrip"] or a["single_word"]) and not set(" \n.,;:!?") & set(a["content"]) for a in vocabulary.get("added_tokens", []))
    )


class Counter:
    """Token counts of texts by the vocabulary in a file."""

    def __init__(self, file: str):
        self.pieces = False
        if file.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=file)
            self.lengths = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        else:
            # Spark's tasks are the parallelism; the library reads this when it first encodes.
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(file)
            model.no_truncation()
            model.no_padding()
            with open(file, encoding="utf-8") as f:
                self.pieces = divisible(json.load(f))
            self.lengths = lambda texts: [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]
        #: Counts by piece, without and with a blank before it; and those of the generation before.
        self.known: tuple[dict, dict] = ({}, {})
        self.older: tuple[dict, dict] = ({}, {})

    def age(self) -> None:
        """Begin a new generation when this one is full; long pieces are not kept."""
        if len(self.known[0]) + len(self.known[1]) > KEPT:
            self.older = tuple({p: n for p, n in d.items() if len(p) <= KEPT_CHARS} for d in self.known)
            self.known = ({}, {})

    def batches(self, texts: list[str]) -> Iterator[list[str]]:
        """The texts in runs of about ``ENCODE_BYTES``."""
        run, size = [], 0
        for t in texts:
            run.append(t)
            size += len(t.encode("utf-8", "replace"))
            if size >= ENCODE_BYTES:
                yield run
                run, size = [], 0
        if run:
            yield run

    def unknown(self, pieces: set[str], blank: int) -> list[str]:
        known, older, out = self.known[blank], self.older[blank], []
        for p in pieces:
            if p in known:
                continue
            n = older.get(p)
            if n is None:
                out.append(p)
            else:
                known[p] = n
        return out

    def learn(self, pieces: set[str], blank: int) -> None:
        before = " " if blank else ""
        cut = {p: FINE.split(before + p) for p in self.unknown(pieces, blank)}
        first = {parts[0][blank:] for parts in cut.values()}
        for part, at in ((first, blank), ({q for parts in cut.values() for q in parts[1:]}, 0)):
            for run in self.batches(self.unknown(part, at)):
                self.known[at].update(zip(run, self.lengths([" " + p for p in run] if at else run), strict=True))
        whole, rest = self.known[blank], self.known[0]
        for p, parts in cut.items():
            if len(parts) > 1:
                whole[p] = whole[parts[0][blank:]] + sum([rest[q] for q in parts[1:]])

    def spans(self, text: str) -> Iterator[tuple[bool, str]]:
        """Parts of a text between safe blanks, and whether a blank stood before; only texts over ``GROUP_BYTES`` have several."""
        at, after = 0, False
        while len(text) - at > GROUP_BYTES:
            cut = SAFE.search(text, at + GROUP_BYTES)
            if cut is None:
                break
            yield after, text[at : cut.start()]
            at, after = cut.end(), True
        yield after, text[at:] if at else text

    def cut(self, texts: pa.Array, after: np.ndarray) -> np.ndarray:
        """Token counts of texts cut at every blank; ``after`` marks those that a blank stood before."""
        self.age()
        lists = pc.split_pattern(texts, " ")
        starts = lists.offsets.to_numpy()[:-1]
        coded = lists.values.dictionary_encode()
        at, pieces = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        # Where a piece is empty or ends in white space, the blank behind it is no safe place: those texts go another way.
        open_ = np.fromiter((not p or p[-1].isspace() for p in pieces), bool, len(pieces))[at]
        open_[lists.offsets.to_numpy()[1:] - 1] = False
        bad = np.add.reduceat(open_, starts) > 0
        head = np.zeros(len(at), bool)
        head[starts[~after]] = True
        self.learn(set(pieces), 1)
        sizes = np.fromiter(map(self.known[1].__getitem__, pieces), np.int64, len(pieces))[at]
        first = [pieces[k] for k in at[head]]
        self.learn(set(first), 0)
        sizes[head] = np.fromiter(map(self.known[0].__getitem__, first), np.int64, len(first))
        out = np.add.reduceat(sizes, starts)
        for i in np.flatnonzero(bad):
            parts = SAFE.split(texts[i].as_py())
            h = [] if after[i] else [parts.pop(0)]
            self.learn(set(parts), 1)
            self.learn(set(h), 0)
            out[i] = sum(map(self.known[1].__getitem__, parts)) + sum(map(self.known[0].__getitem__, h))
        return out

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Token counts of texts without nulls."""
        size = pc.binary_length(texts).to_numpy()
        if not self.pieces:
            runs = self.batches(texts.to_pylist())
            return np.fromiter((n for run in runs for n in self.lengths(run)), np.int64, len(texts))
        out, at = np.zeros(len(texts), np.int64), 0
        while at < len(texts):
            end = at + max(1, int(np.searchsorted(np.cumsum(size[at:]), GROUP_BYTES, "right")))
            if size[at] > GROUP_BYTES:
                out[at] = sum(int(self.cut(pa.array([span]), np.array([after]))[0]) for after, span in self.spans(texts[at].as_py()))
            else:
                out[at:end] = self.cut(texts.slice(at, end - at), np.zeros(end - at, bool))
            at = end
        return out


@lru_cache(maxsize=1)
def _counter(file: str) -> Counter:
    return Counter(file)


def count(docs: DataFrame, file: str = FILE, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """The columns of ``docs`` but ``text``, and n_bytes (UTF-8), n_tokens, over_limit (more tokens than ``limit``)."""
    kept = [c for c in docs.columns if c not in (text, *RESULT)]
    whole = F.col(text).cast("string")
    rows = docs.select(*kept, F.coalesce(F.octet_length(whole), F.lit(0)).cast("long").alias("n_bytes"), whole.alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(file)
        for batch in batches:
            n = pa.array(counter.counts(pc.fill_null(batch.column("__text"), "")), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*kept, "n_bytes")), n], [*kept, "n_bytes", "n_tokens"])

    schema = rows.drop("__text").schema.add("n_tokens", T.LongType())
    return rows.mapInArrow(C.released(run), schema).withColumn("over_limit", F.col("n_tokens") > limit)
