"""SentencePiece encoding and decoding with shared-prefix forward tables.

A text is cut into marked words: a word with the mark of the space before it.
No piece joins a letter to a following mark, so words are encoded one by one.
The distinct words of a batch are sorted, which lists a trie depth first, and
the forward table of a common prefix is kept for the next word.

The model merges pairs by score, so the forward value of a prefix is not a sum
to maximise but the last piece of that prefix's encoding: the one known piece
ending there that stands stably after the last piece of what is before it.
Following these back from a word's end gives exactly the merged encoding; each
prefix is computed once. Words with several marks before them (equal scores,
ties from the left) are merged directly.

The model file is a parameter; the driver reads it and broadcasts its bytes
(fixed size). Nothing is trained.

Defined cases: a null text has null ids and decodes to null; an empty text has
no ids; characters outside the vocabulary become byte pieces; a literal mark
(U+2581) decodes as a space, as in the model's own decoder; every row is
encoded by itself, whatever its length, and equal rows give equal rows; a word
of any length costs n log n at most; an empty table gives an empty result; an
input column ``ids`` is replaced by the result's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from stockweave.llm import common as C

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Words in the newer half of a worker's table; when it is full it becomes the older half, whose used words come back.
KEPT_WORDS = 120_000
KEPT_PAIRS = 200_000
#: Words up to this length are merged without a heap.
SHORT_WORD = 32
#: Rows encoded before their ids are handed on.
ROWS_AT_ONCE = 512

#: Fixed by the model format: kinds of pieces.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class _Packed(dict):
    """Pieces with their ids as 32-bit numbers; other characters are spelled when asked for."""

    def __missing__(self, part: str) -> bytes:
        return self.spell(part)


class Pieces:
    """Vocabulary, encoder and decoder of one model."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm, train = proto.normalizer_spec, proto.trainer_spec
        if train.model_type != train.BPE or not train.byte_fallback or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("needs a merging model with byte fallback and no normalisation")
        self.prefix = MARK if norm.add_dummy_prefix else ""
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes, self.unknown = [0] * 256, train.unk_id
        self.spelled: list[bytes] = []
        for i, p in enumerate(proto.pieces):
            spelled = p.piece.replace(MARK, " ").encode()
            if p.type in (NORMAL, UNUSED, USER_DEFINED):
                if p.type == USER_DEFINED:
                    raise ValueError("user-defined pieces are not supported")
                if MARK in p.piece.lstrip(MARK):
                    raise ValueError("pieces must not span words")
                self.ids[p.piece], self.scores[p.piece] = i, p.score
            elif p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.bytes[value], spelled = i, bytes([value])
            else:
                spelled = b" \xe2\x81\x87 " if p.type == UNKNOWN else b""
            self.spelled.append(spelled)
        self.cut = self.starts = self.begin = None
        self.states: dict[str, tuple] = {}
        self.pairs: dict[str, dict[str, bool]] = {}  # by the right piece, then the left one
        self.n_pairs = 0
        self.packed = _Packed({p: pack("=i", i) for p, i in self.ids.items()})
        self.packed.spell = self._spell
        self.words: dict[str, bytes] = {}  # ids as 32-bit numbers
        self.older: dict[str, bytes] = {}

    def _ready(self) -> None:
        """What only encoding needs."""
        letters = {c for p in self.ids for c in p}
        alone = "".join(c for c in "\n\t\r\x0b\x0c" if c not in letters)
        self.cut = re.compile(f"{MARK}*[^{MARK}{re.escape(alone)}]+|{MARK}+" + (f"|[{re.escape(alone)}]" if alone else ""))
        self.starts = {p[:n] for p in self.ids for n in range(len(p) + 1)}
        self.begin = self._state("")

    def _state(self, read: str) -> tuple[dict, list]:
        """What is known after reading: by the next character the state that follows, if met yet; the pieces ending here.

        ``read`` is the longest end of what was read that some piece starts with,
        so all pieces of several characters that end here are ends of it. They
        come longest first, each with its length and the left pieces it was tried with.
        """
        known = self.states.get(read)
        if known is None:
            ends = [read[n:] for n in range(len(read) - 1)]
            pieces = [(p, len(p), self.pairs.setdefault(p, {})) for p in ends if p in self.ids and p.strip(MARK)]
            known = self.states[read] = ({}, pieces, read)
        return known

    def _step(self, state: tuple, letter: str) -> tuple:
        """The state after one more character; at most one for each start of a piece, so their number is bounded."""
        read = state[2] + letter
        while read not in self.starts:
            read = read[1:]
        follows = self._state(read)
        if letter in self.starts:
            state[0][letter] = follows
        return follows

    def merge(self, word: str) -> list[str]:
        """Pieces and unknown characters of a word by merging the best pair, leftmost first."""
        if len(word) > SHORT_WORD:
            return self.merge_long(word)
        parts, scores = list(word), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = scores.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def merge_long(self, word: str) -> list[str]:
        """As ``merge``, with the pairs in a heap: n log n instead of the square."""
        parts: list[str | None] = list(word)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        scores, heap = self.scores, []
        for k in range(len(parts) - 1):
            s = scores.get(parts[k] + parts[k + 1])
            if s is not None:
                heap.append((-s, k, parts[k], parts[k + 1]))
        heapify(heap)
        while heap:
            _, k, left, right = heappop(heap)
            n = after[k]
            # A pair whose parts have been merged since is out of date; a merged part is longer, so it never looks the same.
            if parts[k] != left or n == len(parts) or parts[n] != right:
                continue
            parts[k], parts[n] = left + right, None
            after[k] = after[n]
            if after[n] < len(parts):
                before[after[n]] = k
            for at in (before[k], k):
                if at >= 0 and after[at] < len(parts):
                    s = scores.get(parts[at] + parts[after[at]])
                    if s is not None:
                        heappush(heap, (-s, at, parts[at], parts[after[at]]))
        return [p for p in parts if p is not None]

    def stable(self, left: str, right: str) -> bool:
        """Whether merging leaves the two pieces as they are when they meet; ``left`` is empty at a word's start."""
        known = self.pairs.setdefault(right, {}).get(left)
        if known is None:
            if self.n_pairs >= KEPT_PAIRS:
                for tried in self.pairs.values():
                    tried.clear()
                self.n_pairs = 0
            known = self.pairs[right][left] = self.merge(left + right) == ([left, right] if left else [right])
            self.n_pairs += 1
        return known

    def _ids(self, parts: list[str]) -> bytes:
        packed = self.packed
        return b"".join([packed[p] for p in parts])

    def _spell(self, part: str) -> bytes:
        """The bytes of an unknown character."""
        spelled = part.encode("utf-8", "replace")
        return pack(f"={len(spelled)}i", *[self.bytes[b] for b in spelled])

    def learn(self, words: set[str]) -> None:
        """Put the encodings of the words into ``self.words``, walking them in sorted order."""
        if len(self.words) > KEPT_WORDS:
            self.older, self.words = self.words, {}
        stable, older, step, packed = self.stable, self.older, self._step, self.packed
        # last[i]: the last piece of the encoding of path[:i]; states[i]: the state after path[:i].
        path, last, states = "", [""], [self.begin]
        for word in sorted(words - self.words.keys()):
            if word in older:
                self.words[word] = older[word]
                continue
            if word.startswith(MARK * 2):
                self.words[word] = self._ids(self.merge(word))
                continue
            same = 0
            for a, b in zip(path, word):
                if a != b:
                    break
                same += 1
            del last[same + 1 :], states[same + 1 :]
            state = states[same]
            for end, piece in enumerate(word[same:], same + 1):
                state = state[0].get(piece) or step(state, piece)
                for longer, size, tried in state[1]:
                    left = last[end - size]
                    fits = tried.get(left)
                    if fits or fits is None and stable(left, longer):
                        piece = longer
                        break
                last.append(piece)
                states.append(state)
            path = word
            parts, end = [], len(word)
            while end:
                piece = last[end]
                parts.append(packed[piece])
                end -= len(piece)
            parts.reverse()
            self.words[word] = b"".join(parts)

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray | None]:
        if self.cut is None:
            self._ready()
        cut = [self.cut.findall(self.prefix + t.replace(" ", MARK)) if t else [] for t in texts]
        self.learn(set().union(*cut))
        known = self.words
        for t, words in zip(texts, cut, strict=True):
            yield None if t is None else np.frombuffer(b"".join([known[w] for w in words]), dtype=np.int32)

    def decode(self, ids) -> str:
        spelled = self.spelled
        text = b"".join([spelled[i] for i in ids])
        if self.prefix and text[:1] == b" ":
            text = text[1:]
        return text.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _pieces(model: bytes) -> Pieces:
    return Pieces(model)


def _shared(df: DataFrame, model: str):
    with open(model, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, model: str = MODEL, text: str = "text", decoded: str | None = None) -> DataFrame:
    """The columns of ``docs`` but ``text``, and ``ids``, the piece ids of the whole text.

    With ``decoded`` also a column of that name, the text the ids stand for: the
    worker that made the ids decodes them, so no second one holds the model.
    """
    shared = _shared(docs, model)
    more = [decoded] if decoded else []
    kept = [c for c in docs.columns if c not in (text, "ids", *more)]
    rows = docs.select(*kept, F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(shared.value)
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                ids = list(pieces.encode(part.column("__text").to_pylist()))
                flat = np.concatenate([doc for doc in ids if doc is not None] or [np.zeros(0, np.int32)])
                ends = np.cumsum([0] + [0 if doc is None else len(doc) for doc in ids]).astype(np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32(), mask=np.array([doc is None for doc in ids] + [False])), pa.array(flat, pa.int32())
                )
                back = [pa.array([None if doc is None else pieces.decode(doc.tolist()) for doc in ids], pa.string()) for _ in more]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), lists, *back], [*kept, "ids", *more])
        # The worker lives on for other tasks, maybe of other stages: it keeps the pairs only.
        pieces.words, pieces.older = {}, {}

    schema = rows.select(*kept).schema.add("ids", T.ArrayType(T.IntegerType()))
    for name in more:
        schema = schema.add(name, T.StringType())
    return rows.mapInArrow(C.released(run), schema)


def decode(encoded: DataFrame, model: str = MODEL, ids: str = "ids", into: str = "text") -> DataFrame:
    """The columns of ``encoded`` and ``into``, the text its ids stand for."""
    shared = _shared(encoded, model)
    kept = [c for c in encoded.columns if c != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(shared.value)
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                texts = [pieces.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in part.column(ids)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(texts, pa.string())], [*kept, into])

    return encoded.mapInArrow(C.released(run), encoded.select(*kept).schema.add(into, T.StringType()))


def round_trip(docs: DataFrame, model: str = MODEL, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text: doc_id, n_tokens, ids_sha256 (ids in decimal, commas between), round_trip."""
    rows = docs.select(F.col(key).alias("doc_id"), F.sha2(F.col(text), 256).alias("__before"), F.col(text).alias("__in"))
    back = encode(rows, model, "__in", decoded="__out")
    return back.select(
        "doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.col("__before").eqNullSafe(F.sha2(F.col("__out"), 256)).alias("round_trip"),
    )
