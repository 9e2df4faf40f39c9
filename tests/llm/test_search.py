"""Hard negatives, phrase collocations and token counts against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stockweave.llm import negatives, oracle, phrases, tokens
from tests.llm import odd

VECTORS = "vec_id long, embedding array<float>, label int"


def _mined(rows):
    sound = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        shifted = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        sound.append((i, shifted, [math.floor(256 * float(np.float32(x))) for x in v]))
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    out = []
    for k, a in enumerate(sound):
        if a[0] is None or a[0] % 100:
            continue
        order = lambda rows: sorted(rows, key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        for p, pid in order([(score(a, b), b[0]) for j, b in enumerate(sound) if j != k and b[1] == a[1]])[:5]:
            inside = order([(score(a, b), b[0]) for b in sound if b[1] != a[1] and 30 * p <= 100 * score(a, b) <= 90 * p])[:10]
            out += [(a[0], pid, n + 1, i, p, s) for n, (s, i) in enumerate(inside)]
    return sorted(out, key=repr)


def _vectors(seed=1, n=400, dim=7):
    r = random.Random(seed)
    rows = [(i, [r.gauss(0, 1) for _ in range(dim)], r.choice([0, 1, 2, 9])) for i in range(n)]
    same = [0.5] * dim
    rows += [(1000 + i, same, i % 3) for i in range(150)] + [(200, same, 1), (200, same, 1), (None, same, 1), (None, same, 2)]
    rows += [(2000, None, 1), (2100, [1.0, None], 1), (2200, [math.nan] * dim, 1), (2300, [math.inf] * dim, 2), (2400, same, None)]
    return rows + [(2500, [], 3), (2600, [3.0], 2), (2700, [0.0] * dim, 2), (2800, [1.0] * (dim + 4), 0), (2900, [40_000.0] * dim, 0)]


def _report(spark, rows):
    df = spark.createDataFrame(rows, VECTORS).repartition(3).withColumns({c: F.lit("x") for c in ("id", "row", "w", "shard", "block", "vec", "rank")})
    out = negatives.report(df)
    assert [f"{c} {t}" for c, t in out.dtypes] == [
        "anchor_id bigint", "positive_id bigint", "rank int", "negative_id bigint", "positive_score bigint", "negative_score bigint"
    ]
    return sorted([tuple(r) for r in out.collect()], key=repr)


def test_negatives_of_odd_rows(spark):
    assert _report(spark, _vectors()) == _mined(_vectors())
    assert _report(spark, []) == []


def test_negatives_over_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SHARD_ROWS", 60)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 3)
    monkeypatch.setattr(negatives, "SAMPLE", 100)
    monkeypatch.setattr(negatives, "WAVE_ROWS", 4)
    assert _report(spark, _vectors(2)) == _mined(_vectors(2))


def test_windows_end_before_all_cells_are_seen():
    r = np.random.default_rng(1)
    centres = r.normal(0, 300, (24, 8))
    x = np.floor(centres[r.integers(0, 24, 4000)] + r.normal(0, 3, (4000, 8)))
    import pyarrow as pa

    rows = pa.table({"vec": pa.array(x.astype(np.int32).tolist(), pa.list_(pa.int32())), "id": np.arange(4000), "row": np.arange(4000), "label": np.zeros(4000, int)})
    shard = negatives.Shard(rows, 8, (negatives._codebook(x[:, :4]), negatives._codebook(x[:, 4:])))
    seen, waves = [], shard.waves
    shard.waves = lambda q: ((seen.append(len(at)), (b, at))[1] for b, at in waves(q))
    hits = shard.search(x[7], True, 0, 7, [(0, -negatives.LAST, negatives.LAST)], 5)
    s = (x @ x[7]).astype(int)
    assert [(i, v) for _, i, v in hits] == [(int(i), int(s[i])) for i in np.lexsort((np.arange(4000), -s)) if i != 7][:5]
    assert sum(seen) < 2000


PHRASE = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _collocations(rows):
    counts, total, pieces = {}, Counter(), re.compile("[.,;:!?\x0a-\x0d]")
    for _, text, lang, *_ in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in pieces.split(low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in range(1, 6):
                counts.setdefault(lang or "und", Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        best, often = [], {p: a for p, a in f.items() if a >= 100}
        for p, a in often.items():
            if len(p) < 2:
                continue
            longer = [q for q, b in often.items() if len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if longer:
                continue
            s, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            best.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:2000]):
            out.append((lang, rank + 1, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out, key=repr)


def _phrase_rows():
    r = random.Random(3)
    rows = [r for r in odd.rows() if len(r[1] or "") < 400] * 40
    words = ["Alpha", "beta", "é\x1c", "x\x00y", "a:b"]
    for i in range(500):
        rows.append((i, "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", "\n", ", "]) for _ in range(r.randint(0, 60))), r.choice(["en", "en", "en", None, "und", "fr"]), "s", 1))
    return rows + [(1, "go on " * 500, "en", None, None), (2, "a" * 3000 + " b", None, None, None), (3, None, None, None, None)]


@pytest.mark.parametrize("small", [False, True])
def test_phrases_of_odd_rows(spark, monkeypatch, small):
    if small:
        for name, value in (("CHUNK", 25), ("SPAN", 50), ("HELD", 300), ("POSITIONS", 640)):
            monkeypatch.setattr(phrases, name, value)
    rows = _phrase_rows()
    docs = spark.createDataFrame(rows, odd.SCHEMA).repartition(3).withColumns({c: F.lit(1) for c in ("word", "count", "ids", "phrase", "a", "l", "r", "n", "at", "chunk")})
    want = _collocations(rows)
    assert odd.bag(phrases.report(docs), *PHRASE) == want and len(want) > 60
    if not small:
        kinds = [("doc_id", "bigint"), ("text", "varchar"), ("lang", "varchar"), ("source", "varchar"), ("n_chars", "bigint")]
        plain = [r for r in rows if "\x00" not in (r[1] or "")]
        assert odd.duck(plain, oracle.PHRASES, list(PHRASE), "documents", kinds) == odd.bag(phrases.report(spark.createDataFrame(plain, odd.SCHEMA)), *PHRASE)
    assert phrases.report(odd.empty(spark)).count() == 0 and phrases.report(odd.documents(spark)).dtypes[3:] == [(c, "bigint") for c in PHRASE[3:]]


def test_trie_finds_what_it_holds():
    r = np.random.default_rng(2)
    for depth, top in ((1, 200), (2, 300), (3, 70_000), (5, 4)):
        rows = np.unique(r.integers(1, top, (3000, depth)), axis=0)
        trie = phrases.Trie(rows)
        ids = r.integers(0, top + 1, 5000).astype(np.int32)
        ids[100 : 100 + depth * 50] = rows[:50].ravel()
        where = {tuple(x): i for i, x in enumerate(rows.tolist())}
        assert trie.walk(ids).tolist() == [where.get(tuple(ids[i : i + depth].tolist()), -1) for i in range(len(ids))]


def test_tokens_of_odd_rows(spark):
    model = Tokenizer.from_file(tokens.FILE)
    rows = [*odd.rows(), (7, "<|endoftext|> a<|endoftext|>\n\n b", "x", "y", 1), (8, "word " * 1100, None, None, None), (9, "z" * 200_000, None, None, None)]
    docs = spark.createDataFrame(rows, odd.SCHEMA).repartition(2).withColumns({c: F.lit("x") for c in ("n_bytes", "n_tokens", "over_limit", "kept")})
    out = tokens.count(docs)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "kept", "n_bytes", "n_tokens", "over_limit"]
    n = [len(model.encode(t or "", add_special_tokens=False)) for _, t, *_ in rows]
    want = sorted([(i, len((t or "").encode()), k, k > 1024) for (i, t, *_), k in zip(rows, n)], key=repr)
    assert odd.bag(out, "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert tokens.count(odd.empty(spark)).count() == 0


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_cut_texts_count_as_whole_ones(monkeypatch, file):
    import public_tokenizers
    import pyarrow as pa

    r = random.Random(4)
    alphabet = [" ", " ", "  ", "\n", "\t", "\x1c", "\x85", "a", "B", "'s", "'", "1", "²", "é", "一", "!", ".", ",", "<|endoftext|>", "　", "😀", "_", "\r", "The"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 25))) for _ in range(4000)]
    path = public_tokenizers.path(file)
    if file.endswith(".model"):
        import sentencepiece

        want = [len(ids) for ids in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    else:
        want = [len(e) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    for group, kept in ((tokens.GROUP_BYTES, tokens.KEPT), (7, 50)):
        monkeypatch.setattr(tokens, "GROUP_BYTES", group)
        monkeypatch.setattr(tokens, "KEPT", kept)
        assert tokens.Counter(path).counts(pa.array(texts)).tolist() == want
