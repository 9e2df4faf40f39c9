"""Substring dedup, Jaccard join, fingerprints, language ID, pieces and WARC against plain Python."""

import hashlib
import math
import random
import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
import zstandard

from stockweave.llm import common, components, fingerprints, jaccard, langid, oracle, packed, pieces, substrings, warc
from tests.llm import odd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _removed(rows, width):
    texts = [(i, WORD.findall(t or "")) for i, t, *_ in rows]
    seen = Counter(tuple(w[k : k + width]) for _, w in texts for k in range(len(w) - width + 1))
    out = []
    for i, w in texts:
        gone = {j for k in range(len(w) - width + 1) if seen[tuple(w[k : k + width])] > 1 for j in range(k, k + width)}
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [35, 5])
def test_substrings_of_odd_rows(spark, width):
    got = odd.bag(substrings.report(odd.documents(spark), width), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == _removed(odd.rows(), width)


def test_substrings_with_partly_shared_runs(spark):
    # Passages cut at all places and put next to each other, over few words, so that anchors meet in many different runs.
    r = random.Random(5)
    source = [r.choice("abcdefghijkl") for _ in range(400)]
    rows = []
    for i in range(60):
        a, b = sorted(r.sample(range(400), 2))
        rows.append((i, " ".join(source[a:b] + [f"w{i}"] + source[: r.randint(0, 60)]), "", "", 0))
    got = odd.bag(substrings.report(spark.createDataFrame(rows, odd.SCHEMA).repartition(4), 20), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == _removed(rows, 20)


def _peak_mb(step, batch):
    tracemalloc.start()
    sizes = [b.nbytes for b in step(iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6, max(sizes) / 1e6


def test_substrings_hold_a_part_of_a_batch_at_once():
    r = random.Random(3)
    texts = [" ".join(f"{r.randrange(1 << 20):x}" for _ in range(200)) for _ in range(4000)]
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([pa.array(texts), ids, ids], ["__text", "__d1", "__d2"])
    peak, _ = _peak_mb(substrings._runs(35, 8), batch)
    assert peak < 30

    long, spans = pa.int64(), pa.list_(pa.struct([(n, pa.int64()) for n in ("at", "n", "status")]))
    result = [("n_words", long), ("n_removed", long), ("kept_sha256", pa.string()), ("kept", pa.string())]
    later = [("__packed", pa.binary()), ("__sure", pa.binary()), ("__open", pa.bool_())]
    packs = [("bucket", pa.int32()), ("decided", pa.int32()), ("payload", pa.binary())]
    schema = pa.schema([("__d1", long), ("__d2", long), *result, *later, *packs])
    met = batch.append_column("__found", pa.nulls(len(texts), spans))
    assert _peak_mb(substrings._first_pass(35, 8, [], True, schema), met)[1] < 3

    waiting = pa.array([zstandard.compress(t.encode()) for t in texts])
    met = pa.RecordBatch.from_arrays([waiting, pa.array([b""] * len(texts)), pa.nulls(len(texts), spans)], ["__packed", "__sure", "__found"])
    assert _peak_mb(substrings._second_pass(35, [], True, pa.schema(result)), met)[1] < 3


@pytest.mark.parametrize("limits", [{}, {"BLOCK_WORDS": 100, "FLUSH_RECORDS": 8, "PART_BYTES": 1 << 12}])
def test_runs_are_judged_alike_in_blocks_of_any_size(monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(substrings, name, value)
    r = random.Random(4)
    passages = [[f"p{k}x{i}" for i in range(60)] for k in range(6)]
    own = [[f"d{i}a{j}" for j in range(50)] for i in range(80)]
    texts = [" ".join(own[i] + (passages[r.randrange(6)] if i % 3 else []) + own[i][:7]) for i in range(80)] + ["", "few words"]
    texts += texts[:20]
    names = [packed.mix(np.array([texts.index(t) + 1], dtype=np.uint64)).view(np.int64)[0] for t in texts]
    ids = pa.array(names, pa.int64())
    batch = pa.RecordBatch.from_arrays([pa.array(texts), ids, ids], ["__text", "__d1", "__d2"])
    table = pa.Table.from_batches(substrings._runs(20, 4)(iter([batch])))
    found = {}
    for bucket in range(4):
        for row in substrings._judge(table.filter(pa.compute.equal(table["bucket"], bucket))).to_pylist():
            found.setdefault(row["d1"], set()).update(range(row["at"], row["at"] + row["n"]))
    seen = Counter(tuple(w[k : k + 20]) for w in map(str.split, texts) for k in range(len(w) - 19))
    for name, text in zip(names, texts, strict=True):
        w = text.split()
        assert found.get(name, set()) >= {k for k in range(len(w) - 19) if seen[tuple(w[k : k + 20])] > 1}


def test_deduplicated_keeps_columns_and_clean_texts(spark):
    docs = odd.documents(spark)
    out = substrings.deduplicated(docs)
    assert out.columns == docs.columns
    by = {r.doc_id: r.text for r in out.collect() if r.doc_id is not None}
    whole = {i: t for i, t, *_ in odd.rows()}
    assert by[6] == whole[6] and by[7] is None and by[8] == "" and 1 not in by and odd.prose(2, 60) not in by[4] and odd.prose(4, 50) == by[4]
    assert substrings.deduplicated(odd.empty(spark)).count() == 0 and substrings.report(odd.empty(spark)).count() == 0


def _joined(rows, k, percent):
    def grams(text):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    sets = [grams(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i), d) if sets[i] else d) for i, (d, *_) in enumerate(rows)), key=repr)


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_join_of_odd_rows(spark, k, percent):
    got = odd.bag(jaccard.report(odd.documents(spark), k, percent), "doc_id", "n_shingles", "component_id")
    assert got == _joined(odd.rows(), k, percent)


def test_join_loses_no_link(spark, monkeypatch):
    # Families of texts around the threshold, chains included, a passage that all share, and small tree parts.
    monkeypatch.setattr(jaccard, "TREE_ROWS", 4)
    r, rows = random.Random(8), []
    passage = odd.prose(99, 12).split()
    for family in range(8):
        words = odd.prose(100 + family, 60).split() + passage
        for step in range(9):
            words = list(words)
            for _ in range(r.randint(0, 2)):
                words[r.randrange(len(words))] = f"n{r.randrange(10**6)}"
            rows.append((family * 100 + step, " ".join(words), "", "", 0))
    got = odd.bag(jaccard.report(spark.createDataFrame(rows, odd.SCHEMA).repartition(3), 3, 90), "doc_id", "n_shingles", "component_id")
    assert got == _joined(rows, 3, 90)


def test_ngrams_of_the_same_classes_are_one_group():
    records = np.zeros(4 * 40 + 3, dtype=jaccard.GRAM)
    records["key"][:160], records["d1"][:160], records["n"] = np.repeat(np.arange(40), 4), np.tile([7, 8, 7, 9], 40), 50
    records["d2"][:160], records["many"][:160:4] = np.tile([1, 1, 1, 2], 40), 1
    records["key"][160:], records["d1"][160:] = [50, 50, 60], [7, 9, 7]
    tables = [pa.Table.from_batches(packed.dealt(part, part["key"], decided, 1)) for decided, part in enumerate((records[::2], records[1::2]))]
    out = jaccard._met(pa.concat_tables(tables)).to_pylist()
    groups = {}
    for row in out:
        groups.setdefault(row["gram"], []).append((row["d1"], row["d2"]))
    assert sorted(map(sorted, groups.values())) == [[(7, 0), (9, 0)], [(7, 1), (8, 1), (9, 2)]] and len(out) == 5
    assert jaccard._met(pa.concat_tables(tables).slice(0, 0)).num_rows == 0


@pytest.mark.parametrize("classes", [6, 40])
def test_a_pair_is_named_under_one_of_its_ngrams(classes):
    r = np.random.default_rng(3)
    grams = {c: sorted(r.choice(30, r.integers(1, 30), replace=False).tolist()) for c in range(classes)}
    point = np.ones(jaccard.GROUPS, dtype="<u2").tobytes()
    least = {c: np.array((g + [jaccard.NO_GRAM] * 8)[: jaccard.LEAST], dtype=">i8").tobytes() for c, g in grams.items()}
    found = []
    for gram in range(30):
        inside = [c for c, g in grams.items() if gram in g]
        rows = [{"gram": gram, "part": 0, "own": True, "d1": c, "d2": 0, "n": 256, "r1": c, "point": point, "least": least[c]} for c in inside]
        if rows:
            for batch in jaccard._searched(90)(iter(pa.Table.from_pylist(rows).to_batches())):
                found += [(x["a1"], x["b1"]) for x in batch.to_pylist()]
    want = {(a, b) for a in grams for b in grams if a < b and set(grams[a]) & set(grams[b])}
    assert set(found) == want
    # Lists too short to hold a shared n-gram name their pair more than once, and lose none.
    both = [p for p in want if set(grams[p[0]][: jaccard.LEAST]) & set(grams[p[1]][: jaccard.LEAST])]
    assert all(found.count(p) == 1 for p in both) and len(both) > len(want) / 2


def test_ngrams_of_many_texts_at_once():
    texts = [(t or "") for _, t, *_ in odd.rows()] + ["", "a", "a b a b a b a b"]
    for k in (1, 3, 5):
        words, grams, n, least = jaccard._grams([jaccard._words(t) for t in texts], k)
        want = [np.unique(jaccard.shingles(jaccard._hashes(jaccard._words(t)), k)) for t in texts]
        assert n.tolist() == [len(w) for w in want] and grams.tolist() == np.concatenate(want).tolist() and least is None
        worth = lambda h: (h % np.uint64(5)).astype(np.int64)
        _, grams, n, least = jaccard._grams([jaccard._words(t) for t in texts], k, worth)
        for t, at, size, own in zip(texts, np.cumsum(n) - n, n, want, strict=True):
            h = jaccard._hashes(jaccard._words(t))
            fewest = {int(jaccard.shingles(h[i : i + k], k)[0]): int(worth(h[i : i + k]).min()) for i in range(max(1, len(h) - k + 1)) if len(h)}
            assert list(zip(least[at : at + size].tolist(), grams[at : at + size].tolist())) == sorted((fewest[g], g) for g in own.tolist())


def test_one_of_each(spark):
    docs = odd.documents(spark)
    out = jaccard.one_of_each(docs)
    assert out.columns == docs.columns
    ids = Counter(r.doc_id for r in out.collect())
    assert ids[1] == 1 and not ids[2] and not ids[3] and ids[7] == ids[8] == ids[9] == 1 and ids[10] + ids[11] == 1
    assert ids[None] == 2  # one of the two equal texts, and the one without words
    assert jaccard.one_of_each(odd.empty(spark)).count() == 0 and jaccard.report(odd.empty(spark)).count() == 0


def test_tree_keeps_every_point_within_the_bound():
    r = np.random.default_rng(3)
    points = r.integers(0, 9, (300, 8))
    sizes = points.sum(axis=1)
    tree = jaccard.Tree(points, sizes, 80)
    for i in range(0, 300, 7):
        overlap = np.minimum(points, points[i]).sum(axis=1)
        fits = (100 * sizes >= 80 * sizes[i]) & (100 * sizes[i] >= 80 * sizes) & (overlap >= jaccard.needed(sizes, sizes[i], 80))
        assert set(np.flatnonzero(fits)) <= set(tree.near(points[i], int(sizes[i]))) and len(tree.near(points[i], int(sizes[i]))) < 300


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (7, 7), (5000, 5000)] + [(3000, 3000 + i) for i in range(1, 50)]
    got = components.components(spark.createDataFrame(chain, "a long, b long")).collect()
    sets = {}
    for r in got:
        sets.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, sets.values())) == [list(range(201)), [1000, 1001], list(range(3000, 3050)), [5000]]
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _staged(monkeypatch):
    made, real = [], common.staged
    monkeypatch.setattr(common, "staged", lambda df, purpose: made.append(purpose) or real(df, purpose))
    return made


def test_a_star_is_gone_after_one_round(spark, monkeypatch):
    # Each round is some shuffles, whatever the size; hubs of a large group of near copies have thousands of leaves.
    made = _staged(monkeypatch)
    star = [(0, i) for i in range(1, 3001)] + [(0, 1), (1, 0)]
    got = components.components(spark.createDataFrame(star, "a long, b long")).collect()
    assert sorted(r.node for r in got) == list(range(3001)) and len({r.root for r in got}) == 1
    assert made.count("cc-points") == 1


def test_components_go_on_from_known_ones(spark):
    def sets(rows):
        out = {}
        for r in rows:
            out.setdefault(r.root, set()).add(r.node)
        return sorted(map(sorted, out.values()))

    first = components.components(spark.createDataFrame([(1, 2), (2, 3), (10, 11), (20, 21), (30, 31)], "a long, b long"))
    more = spark.createDataFrame([(3, 10), (11, 40), (40, 41), (50, 51), (21, 20)], "a long, b long")
    assert sets(components.components(more, first).collect()) == [[1, 2, 3, 10, 11, 40, 41], [20, 21], [30, 31], [50, 51]]
    assert sets(components.components(more.limit(0), first).collect()) == [[1, 2, 3], [10, 11], [20, 21], [30, 31]]


def test_links_of_near_copies_take_few_steps(spark, monkeypatch):
    # Two texts that share a passage stay apart, so that all turns run; copies and near copies are one component.
    made = _staged(monkeypatch)
    words, rows = odd.prose(7, 80).split(), []
    for i in range(150):
        rows.append((i, " ".join([*words[: i % 50 + 10], f"n{i % 100}", *words[i % 50 + 11 :]]), "", "", 0))
    rows += [(1000 + i, " ".join(words[:40] + odd.prose(20 + i, 40).split()), "", "", 0) for i in range(4)]
    got = odd.bag(jaccard.report(spark.createDataFrame(rows, odd.SCHEMA).repartition(3), 3, 90), "doc_id", "n_shingles", "component_id")
    assert got == _joined(rows, 3, 90)
    assert made.count("jaccard-pairs") <= 3 and "jaccard-wanted" not in made and made.count("cc-points") <= 8


def test_levels_are_entropies():
    r = np.random.default_rng(1)
    data = np.concatenate([r.integers(0, k, 150) for k in (1, 2, 5, 60, 256)]).astype(np.uint8)
    got = fingerprints.levels(data)
    assert len(got) == len(data) - fingerprints.WINDOW + 1
    for i in range(len(got)):
        counts = Counter(data[i : i + fingerprints.WINDOW].tolist()).values()
        entropy = -sum(c / 64 * math.log2(c / 64) for c in counts)
        assert abs(got[i] - entropy / 6 * (fingerprints.LEVELS - 1)) <= 1.01


def test_fingerprints_of_odd_rows(spark):
    rows = odd.rows()
    got = fingerprints.compare(odd.documents(spark)).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    want = Counter()
    for k, (i, t, *_) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        want[i, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    prints, text = {}, {r[0]: r[1] or "" for r in rows}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id is not None:
            assert prints.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
    by = {r.doc_id: r for r in got}
    assert by[1].near_next == 1 and by[6].near_edited > 0.3 > by[6].near_next and by[8].fingerprint == "0:"
    assert fingerprints.compare(odd.empty(spark)).count() == 0


def test_fingerprints_of_texts_on_both_sides_of_a_size(spark):
    # Near copies and edits of all lengths, so some pairs straddle whatever size might be treated differently.
    text = odd.prose(77, 400)
    rows = [(2 * n + side, text[: n + 6 * side], "", "", 0) for n in (60, 90, 125, 253, 381, 510, 1021) for side in (0, 1)]
    rows += [(5000, odd.prose(78, 200)[:600], "", "", 0), (5001, odd.prose(79, 9)[:50], "", "", 0)]
    by = {r.doc_id: r for r in fingerprints.compare(spark.createDataFrame(rows, odd.SCHEMA)).collect()}
    assert all(by[2 * n].near_next > 0.7 for n in (60, 90, 125, 253, 381, 510, 1021))
    assert by[5000].near_edited > 0.3


def test_ranks_count_the_windows_features_come_from(spark):
    rows = [(i, odd.prose(i, 4)[:30], "", "", 0) for i in range(40)]  # all texts shorter than 64 bytes
    counts = np.bincount(np.concatenate(fingerprints.levels_of([fingerprints._bytes(t) for _, t, *_ in rows])), minlength=fingerprints.LEVELS)
    got = fingerprints.ranks(spark.createDataFrame(rows, odd.SCHEMA))
    usual = np.arange(fingerprints.LEVELS) >= fingerprints.LEVELS // 10
    assert counts.max() > 0 and got[usual].max() == got[np.argmax(np.where(usual, counts, -1))] > got[usual & (counts == 0)].max()


def test_cross_parsing_matches_longest_substrings():
    texts = {"x": "abracadabra arcade bard", "y": "the cat sat on the mat"}
    parser = langid.Parser(texts)
    r = random.Random(2)
    for _ in range(60):
        text = "".join(r.choice("abrcdthesm ") for _ in range(r.randint(1, 40)))
        letters = parser.read(text)
        blocks = letters.astype(np.int32)[None, :]
        for lang, own in zip(parser.languages, parser.phrases(blocks)[0], strict=True):
            folded, known = "".join(" " if c == parser.space else _letter(parser, texts, c) for c in letters), texts[lang]
            at = count = 0
            while at < len(folded):
                n = 1
                while at + n <= len(folded) and folded[at : at + n] in known:
                    n += 1
                at += max(1, n - 1)
                count += 1
            assert own == count


def _letter(parser, texts, code):
    return "?" if code == 0 else sorted({c for t in texts.values() for c in t})[code - 1]


def test_languages_of_odd_rows(spark):
    got = langid.identify(odd.documents(spark)).collect()
    assert len(got) == len(odd.rows())
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (7, 8, 9, 14)) and by[1].lang_pred in ("en", "fr")
    assert all(0 <= r.score <= 1 for r in got) and langid.identify(odd.empty(spark)).count() == 0
    unlabelled = odd.documents(spark).withColumn("lang", odd.F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs).filter("held_out").join(docs, "doc_id").select("lang", "lang_pred").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    kept = langid.accepted(odd.documents(spark))
    assert {7, 8, 9, 14}.isdisjoint(r.doc_id for r in kept.collect()) and kept.columns == odd.documents(spark).columns


def test_a_language_with_little_training_text_wins_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    training = langid.sample(docs)
    texts = [(r.lang, r.text[:400]) for r in docs.filter("lang is not null and length(text) > 400").filter(langid.held_out(docs.doc_id)).limit(60).collect()]
    for tiny in ("a", "ok", "hallo"):
        langs, _ = langid.Parser(training | {"zz": tiny, "aa": tiny}).judge([t for _, t in texts])
        assert sum(a == b for a, (b, _) in zip(langs, texts, strict=True)) >= 0.95 * len(texts), tiny
    # A large alphabet has short phrases; a language that knows none of its letters does not win by them.
    r = random.Random(7)
    many = "".join(chr(0x4E00 + r.randrange(900)) for _ in range(20_000))
    langs, _ = langid.Parser({"en": odd.prose(1, 60), "zh": many}).judge(["".join(many[i : i + 2] for i in range(0, 900, 37))])
    assert langs == ["zh"]


def test_nothing_learned_keeps_documents(spark):
    unlabelled = odd.documents(spark).withColumn("lang", odd.F.lit(None).cast("string"))
    kept = langid.accepted(unlabelled)
    assert kept.columns == unlabelled.columns
    assert Counter(r.text for r in kept.collect()) == Counter(t for _, t, *_ in odd.rows() if any(c.isalpha() for c in t or ""))


def test_training_text_without_a_space():
    langs, scores = langid.Parser({"en": "hello"}).judge(["мир", "hello", " ", "..."])
    assert langs == ["en", "en", "und", "und"]


def test_sample_is_cut_after_folding(spark):
    rows = [(i, "# 1 " * 400 + odd.prose(i, 400), "en", "a", 1) for i in range(1, 40)]
    got = langid.sample(spark.createDataFrame(rows + rows[:3], odd.SCHEMA), docs_per_language=10)["en"]
    assert 10 * (langid.SAMPLE_CHARS - 1) <= len(got) <= 10 * (langid.SAMPLE_CHARS + 1)


def test_pieces_equal_the_library(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = [t for _, t, *_ in odd.rows() if t is not None] + [" " * 40 + "x", "x" + " " * 17, "isArray==null;//--", "1234567890 12", "日本語 é\n\n\t"]
    own = pieces.Pieces(open(pieces.MODEL, "rb").read())
    assert [x.tolist() for x in own.encode(texts)] == library.encode(texts)
    assert [own.decode(x.tolist()) for x in own.encode(texts)] == texts
    # In small tables too, the results do not depend on what is kept.
    own.words, own.older, own.pairs = {}, {}, {}
    assert [x.tolist() for x in own.encode(texts[::-1])] == library.encode(texts[::-1])


def test_long_words_after_spaces_equal_the_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    own = pieces.Pieces(open(pieces.MODEL, "rb").read())
    for n in (31, 40, 700, 3000):
        word = "".join(random.Random(n).choice("abcdeéß0aaan") for _ in range(n))
        for text in ("  " + word, "   " + "ab" * n, word):
            assert [list(x) for x in own.encode([text])] == [library.encode(text)]
    before = time.perf_counter()
    assert sum(len(x) for x in own.encode(["  " + "VGhpcyBpcyBhIGxvbmcg" * 50_000]))
    assert time.perf_counter() - before < 20


def test_states_know_the_pieces_that_end_at_a_character():
    own = pieces.Pieces(open(pieces.MODEL, "rb").read())
    assert not list(own.encode([]))
    r = random.Random(9)
    known = [p for p in own.ids if len(p) > 3 and pieces.MARK not in p]
    for _ in range(300):
        word = pieces.MARK + "".join(r.choice([r.choice(known), r.choice("abé日\x00")]) for _ in range(5))
        state = own.begin
        for end, letter in enumerate(word, 1):
            state = state[0].get(letter) or own._step(state, letter)
            ends = [word[start:end] for start in range(end - 1) if word[start:end] in own.ids]
            assert [(p, n) for p, n, _ in state[1]] == [(p, len(p)) for p in ends]
    assert len(own.states) <= len(own.starts)


def test_pieces_of_odd_rows(spark):
    rows = pieces.round_trip(odd.documents(spark)).collect()
    assert len(rows) == len(odd.rows()) and all(r.round_trip for r in rows) and all(r.n_tokens == 0 for r in rows if r.doc_id in (7, 8))
    encoded = pieces.encode(odd.documents(spark))
    assert Counter(r.text for r in pieces.decode(encoded).select("text").collect()) == Counter(t for _, t, *_ in odd.rows())
    assert pieces.round_trip(odd.empty(spark)).count() == 0


def _pages():
    big = "<html>" + odd.prose(1, 400) + "</html>"
    return [
        (1, "http://x/ä b\r\n?q=1", big), (2, None, big), (9, "", big), (9, "again", big), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"),
        (7, "u", "\r\n\r\nWARC/1.1\r\n" * 200), (8, "u", "é" * 200_000), (None, "n", big + "x"), (None, "n", None), (11, "u", "x" * 1000), (10, "u", "x" * 1000),
    ]


def test_archives_match_sql(spark):
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    pages = spark.createDataFrame(_pages(), "page_id long, url string, html string").withColumn("digest", odd.F.lit("clash"))
    got = odd.bag(warc.archived(pages, chunk_bytes=1000), *columns)
    assert got == odd.duck(_pages(), oracle.WARC, columns, "pages", [("page_id", "bigint"), ("url", "varchar"), ("html", "varchar")])
    assert warc.archived(pages.limit(0)).count() == 0


def test_archives_give_the_bytes_back(spark):
    pages = spark.createDataFrame(_pages()[4:], "id long, url string, payload string").withColumn("payload", odd.F.coalesce("payload", odd.F.lit("")).cast("binary"))
    folder = warc.shared_folder(spark)
    listed = warc.write(warc.chunks(pages, warc.revisits(pages), 700), folder)
    rows = warc.read(listed, folder, 333).collect()
    assert sum(r.records for r in listed.collect()) == pages.count()
    by = {}
    for r in sorted(rows, key=lambda r: (r.id or "", r.chunk_no)):
        assert len(r.chunk) <= 333
        by.setdefault(r.id, b"")
        by[r.id] += bytes(r.chunk)
        assert r.record_type == "revisit" or r.digest_so_far
    want = {str(i): (t or "").encode() for i, _, t in _pages()[4:] if i is not None}
    want["10"] = b""  # a revisit of 11
    assert {k: v for k, v in by.items() if k is not None} == want
