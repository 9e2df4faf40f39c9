"""The pipeline's stages, each against plain Python or SQL on its own input."""

from collections import Counter

import corpus_pipeline
from stockweave.llm import oracle, pieces
from stockweave.llm.common import staged
from tests.llm import odd
from tests.llm.test_native import DOCS
from tests.llm.test_texts import _joined, _removed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _texts(df):
    return Counter(tuple(r) for r in df.select(COLUMNS).collect())


def test_stages_on_odd_rows(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language ID", "n-gram Jaccard join", "substring dedup", "mixing sources", "SentencePiece"]
    docs = odd.documents(spark, clashes=False)

    told = staged(stages["language ID"](spark, docs, ""), "test")
    assert told.columns == COLUMNS and _texts(told) == Counter(r for r in odd.rows() if any(c.isalpha() for c in r[1] or ""))

    alone = staged(stages["n-gram Jaccard join"](spark, told, ""), "test")
    before = [tuple(r) for r in told.select(COLUMNS).collect()]
    groups = {(component, d) if not n else component for d, n, component in _joined(before, 5, 80) if d is not None}
    got = Counter(r.doc_id for r in alone.collect())
    assert alone.columns == COLUMNS and {d for d in got if d is not None} == groups and max(got.values()) == 1
    assert not _texts(alone) - _texts(told)

    clean = staged(stages["substring dedup"](spark, alone, ""), "test")
    before = [tuple(r) for r in alone.select(COLUMNS).collect()]
    want = Counter()
    counts = {d: (n, gone) for d, n, gone, _ in _removed(before, 35)}
    for row in before:
        n, gone = counts[row[0]]
        if gone == 0:
            want[row] += 1
        elif gone < n:
            want[row[0], row[2:4]] += 1
    after = Counter(tuple(r) if tuple(r) in want else (r.doc_id, (r.lang, r.source)) for r in clean.select(COLUMNS).collect())
    assert clean.columns == COLUMNS and after == want
    assert all(r.n_chars == len(r.text) for r in clean.collect() if tuple(r) not in want)

    mix = staged(stages["mixing sources"](spark, clean, ""), "test")
    rows = [tuple(r) for r in clean.select(COLUMNS).collect()]
    taken = Counter({d: t // s for d, s, t in odd.duck(rows, oracle.MIX, ["doc_id", "size", "taken"], "documents", DOCS) if t})
    assert mix.columns == COLUMNS and Counter(r.doc_id for r in mix.collect()) == taken

    out = stages["SentencePiece"](spark, mix, "").collect()
    own = pieces.Pieces(open(pieces.MODEL, "rb").read())
    texts = {r.doc_id: r.text for r in mix.collect()}
    assert Counter(r.doc_id for r in out) == taken and all(r.round_trip and r.n_tokens == len(r.ids) for r in out)
    assert all(own.decode(r.ids) == texts[r.doc_id] for r in out)


def test_empty_table(spark):
    docs = odd.empty(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, ""), "test")
        assert docs.count() == 0, name


def test_run_keeps_clean_documents(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.filter("not round_trip").count() == 0 and rows.select("doc_id").distinct().count() > 100
