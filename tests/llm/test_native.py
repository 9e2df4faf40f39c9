"""Sharding, mixing, licences and quality rules against SQL or plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stockweave.llm import common, licenses, mixing, oracle, quality, sharding
from tests.llm import odd

DOCS = [("doc_id", "bigint"), ("text", "varchar"), ("lang", "varchar"), ("source", "varchar"), ("n_chars", "bigint")]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_shards_of_odd_rows(spark):
    got = sharding.shard(odd.documents(spark)).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in odd.rows())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots, by_key = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        by_key[r.doc_id].add((r.shard, r.grown_shard))
        assert r.law == "key" and 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(v) == 1 for v in by_key.values())
    assert sharding.shard(odd.empty(spark)).count() == 0


def test_equal_rows_fill_no_slice(spark, monkeypatch):
    equal = spark.range(50_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("x").alias("text"))
    some = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    widest, running = [], common.running
    def watched(sliced, starts, group, *rest):
        widest.append(sliced.groupBy(group, "__slice").count().agg(F.max("count")).first()[0])
        return running(sliced, starts, group, *rest)

    monkeypatch.setattr(common, "running", watched)
    rows = sharding.shard(equal.union(some)).groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("slots"), F.max("slot").alias("last"))
    got = rows.collect()
    assert sum(r.n for r in got) == 53_000 and all(r.n == r.slots == r.last + 1 for r in got)
    assert max(widest) <= 2 * common.SLICE_ROWS


def test_shards_follow_weights_and_move_little(spark):
    ids = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    share = {r.shard: r.n for r in sharding.shard(ids, (3.0, 1.0), 1.0).groupBy("shard").agg(F.count("*").alias("n")).collect()}
    assert abs(share[0] / 20_000 - 0.75) < 0.02
    rows = sharding.shard(ids)
    moved = rows.filter("grown_shard <> shard").count()
    assert abs(moved / 20_000 - 1 / 25) < 0.01 and rows.filter("grown_shard not in (shard, 24)").count() == 0
    again = sharding.shard(ids.repartition(7))
    assert rows.exceptAll(again).count() == 0
    with pytest.raises(ValueError):
        sharding.shard(ids, (1.0, 0.0))


def test_mix_of_odd_rows_matches_sql(spark):
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    got = odd.bag(mixing.report(odd.documents(spark)), *columns)
    assert got == odd.duck(odd.rows(), oracle.MIX, columns, "documents", DOCS)
    assert mixing.report(odd.empty(spark)).count() == 0


def test_mix_meets_targets_and_repeats(spark):
    rows = [(i, odd.prose(i, 20 + i % 30), None, f"s{min(i % 12, 6)}", 1) for i in range(3000)]
    docs = spark.createDataFrame(rows, odd.SCHEMA)
    got = mixing.report(docs).collect()
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r.source_size] += r.taken
        target[r.source_size] = r.target
        assert r.taken % max(1, r.size) == 0 and r.taken <= 3 * r.size
    assert abs(sum(target.values()) - sum(r.size for r in got)) < 1e-6 and all(abs(taken[s] - t) < 60 + 0.01 * t for s, t in target.items())
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({r.doc_id: r.taken // r.size for r in got if r.taken})


def test_licences_of_odd_rows_match_sql(spark):
    columns = ["doc_id", "canonical_sha256", "license", "line_licenses", "n_license_lines"]
    plain = [r for r in odd.rows() if r[0] is not None and r[0] != 2]  # the SQL groups lines by doc_id
    plain += [(200, licenses.MIT_BODY.upper().replace("\n", "\n\n"), None, None, None), (201, "Copyright (c) 1999 Y\n" + licenses.TEXTS[3][1], "", "", 0)]
    got = odd.bag(licenses.scan(spark.createDataFrame(plain, odd.SCHEMA)), *columns)
    assert got == odd.duck(plain, oracle.ORACLE["op6_licenses"], columns, "documents", DOCS)
    found = {r[0]: r for r in got}
    assert found[200][2] == "MIT" and found[201][2] == "ISC" and found[15][3] == "MIT" and found[15][4] == 2
    everything = licenses.scan(odd.documents(spark))
    assert everything.count() == len(odd.rows()) and licenses.scan(odd.empty(spark)).count() == 0


def test_whole_texts_of_licences(spark):
    names = [k for k, _ in dict.fromkeys((k, 0) for k, _ in licenses.full_texts())]
    assert {"Apache-2.0", "MPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "CC0-1.0"} <= set(names)
    published = {k: next(t for n, t in licenses.full_texts() if n == k) for k in names}
    rows = [(i, published[k].replace("\n", "\r\n  "), "", "", 0) for i, k in enumerate(names)]
    rows += [(50, published["Apache-2.0"].split("END OF TERMS")[0], "", "", 0), (51, published["GPL-3.0"][:9000], "", "", 0), (52, "Be excellent.\nTo all!", "", "", 0)]
    docs = spark.createDataFrame(rows, odd.SCHEMA)
    got = {r.doc_id: r.license for r in licenses.scan(docs).collect()}
    assert [got[i] for i in range(len(names))] == names and got[50] == "Apache-2.0" and got[51] is None and got[52] is None
    own = spark.createDataFrame([("Excellent-1.0", "BE EXCELLENT to all"), ("none", "!")], "license string, text string")
    got = {r.doc_id: r.license for r in licenses.scan(docs, texts=own).collect()}
    assert got[52] == "Excellent-1.0" and got[50] == "Apache-2.0"


def _measured(text):
    words = WORD.findall(text or "")
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_quality_of_odd_rows(spark):
    twice = odd.prose(9, 40)
    rows = odd.rows() + [(300, twice + " " + twice, "en", "a", 1), (301, "a b c d e f a b c d e", "", "", 1), (302, "x\ny\nx\n\n\nx z", "", "", 0)]
    got = quality.judge(spark.createDataFrame(rows, odd.SCHEMA).withColumn("posterior", F.lit(1)))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert odd.bag(got, *columns) == sorted(((r[0], *_measured(r[1])) for r in rows), key=repr)
    assert got.filter("kept and base_failed").count() == 0 and got.filter("posterior not between 0 and 1 or kept is null").count() == 0
    assert quality.judge(odd.empty(spark)).count() == 0


def test_estimate_finds_rules_that_agree():
    # Votes (a, b): 900 documents without a bad vote, 90 bad for both, 10 bad for one.
    share, tables = quality.estimate([((0, 0), 900), ((-1, -1), 90), ((-1, 0), 10)])
    assert 0.8 < share < 0.95 and tables[0][-1] < -3 and tables[1][-1] < -3


def test_quality_against_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.judge(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id")
    kept = {(r.quality, r.kept): r.n for r in rows.filter("not base_failed").groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert kept.get((1, False), 0) <= 0.01 * kept[1, True] and kept.get((0, True), 0) <= 0.1 * kept[0, False]
