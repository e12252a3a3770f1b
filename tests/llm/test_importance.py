import hashlib
import math
import random
import re
import zlib

import meterflow.llm.importance as imp
from meterflow.llm.queries import op13_importance
from pyspark.sql import functions as F

from .util import SF, docs_of, documents

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def features(text, max_run):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, max_run + 1) for i in range(len(w) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def brute(pairs, target, max_run=1, min_words=20, percent=10):
    s, t = [0] * 10000, [0] * 10000
    for _, text in pairs:
        for f in features(text, max_run):
            s[bucket(f)] += 1
    for text in target:
        for f in features(text, max_run):
            t[bucket(f)] += 1
    total_s, total_t = sum(s) + 10000, sum(t) + 10000
    gain = [math.floor(1000 * math.log((t[b] + 1) * total_s / ((s[b] + 1) * total_t))) for b in range(10000)]
    rows = []
    for i, text in pairs:
        f = features(text, max_run)
        weight = sum(gain[bucket(x)] for x in f)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, None, len(words(text))])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, r in enumerate(able[: len(able) * percent // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def target_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id bigint, text string")


def test_random_texts_with_ties_nulls_and_repeated_rows(spark):
    rng = random.Random(3)
    vocabulary = ["a", "B", "Été", "ÀÉ", "x1", "it's", "9", "日本", "the-end", "Ünï", "😀"]
    big = (1 << 60) + 1
    pairs = [(big + 2 * i, " ".join(rng.choices(vocabulary, k=rng.randrange(60)))) for i in range(200)]
    pairs += [(7, None), (8, ""), (None, "a b " * 20), (None, None), (9, "A" * 50_000)]
    pairs += pairs[:40]
    target = ["Été the-end", None, "", "日本 9 9"]
    for max_run in (1, 2, 3):
        got = found(imp.resample(docs_of(spark, pairs), target_of(spark, target), max_run=max_run))
        assert got == brute(pairs, target, max_run)


def test_all_scores_equal_except_ids(spark, monkeypatch):
    # Without noise and with one text everything is a tie: ids decide, then the rows.
    monkeypatch.setattr(imp, "gumbel", lambda doc_id, seed: F.lit(0).cast("bigint"))
    text = "one two three " * 10
    pairs = [(i % 30, text) for i in range(90)] + [(None, text)] * 10
    out = imp.resample(docs_of(spark, pairs), target_of(spark, ["one"]), percent=50).collect()
    ranked = sorted((r.rank, r.doc_id) for r in out if r.rank)
    assert [r for r, _ in ranked] == list(range(1, 51))
    assert [d for _, d in ranked] == sorted(i % 30 for i in range(90))[:50]
    out = imp.resample(docs_of(spark, pairs), target_of(spark, ["one"]), percent=95).collect()
    assert sum(r.rank is not None for r in out) == 95 and sum(r.rank is not None and r.doc_id is None for r in out) == 5


def test_texts_longer_than_a_slice(spark, monkeypatch):
    monkeypatch.setattr(imp, "SLICE", 7)
    memo = imp._Buckets()
    for max_run in (1, 2, 4):
        for text in ("a bb ccc dddd eeeeeeeeeeeeeee f g", "x", "", "aaaaaaa bbbbbbb ccccccc", "été été 1 2 3 4 5"):
            want = sorted(bucket(f) for f in features(text, max_run))
            assert sorted(b for _, bs in imp._features(text.encode(), memo, max_run) for b in bs) == want


def test_empty_tables(spark):
    docs = docs_of(spark, [(i, "a few words here " * 8) for i in range(20)])
    assert imp.resample(docs_of(spark, []), target_of(spark, ["a"])).collect() == []
    assert sum(r.rank is not None for r in imp.resample(docs, target_of(spark, [])).collect()) == 2
    assert found(imp.resample(docs, target_of(spark, []), percent=0))[0][4] is None


def test_query_equals_brute_force(spark):
    pairs = [(r.doc_id, r.text) for r in documents(spark).select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    out = op13_importance(spark, SF)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {f.dataType.simpleString() for f in out.schema} == {"bigint"}
    assert found(out) == brute(pairs, target)
