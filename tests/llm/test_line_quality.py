import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from meterflow.llm.line_quality import _forward_backward, _sample, fit, held_out, score_documents, spread_lines

from .util import docs_of

SF = "/root/testdata/sf0.01"


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy(spark):
    large = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{large}/documents.parquet"), spark.read.parquet(f"{large}/labels.parquet")
    out = score_documents(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in out)
    assert all(r.predicted == int(r.score >= 0.7) for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.predicted == r.quality for r in held) / len(held) >= 0.98


def test_only_the_text_counts(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    one = {r.doc_id: r.score for r in score_documents(docs, labels).collect()}
    other = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string")).repartition(7)
    two = {r.doc_id: r.score for r in score_documents(other, labels).collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-9 for k in one)


def test_nulls_long_lines_repeats_and_missing_labels(spark):
    pairs = [(1, None), (2, ""), (3, "\n" * 50_000), (4, "x " * 100_000), (5, "a\nb"), (5, "a\nb"), (None, "A b.")]
    labels = labels_of(spark, [(1, 0, 0), (3, 1, None), (4, None, 1), (None, 1, 0), (5, 0, 0), (5, 1, 0)])
    out = score_documents(docs_of(spark, pairs), labels).collect()
    assert len(out) == len(pairs) and all(0 <= r.score <= 1 for r in out)
    assert {r.score for r in score_documents(docs_of(spark, pairs), labels_of(spark, [])).collect()} == {0.5}
    assert score_documents(docs_of(spark, []), labels).collect() == []


def test_marginals_against_all_label_paths():
    rng = np.random.default_rng(3)
    first = np.array([0, 1, 6, 10])
    unary, t = rng.normal(size=10) * 2, rng.normal(size=(2, 2))
    good, moves = _forward_backward(unary, first, t)
    want, pairs = np.zeros(10), np.zeros((2, 2))
    for lo, hi in zip(first[:-1], first[1:]):
        paths = list(itertools.product((0, 1), repeat=hi - lo))
        p = np.array([np.exp(sum(u for u, v in zip(unary[lo:hi], y) if v) + sum(t[a, b] for a, b in zip(y, y[1:]))) for y in paths])
        for y, q in zip(paths, p / p.sum()):
            want[lo:hi] += q * np.array(y)
            for a, b in zip(y, y[1:]):
                pairs[a, b] += q
    assert np.allclose(good, want) and np.allclose(moves, pairs)


def test_training_sees_a_long_text_to_its_end(spark):
    for n in (1, 20, 200, 201, 5201):
        at, runs = spread_lines(n)
        assert at[0] == 0 and at[-1] == n - 1 and runs.sum() == len(at) == min(n, 200) == len(set(at))
    # Good and bad texts that differ only after their first 300 lines.
    same = "Plain words in a line of text.\n" * 300
    pairs = [(i, same + ("A sentence that ends well.\n" if i % 2 else "||| $$ ## 99\n") * 900) for i in range(40)]
    model = fit(docs_of(spark, pairs), labels_of(spark, [(i, i % 2, 0) for i in range(40)]))
    good, bad = model.scores([pairs[1][1], pairs[0][1]])
    assert good > 0.9 and bad < 0.1


def test_the_sample_is_bounded_by_rows(spark):
    pairs = [(1, f"text {i}") for i in range(300)] + [(3, "once")] * 50
    rows = _sample(docs_of(spark, pairs), labels_of(spark, [(1, 1, 0), (3, 0, 0)]), 100).collect()
    assert len(rows) == 100 == len({(r.doc_id, r.text) for r in rows})


def test_null_ids_are_not_held_out(spark):
    df = spark.createDataFrame([(None,), (1,)], "doc_id bigint").select(held_out(F.col("doc_id")).alias("h"))
    assert [r.h for r in df.collect()] == [False, zlib.crc32(b"1") % 4 == 2]
