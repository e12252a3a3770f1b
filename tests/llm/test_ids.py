"""Ids beyond 2^53 beside a null id come back exactly from every operator."""

import pytest
from meterflow.llm import queries
from meterflow.llm.jaccard_join import similar_components
from meterflow.llm.substring_dedup import remove_repeats
from meterflow.llm.warc import archive_and_read

from .util import docs_of

BIG = 1 << 60
WORDS = " ".join(f"w{i}" for i in range(60))


def ids(df, column="doc_id"):
    return sorted((r[column] for r in df.collect()), key=str)


PAIRS = [(BIG + 1, WORDS), (BIG + 3, WORDS + " end"), (BIG + 5, "alone here"), (None, WORDS), (None, "other"), (BIG + 5, WORDS)]
WANT = sorted((i for i, _ in PAIRS), key=str)


def test_jaccard_join(spark):
    out = similar_components(docs_of(spark, PAIRS), k=3, percent=90).collect()
    assert sorted((r.doc_id for r in out), key=str) == WANT
    assert {(r.doc_id, r.component_id) for r in out} == {(BIG + 1, BIG + 1), (BIG + 3, BIG + 1), (BIG + 5, BIG + 5), (BIG + 5, BIG + 1), (None, BIG + 1), (None, None)}


def test_substring_dedup(spark):
    out = remove_repeats(docs_of(spark, PAIRS)).collect()
    assert sorted((r.doc_id for r in out), key=str) == WANT
    assert sorted((str(r.doc_id), r.n_words, r.n_removed) for r in out) == sorted((str(i), len(t.split()), 60 if t.startswith(WORDS) else 0) for i, t in PAIRS)


def test_warc(spark):
    body = "<p>" + "x" * 2000
    rows = [(BIG + 1, "http://a/1", body), (BIG + 3, "http://a/2", body), (BIG + 5, None, "small"), (None, "http://a/3", body)]
    out = archive_and_read(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in out}
    assert len(out) == 4 and kinds == {BIG + 1: ("revisit", BIG + 3), BIG + 3: ("response", None), BIG + 5: ("response", None), None: ("revisit", BIG + 3)}


@pytest.mark.parametrize("name", ["op1_sentencepiece", "op3_exact_dedup", "op5_jaccard_join", "op6_substring_dedup", "op7_line_quality", "op9_pii", "op12_secrets", "op13_importance"])
def test_queries_over_documents(spark, monkeypatch, name):
    table = queries.table
    monkeypatch.setattr(queries, "table", lambda s, d, n: docs_of(spark, PAIRS, clashing=False) if n == "documents" else table(s, d, n))
    assert ids(queries.REGISTRY[name](spark, "/root/testdata/sf0.001")) == WANT
