import corpus_pipeline
from meterflow.llm.line_quality import score_documents

from .test_decontaminate import brute as leaks
from .test_jaccard_join import brute as components
from .util import SF, documents


def test_stages_against_brute_force(spark):
    """Every stage takes what its predecessor kept; each is redone here in plain Python."""
    docs = documents(spark)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in score_documents(docs, labels).where("predicted = 1").collect()}
    text = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    assert 0 < len(good) < docs.count()
    last = {}
    for d in sorted(text):
        last[text[d]] = d
    text = {d: t for t, d in last.items()}
    near = components(sorted(text.items()), 5, 80)
    text = {d: text[d] for d, _, c in near if d == c}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = {m[0] for m in leaks(sorted(text.items()), bench)}
    want = set(text) - found
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == want and len(out) == len(want)
    assert all(r.n_ids == len(r.ids) > 0 for r in out if text[r.doc_id])


def test_stages_keep_the_columns(spark):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF).columns == docs.columns
