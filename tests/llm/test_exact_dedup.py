import hashlib

from meterflow.llm.exact_dedup import dedup_batch, keep_one
from meterflow.llm.queries import fresh_index

from .util import docs_of, documents


def verdicts(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


def sha(t):
    return hashlib.sha256((t or "").encode()).hexdigest()


def test_cases(spark):
    pairs = [(1, "a"), (2, "a"), (3, None), (4, ""), (None, "b"), (5, "b"), (6, "a "), (7, "x" * 300_000), (8, "r"), (8, "r"), (None, "lone")]
    got = verdicts(dedup_batch(docs_of(spark, pairs), fresh_index(spark)))
    want = []
    for i, t in pairs:
        same = [j for j, u in pairs if (u or "") == (t or "")]
        keep = max((j for j in same if j is not None), default=None)
        want.append((i, keep, len(same), i == keep, sha(t)))
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    assert verdicts(dedup_batch(docs_of(spark, []), fresh_index(spark))) == []


def test_second_batch_meets_the_index(spark):
    index = fresh_index(spark)
    dedup_batch(docs_of(spark, [(1, "a"), (2, "b")]), index).collect()
    second = docs_of(spark, [(10, "a"), (11, "c"), (12, "c")])
    got = {r.doc_id: (r.keep_id, r.kept) for r in dedup_batch(second, index).collect()}
    assert got == {10: (1, False), 11: (12, False), 12: (12, True)}
    again = {r.doc_id: (r.keep_id, r.kept) for r in dedup_batch(second, index).collect()}
    assert again == got and spark.table(index).count() == 3


def test_index_join_moves_no_index_row(spark):
    index = fresh_index(spark)
    dedup_batch(documents(spark), index).collect()
    held = spark.table(index)
    plan = held.hint("merge").join(spark.table(index).select("digest"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_keep_one_keeps_all_columns_and_one_of_repeated_rows(spark):
    docs = docs_of(spark, [(1, "a"), (2, "a"), (8, "r"), (8, "r"), (9, None), (None, "n")])
    out = keep_one(docs, fresh_index(spark))
    assert out.columns == docs.columns
    assert sorted(str((r.doc_id, r.text)) for r in out.collect()) == ["(2, 'a')", "(8, 'r')", "(9, None)", "(None, 'n')"]
