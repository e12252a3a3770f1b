import random

from pyspark.sql import functions as F

from meterflow.operators.scan import block_of, dense_rank_in_key, segmented_scan


def brute(rows, inclusive):
    out = {}
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    for k, rs in by_key.items():
        rs.sort(key=lambda r: r[1])
        total = sum(r[2] for r in rs)
        run, last = 0, None
        for r in rs:
            if inclusive:
                run += r[2]
                last = r[3] if r[3] is not None else last
                out[(k, r[1])] = (run, last, total)
            else:
                out[(k, r[1])] = (run, last, total)
                run += r[2]
                last = r[3] if r[3] is not None else last
    return out


def test_scan_matches_brute_force_across_blocks(spark):
    rnd = random.Random(7)
    rows = []
    for k in [None, 1, 2, 3]:
        n = rnd.randint(1, 60) if k != 3 else 400  # key 3 is the hot one
        for o in rnd.sample(range(1000), n):
            rows.append((k, o, rnd.randint(0, 5), rnd.choice([None, None, rnd.randint(0, 99)])))
    df = spark.createDataFrame(rows, "k int, o long, v int, x int")
    for inclusive in (False, True):
        got = segmented_scan(
            df, ["k"], block_of(F.col("o"), 37), ["o"],
            sums={"s": F.col("v")}, lasts={"l": F.col("x")}, totals={"t": F.col("v")}, inclusive=inclusive,
        ).collect()
        want = brute(rows, inclusive)
        assert len(got) == len(rows)
        for r in got:
            assert (r["s"], r["l"], r["t"]) == want[(r["k"], r["o"])], (inclusive, r)


def test_scan_keeps_columns_and_row_number(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 2, "b"), (2, 9, "c")], "k int, o long, p string")
    out = dense_rank_in_key(df, ["k"], block_of(F.col("o"), 2), ["o"], "rn").orderBy("k", "o").collect()
    assert [(r.k, r.o, r.p, r.rn) for r in out] == [(1, 2, "b", 1), (1, 5, "a", 2), (2, 9, "c", 1)]


def test_scan_plan_shuffles_rows_once(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"), F.lit("x").alias("p"))
    out = segmented_scan(df, ["k"], block_of(F.col("o"), 100), ["o"], sums={"s": F.lit(1)})
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan or plan.count("FileScan") + plan.count("Range (") <= 1
