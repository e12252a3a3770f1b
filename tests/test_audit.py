import random

from meterflow.operators.audit import position_audit

ROW = "topic string, partition int, offset long"


def brute(log, stored, positions):
    last = {(t, p): o for t, p, o in positions}
    out = []
    for key in {r[:2] for r in log + stored}:
        kinds = {}
        logged = {o for *k, o in log if tuple(k) == key}
        held = [o for *k, o in stored if tuple(k) == key]
        for o in logged | set(held):
            n, top = held.count(o), last.get(key)
            beyond = top is None or o > top
            kind = ("doubled" if n > 1 else "unlogged" if o not in logged else "missing" if n == 0 and not beyond
                    else "pending" if n == 0 else "ahead" if beyond else None)
            kinds.setdefault(kind, []).append(o)
        for kind, offsets in kinds.items():
            if kind is None:
                continue
            start = None
            for o in sorted(offsets):
                if start is None or o != end + 1:
                    if start is not None:
                        out.append((*key, kind, start, end))
                    start = o
                end = o
            out.append((*key, kind, start, end))
    return sorted(out, key=str)


def test_random_logs_equal_brute_force(spark):
    rng = random.Random(4)
    log = [(t, p, o) for t in ("a", None) for p in (0, 1) for o in range(rng.randrange(60, 200))]
    stored = [r for r in log if rng.random() < 0.9 and not 40 <= r[2] < 55] + rng.sample(log, 30) + [("a", 0, 900 + i) for i in range(5)] + [("b", 0, 3)]
    positions = [("a", 0, 100), (None, 1, 50), ("b", 0, 10)]
    frames = [spark.createDataFrame(rows, ROW) for rows in (log, stored)]
    last = spark.createDataFrame(positions, "topic string, partition int, last_offset long")
    for block in (16, 1 << 20):
        got = sorted((tuple(r) for r in position_audit(*frames, last, block_rows=block).collect()), key=str)
        assert got == brute(log, stored, positions)


def test_only_blocks_that_differ_are_looked_at(spark):
    log = spark.range(100_000).selectExpr("'a' AS topic", "0 AS partition", "id AS offset")
    stored = log.where("offset <> 70001")
    last = spark.createDataFrame([("a", 0, 99_999)], "topic string, partition int, last_offset long")
    out = position_audit(log, stored, last, block_rows=1000)
    assert [tuple(r) for r in out.collect()] == [("a", 0, "missing", 70001, 70001)]
    assert position_audit(log, log, last, block_rows=1000).collect() == []
    assert position_audit(log.limit(0), log.limit(0), last).collect() == []
