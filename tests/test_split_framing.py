import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterflow.operators import split_framing as sf
from meterflow.operators.parsing import parse_telegram_lines, parse_telegrams
from meterflow.operators.split_framing import frame_splits
from meterflow.sources.captures import capture_source

from .test_captures import folder
from .test_framing import PIECES, model


def telegrams_of(lines):
    out = {}
    for number, _, text in model(lines):
        out.setdefault(number, []).append(text)
    return out


def framed(df, **options):
    out = frame_splits(df, ["capture_file"], ["split_start"], "pos", **options)
    rows = out.collect()
    assert len({(r.capture_file, r.telegram_no) for r in rows}) == len(rows)
    return sorted((r.capture_file.rsplit("/", 2)[1], r.telegram_no, r.lines) for r in rows)


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}
    yield lambda size: [spark.conf.set(n, str(size)) for n in names]
    for n, v in old.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("size", [40, 300, 5000, 10_000_000])
def test_files_of_many_splits_equal_the_state_machine(spark, small_splits, size):
    rng = random.Random(size)
    texts = {f"m{i}": "\n".join(rng.choices(PIECES, k=rng.choice([0, 1, 5, 60, 400]))) for i in range(12)}
    # Long runs: noise without any end, a telegram over many splits, ends only.
    texts["noise"] = "x\n" * 500 + "!\n"
    texts["long"] = "!\n/A\n" + "value\n" * 500 + "!1\n/B\n!2\n"
    texts["open"] = "/A\n!1\n/B\n" + "value\n" * 300
    texts["ends"] = "!\n" * 300
    root = folder(spark, {f"{k}/a.txt": t.encode() for k, t in texts.items()})
    small_splits(size)
    got = framed(capture_source(spark, root))
    want = sorted((k, n, lines) for k, t in texts.items() for n, lines in telegrams_of(t.split("\n")).items())
    assert got == want


def walk(lines, cuts, edges):
    """The in-task pass over one split that comes in batches cut at ``cuts``."""
    kinds = [sf.END if l.startswith("!") else sf.START if l.startswith("/") else sf.OTHER if l else sf.BLANK for l in lines]
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(lines)), pa.int64()), pa.array(kinds, pa.int8()), pa.array(lines, pa.string())], names=["pos", "__flag", "line"])
    cut = sf._Walk(["pos"], edges)
    cut.open(1)
    out = []
    for lo, hi in zip([0, *cuts], [*cuts, len(lines)]):
        if lo < hi:
            out += list(cut.run(rows.slice(lo, hi - lo), rows.column("__flag").to_numpy()[lo:hi]))
    out += list(cut.close())
    return [tuple(r.values()) for b in out for r in b.to_pylist()]


def test_batches_of_a_split_do_not_matter():
    rng = random.Random(1)
    for _ in range(300):
        lines = [l.strip() for l in rng.choices(PIECES, k=rng.randrange(1, 40))]
        cuts = sorted(rng.sample(range(len(lines) + 1), min(4, len(lines))))
        assert walk(lines, cuts, False) == walk(lines, [], False)
        flat = lambda rows: [(k, l) for _, k, _, ls in rows for l in ls]
        assert flat(walk(lines, cuts, True)) == flat(walk(lines, [], True))


def test_kept_columns_come_from_the_start_line(spark, small_splits):
    text = "".join(f"noise\n/S{i}\nvalue {i}\n/inner\n!{i}\n" for i in range(200))
    root = folder(spark, {"m/a.txt": text.encode()})
    small_splits(130)
    df = capture_source(spark, root).withColumn("first", F.col("line"))
    out = frame_splits(df, ["capture_file"], ["split_start"], "pos", keep=["first"]).collect()
    assert sorted((r.first, r.lines[0]) for r in out) == sorted((f"/S{i}", f"/S{i}") for i in range(200))


def test_captures_over_several_files_and_null_keys(spark):
    rows = [(None, "a", 0, 1, "/X"), (None, "a", 0, 2, "x"), (None, "b", 0, 3, "!1"), ("m", "a", 0, 4, "/Y"), ("m", "a", 0, 5, None), ("m", "a", 9, 6, "!2")]
    df = spark.createDataFrame(rows, "meter string, capture_file string, split_start long, pos long, line string").coalesce(1)
    out = frame_splits(df, ["meter"], ["capture_file", "split_start"], "pos").collect()
    assert sorted((str(r.meter), r.telegram_no, r.lines) for r in out) == [("None", 0, ["/X", "x", "!1"]), ("m", 0, ["/Y", "!2"])]
    assert frame_splits(df.limit(0), ["meter"], ["capture_file", "split_start"], "pos").collect() == []


def test_no_line_goes_through_an_exchange_but_end_pieces(spark, small_splits):
    text = "".join(f"/S{i}\n" + "value\n" * 20 + "!\n" for i in range(2000))
    root = folder(spark, {"m/a.txt": text.encode()})
    small_splits(50_000)
    out = frame_splits(capture_source(spark, root), ["capture_file"], ["split_start"], "pos")
    assert out.count() == 2000
    # One exchange of rows, below the pieces' join; the whole telegrams have none.
    plan = out._jdf.queryExecution().executedPlan()
    out.collect()
    whole, pieces = plan.toString().split("Union")[1].split("MapInArrow")[0], plan.toString()
    assert "Exchange hashpartitioning" not in whole and pieces.count("BroadcastExchange") >= 1
    edges = sf._pass(
        capture_source(spark, root).select("capture_file", "split_start", "line").withColumn("__flag", sf._kind_of(F.col("line"))),
        ["capture_file", "split_start"], [], edges=True,
    )
    splits = capture_source(spark, root).select("split_start").distinct().count()
    moved = edges.select(F.sum(F.size("lines"))).first()[0]
    assert splits >= 5 and moved <= splits * 2 * 22


def test_parse_of_arrays_equals_parse_of_lines(spark):
    rng = random.Random(8)
    parts = ["0-0:1.0.0(240101000007W)", "0-0:1.0.0(bad)", "1-0:1.8.1(000001.000*kWh)", "1-0:1.8.1(2.000*kWh)x", "1-0:1.8.1(3.00*kWh)", "0-0:96.14.0(0002)", "1-0:1.7.0(000006.550*kW)",
             "0-1:24.2.1(240101000000W)(000006.550*m3)", "0-1:24.2.1(240101000000S)", "x", "1-0:2.7.0(99999999999999999999.000*kW)"]
    rows = [(i, rng.choices(parts, k=rng.randrange(12))) for i in range(300)]
    arrays = spark.createDataFrame(rows, "id long, lines array<string>")
    lines = arrays.select("id", F.posexplode("lines").alias("n", "line"))
    a = parse_telegrams(arrays.where(F.size("lines") > 0), keep_dst_flag=True)
    b = parse_telegram_lines(lines, ["id"], ["n"], keep_dst_flag=True)
    assert sorted(a.select(*b.columns).collect()) == sorted(b.collect())


def test_whole_splits_of_a_batch_equal_the_walk_over_each():
    rng = random.Random(6)
    for _ in range(400):
        splits = [[l.strip() for l in rng.choices(PIECES, k=rng.randrange(1, 25))] for _ in range(rng.randrange(1, 7))]
        lines = [l for s in splits for l in s]
        kinds = [sf.END if l.startswith("!") else sf.START if l.startswith("/") else sf.OTHER if l else sf.BLANK for l in lines]
        rows = pa.RecordBatch.from_arrays([pa.array(range(len(lines)), pa.int64()), pa.array(kinds, pa.int8()), pa.array(lines, pa.string())], names=["pos", "__flag", "line"])
        bounds = np.cumsum([0, *map(len, splits)])
        got = sf._whole_splits(["pos"], rows, np.array(kinds, np.int8), bounds).to_pylist()
        want = [(r[0] + at, *r[1:]) for s, at in zip(splits, bounds.tolist()) for r in walk(s, [], None)]
        assert sorted(tuple(r.values()) for r in got) == sorted(want)


def test_splits_inside_a_batch_are_not_walked_one_by_one(spark, monkeypatch):
    rows = [(i // 10, i // 10, i, t) for i in range(1000) for t in [["!", "/A", "x", "!1", "/B", "y", "!2", "", "/C", "z"][i % 10]]]
    df = spark.createDataFrame(rows, "meter long, split long, pos long, line string").coalesce(1).sortWithinPartitions("pos")
    calls = []
    plan = lambda fn, schema: calls.append(fn) or df
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, fn, schema: plan(fn, schema))
    flagged = df.withColumn("__flag", sf._kind_of(F.col("line")))
    sf._pass(flagged, ["meter", "split"], [], None)
    ids, kinds = [r[0] for r in rows], [sf.END if r[3][:1] == "!" else sf.START if r[3][:1] == "/" else sf.OTHER if r[3] else sf.BLANK for r in rows]
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids), pa.array(ids), pa.array(kinds, pa.int8()), pa.array([r[3] for r in rows])],
                                       names=["meter", "split", "__split", "__flag", "line"])
    walked = []
    monkeypatch.setattr(sf._Walk, "open", lambda self, split, old=sf._Walk.open: (walked.append(split), old(self, split))[1])
    out = pa.Table.from_batches(calls[0](iter([batch, batch.slice(0, 0)])))
    assert walked == [0, 99]
    kind = out.column("__kind").to_pylist()
    assert kind.count(sf.TELEGRAM) == 200 and kind.count(sf.TAIL) == 100 and kind.count(sf.INSIDE) == 100
