import os
import random

from pyspark.sql import functions as F

from meterflow.operators.framing import frame_lines
from meterflow.sources.captures import capture_block, capture_source, write_captures
from meterflow.session import work_dir

ORDER = ["capture_file", "split_start", "pos"]


def folder(spark, files):
    """A fresh capture folder with the given files (path below it -> bytes)."""
    import os

    root = work_dir(spark, "captures").removeprefix("file://")
    for name, data in files.items():
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "wb") as f:
            f.write(data)
    return root


def frame(texts):
    """The state machine, one capture at a time: trimmed lines of whole telegrams."""
    out = []
    for text in texts:
        open_, lines = False, []
        for line in text.split("\n"):
            line = line.strip()
            if not open_ and line.startswith("/"):
                open_, lines = True, []
            if open_ and line:
                lines.append(line)
                if line.startswith("!"):
                    out += lines
                    open_ = False
    return sorted(out)


def framed(df, capture):
    return sorted(r.line for r in frame_lines(df, capture=capture, order=ORDER, block=capture_block()).collect())


def test_same_named_files_stay_apart(spark):
    root = folder(spark, {"x/a.txt": b"/X\nx1\n", "y/a.txt": b"y1\n!Y\n"})
    df = capture_source(spark, root)
    assert df.count() == 4 and framed(df, ["capture_file"]) == []


def test_only_lf_ends_a_line(spark):
    root = folder(spark, {"m/a.txt": b"/X\r\nvalue*kW)\rtail\n!1\r\n"})
    df = capture_source(spark, root)
    assert df.count() == 3
    assert framed(df, ["capture_file"]) == sorted(["/X", "value*kW)\rtail", "!1"])


def test_nested_folders_are_read_and_a_meter_filter_prunes(spark):
    root = folder(spark, {"a/b/c.txt": b"1\n2\n", "d.txt": b"3\n"})
    assert sorted(r.line for r in capture_source(spark, root).collect()) == ["1", "2", "3"]
    root = folder(spark, {"meter_id=1/a.txt": b"one\n", "meter_id=2/a.txt": b"two\n"})
    df = capture_source(spark, root, where="meter_id = 1")
    assert [r.line for r in df.collect()] == ["one"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "meter_id" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_capture_of_many_splits_equals_the_state_machine(spark):
    rng = random.Random(5)
    texts = ["\n".join(rng.choice(["/S", "!e", "", "  line", "v\r", "noise"]) for _ in range(4000)) + "\n" for _ in range(3)]
    root = folder(spark, {f"m{i}/a.txt": t.encode() for i, t in enumerate(texts)})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = capture_source(spark, root)
        assert df.select("capture_file", "split_start").distinct().count() > 12
        assert framed(df, ["capture_file"]) == frame(texts)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert df.where(F.col("line").isNull()).count() == 0


def test_written_captures_are_files_per_meter_in_order(spark):
    rows = [(i % 5 if i % 7 else None, i, None if i == 9 else f"/S{i}\r\nv\n!{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "meter_id long, seq long, text string").repartition(4)
    path = work_dir(spark, "captures")
    write_captures(df, path, "meter_id", ["seq"], "text")
    root = path.removeprefix("file://")
    names = {d: sorted(os.listdir(f"{root}/{d}")) for d in os.listdir(root)}
    assert sorted(names) == ["meter_id=0", "meter_id=1", "meter_id=2", "meter_id=3", "meter_id=4", "meter_id=__HIVE_DEFAULT_PARTITION__"]
    # No checksum files, no files of tasks that did not end.
    assert all(n.startswith("part-") and n.endswith(".txt") for d in names.values() for n in d)
    for d, files in names.items():
        meter = int(d[9:]) if d[9:].isdigit() else None
        data = b"".join(open(f"{root}/{d}/{n}", "rb").read() for n in files)
        assert data == "".join((t or "") + "\n" for m, _, t in rows if m == meter).encode()
    lines = capture_source(spark, path)
    assert lines.select("meter_id").distinct().count() == 6 and lines.count() == 299 * 3 + 1


def test_folders_are_listed_by_few_tasks(spark):
    root = folder(spark, {f"meter_id={i}/a.txt": b"x\n" for i in range(200)})
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, group = spark.conf.get(name), "listing"
    spark.sparkContext.setJobGroup(group, group)
    try:
        df = capture_source(spark, root)
    finally:
        spark.sparkContext.setJobGroup("", "")
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages) <= 40
    assert spark.conf.get(name) == before and df.count() == 200
