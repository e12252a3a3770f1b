import random

from pyspark.sql import functions as F

from meterflow.operators.framing import frame_lines
from meterflow.operators.scan import block_of


def model(lines):
    """Plain state machine: telegram number = count of end lines before its end line."""
    out, cur, reading, bangs = [], [], False, 0
    for i, raw in enumerate(lines):
        t = raw.strip()
        if not reading:
            if t.startswith("/"):
                reading, cur = True, [(i, t)]
        else:
            if t:
                cur.append((i, t))
            if t.startswith("!"):
                out += [(bangs, j, s) for j, s in cur]
                reading, cur = False, []
        if t.startswith("!"):
            bangs += 1
    return out


PIECES = ["/SYN5", "", "  ", "!0000", "!", "noise", "1-0:1.8.1(000001.000*kWh)", "\r", " /X", "  !12", "0-0:1.0.0(240101000000W)"]


def run(spark, captures, block_rows):
    rows = [(c, i, l) for c, lines in captures.items() for i, l in enumerate(lines)]
    df = spark.createDataFrame(rows, "cap string, line_no long, line string")
    got = frame_lines(df, ["cap"], ["line_no"], block_of(F.col("line_no"), block_rows)).collect()
    return sorted((r.cap, r.telegram_no, r.line_no, r.line) for r in got)


def test_edges(spark):
    captures = {
        "noise_then_two": ["junk", "/A", "", "x", "!1", "/B", "y", "!2"],
        "idle_bang": ["!", "/A", "x", "!"],
        "slash_inside": ["/A", "/B", "x", "!"],
        "eof_inside": ["/A", "x", "!", "/B", "y"],
        "empty": [],
        "crlf": ["/A\r", "x\r", "!9\r"],
    }
    want = sorted((c, n, i, s) for c, lines in captures.items() for (n, i, s) in model(lines))
    assert run(spark, captures, 2) == want
    assert ("eof_inside", 1, 3, "/B") not in want


def test_random_against_model(spark):
    rnd = random.Random(3)
    captures = {f"c{i}": [rnd.choice(PIECES) for _ in range(rnd.randint(0, 80))] for i in range(25)}
    want = sorted((c, n, i, s) for c, lines in captures.items() for (n, i, s) in model(lines))
    for block_rows in (3, 1 << 20):
        assert run(spark, captures, block_rows) == want
