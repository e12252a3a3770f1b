import hashlib
import itertools
import math
import random
import re
import string

import meterflow.llm.secret_scan as sec
import numpy as np
from meterflow.llm.queries import op12_secrets

from .util import SF, docs_of

KEYWORD = "(" + "|".join("".join(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")).replace("[__][??]", "_?") + ")"
ASSIGN = re.compile(KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
NAMES = ("assign", "access", "hex", "format")


def brute(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    return sorted(out)


def found(df):
    return sorted(((r.doc_id, [tuple(s) for s in r.base]) for r in sec.find_secrets(df).collect()), key=str)


def test_base_spans_of_random_texts(spark):
    rng = random.Random(5)
    parts = ["token", "TOKEN", "Api_Key", "apikey", "api__key", "secret", "paſsword", "toKen", "password", "passwd", '"', "'", " ", "  ", "=", ":", "\n", "\t", "AKIA", "AKI", "A1B2C3D4", "0123456789abcdef", "deadbeef", "x", "é", "😀", "/", "+", "==", "-", "G"]
    pairs = [(i, "".join(rng.choices(parts, k=rng.randrange(30)))) for i in range(3000)]
    pairs += [(-1, None), (-2, ""), (None, 'token = "abcdefgh"'), (-3, 'token = "abcdefg'), (-4, "a" * 200_000), (-5, "token" * 50_000), (-6, "token" + " " * 300_000 + "x"), (-7, "AKIA" * 50_000)]
    pairs += pairs[:20] + [((1 << 60) + 1, "secret:ABCDEFGH")]
    assert found(docs_of(spark, pairs)) == sorted(((d, brute(t)) for d, t in pairs), key=str)


def test_empty_table(spark):
    assert found(docs_of(spark, [])) == []


def test_candidates_are_whole_runs_apart_from_base_spans():
    texts = ["see (abc-defgh.), _x_y_z_12_", "ab==", "longenough== and longenough=== or /path/to/file.", "token = abcdefghi.jk", "été1234567 12345678é", ""]
    scan = sec.Scan([t.encode() for t in texts])
    got = [scan.data[a:b].decode() for a, b in zip(*scan.candidates())]
    assert got == ["abc-defgh", "x_y_z_12", "longenough==", "longenough==", "path/to/file", "12345678"]


def random_automaton(rng, states=4):
    step = rng.integers(0, states, (states, sec.END))
    p = rng.dirichlet(np.ones(sec.END + 1), states)
    return sec.Automaton(step, np.log(p))


def test_batched_scores_equal_the_walk_one_by_one(monkeypatch):
    rng = np.random.default_rng(1)
    a, b = random_automaton(rng), random_automaton(rng)
    symbols = rng.integers(0, sec.END, 5000).astype(np.int8)
    starts = rng.integers(0, 4000, 300)
    ends = starts + rng.integers(1, 900, 300)
    want = np.array([a.score_one(symbols[s:e].tolist()) - 3 - b.score_one(symbols[s:e].tolist()) for s, e in zip(starts, ends)])
    for stepped in (1024, 100, 0):
        monkeypatch.setattr(sec, "STEPPED", stepped)
        assert np.allclose(sec.Model(b, [(a, -3.0)]).odds(symbols, starts, ends), want)


def test_likelihoods_are_a_distribution():
    a = sec.PrefixTree([[0, 1], [0], [1, 1, 0], [0, 1]] * 300).merged(0.05)
    assert np.allclose(np.exp(a.logp).sum(1), 1)
    by_length = [sum(math.exp(a.score_one(list(w))) for w in itertools.product(range(sec.END), repeat=n)) for n in range(4)]
    assert sum(by_length) <= 1 + 1e-9
    assert abs(by_length[1] - 0.25) < 0.02 and abs(by_length[2] - 0.5) < 0.02 and abs(by_length[3] - 0.25) < 0.02


def test_merging_keeps_counts_and_generalises():
    rng = random.Random(2)
    # Three letters, then a run of digits and letters a-f: a fixed head, a loop behind it.
    strings = [[4, 4, 3] + [rng.choice([0, 0, 1]) for _ in range(rng.randrange(10, 40))] for _ in range(800)]
    tree = sec.PrefixTree(strings)
    size = len(tree.visits)
    a = tree.merged(0.05)
    assert len(a.step) < 40 < size
    seen = a.score_one([4, 4, 3] + [0, 1, 0, 0, 1] * 5)
    assert seen > a.score_one([0, 1, 0, 0, 1] * 5 + [4, 4, 3]) + 10
    assert seen > a.score_one([4, 4, 3] + [2] * 25) + 50


def alnum(rng, n, letters=string.ascii_lowercase + string.digits):
    return "".join(rng.choices(letters, k=n))


def test_formats_are_learned_and_found_bare(spark):
    rng = random.Random(7)
    words = ["".join(rng.choices("etaoinshr", k=rng.randrange(2, 12))) for _ in range(800)]
    prose = lambda: " ".join(rng.choices(words, k=60))
    pairs = [(i, f"{prose()} secret: sk-{alnum(rng, 24)} {prose()}") for i in range(200)]
    pairs += [(200 + i, f"{prose()} token = '{alnum(rng, 40, string.hexdigits.upper()[:10] + 'ABCDEF')}' {prose()}") for i in range(100)]
    bare = {1000 + i: f"sk-{alnum(rng, 24)}" for i in range(40)}
    bare |= {2000 + i: alnum(rng, 40, "0123456789ABCDEF") for i in range(40)}
    pairs += [(i, f"{prose()} ({s}), {prose()}") for i, s in bare.items()]
    plain = ["mail3.example.com", "132.201.103.247", "4068516892505468", "2024-05-06T07:08:09", "/usr/local/lib/python", "WARNINGMESSAGE", "snake_case_name", "get-user-name"]
    pairs += [(5000 + i, f"{prose()} {w} {prose()}") for i, w in enumerate(plain * 10)]
    text = dict(pairs)
    got = {r.doc_id: [text[r.doc_id][a:b] for a, k, b in r.added if k == 3] for r in sec.find_secrets(docs_of(spark, pairs)).collect()}
    caught = sum(got[i] == [s] for i, s in bare.items())
    assert caught >= 0.9 * len(bare)
    assert not any(v for i, v in got.items() if i not in bare)


def test_query_digest(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = op12_secrets(spark, SF)
    assert out.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    rows = out.collect()
    assert len(rows) == len(text)
    for r in rows:
        spans = brute(text[r.doc_id])
        said = ",".join(f"{NAMES[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == j for _, k, _ in spans) for j in range(3))
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))
