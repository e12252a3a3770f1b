import itertools
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest

import meterflow.llm.components as components
import meterflow.llm.jaccard_join as jj
from meterflow.llm.jaccard_join import keep_first, similar_components

from .util import docs_of, documents


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute(pairs, k, percent):
    sets = [shingles(t, k) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(pairs)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            root[max(find(i), find(j))] = min(find(i), find(j))
    out = []
    for i, (d, _) in enumerate(pairs):
        ids = [pairs[j][0] for j in range(len(pairs)) if find(j) == find(i)]
        out.append((d, len(sets[i]), min((x for x in ids if x is not None), default=None)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def near_copies(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    pairs, common = [], rng.sample(words, 9)
    for size in (4, 9, 12, 20, 33, 60, 120, 400):
        for _ in range(6):
            base = rng.choices(words, k=size)
            if rng.random() < 0.5:
                base[: min(9, size)] = common[:size]
            pairs.append(" ".join(base))
            for _ in range(4):
                near = list(base)
                for _ in range(rng.randint(0, max(1, size // 25))):
                    at = rng.randrange(len(near))
                    near[at : at + rng.randint(0, 1)] = [rng.choice(words)] * rng.randint(0, 1)
                pairs.append(" ".join(near).upper() if rng.random() < 0.2 else "\t".join(near))
    rng.shuffle(pairs)
    return list(enumerate(pairs))


def test_near_copies_of_all_sizes_against_brute_force(spark):
    for k, percent in ((3, 90), (5, 80)):
        pairs = near_copies(percent)
        want = brute(pairs, k, percent)
        assert len({c for _, _, c in want}) < len(pairs) - 40
        assert found(similar_components(docs_of(spark, pairs), k, percent)) == want


def test_cases(spark):
    pairs = [(5, "a b c d"), (3, "A B c\nd"), (None, "a b c d"), (9, None), (8, ""), (7, " \n"), (4, "x"), (4, "x"), (2, "X"), (6, "x y"), (None, "solo words here now"), (10, "z " * 60_000)]
    assert found(similar_components(docs_of(spark, pairs), 3, 90)) == brute(pairs, 3, 90)


def test_empty_table(spark):
    assert found(similar_components(docs_of(spark, []), 3, 90)) == []


def test_documents_against_brute_force(spark):
    docs = documents(spark)
    pairs = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(similar_components(docs, 3, 90)) == brute(pairs, 3, 90)


def test_keep_first(spark):
    docs = docs_of(spark, [(3, "a b c d e f"), (1, "a b c d e f"), (2, "other words in this text"), (4, None)])
    out = keep_first(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 2, 4]


def test_sketches_of_linked_sets_stay_within_the_limit():
    rng = np.random.default_rng(5)
    for percent in (80, 90):
        for n in (1, 7, 40, 300, 511, 2000, 20_000):
            gap = (100 - percent) * n // (100 + percent)  # as many replaced on one side as a link allows
            a = rng.integers(0, 2**64, n, dtype=np.uint64)
            b, c = a.copy(), rng.integers(0, 2**64, n, dtype=np.uint64)
            b[:gap] = c[:gap]
            owner = np.zeros(n, np.int64)
            sa, sb, sc = (jj.sketches(np.sort(x), owner, 1)[0].view(np.uint64) for x in (a, b, c))
            near, far = (int(np.bitwise_count(sa ^ x).sum()) for x in (sb, sc))
            assert near <= min(2 * gap, jj.sketch_limit(percent))
            assert n < 300 or far > jj.sketch_limit(percent)


def test_block_pairs_keep_linked_sets_of_any_sign():
    """Sketches are signed longs: sets at the limit of a link must come back whichever their top bits are."""
    rng = np.random.default_rng(11)
    rows, want = [], set()
    for pair in range(200):
        n = int(rng.integers(100, 500))
        gap = 20 * n // 120
        a, c = (rng.integers(0, 2**64, n, dtype=np.uint64) for _ in range(2))
        b = a.copy()
        b[: gap // 2] = c[: gap // 2]
        for i, x in enumerate((a, b)):
            cid = 2 * pair + i
            sketch = jj.sketches(np.sort(x), np.zeros(n, np.int64), 1)[0]
            rows.append({"sig": 7, "i": 0, "j": 0, "blk": 0, "cid": cid, "root": cid, "n": n} | dict(zip(jj.PARTS, sketch)))
        want.add((2 * pair, 2 * pair + 1))
    out = pd.concat(jj._block_pairs(80)(iter([pd.DataFrame(rows)])))
    assert want <= set(zip(out["a"].tolist(), out["b"].tolist()))
    assert len(out) < 2 * len(want)


def test_links_found_by_blocks_alone(spark, monkeypatch):
    """Without rounds of centres every pair of a key is decided by the blocks."""
    monkeypatch.setattr(jj, "CENTRES", 0)
    for k, percent in ((3, 90), (5, 80)):
        pairs = near_copies(percent + 1)
        assert found(similar_components(docs_of(spark, pairs), k, percent)) == brute(pairs, k, percent)


def family(seed, variants=600, size=200):
    """Texts that each differ from one base in a few words: most pairs are similar, but few are linked."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(4000)}" for _ in range(size)]
    out = []
    for _ in range(variants):
        near = list(base)
        for _ in range(rng.randint(2, 8)):
            near[rng.randrange(size)] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(near))
    return list(enumerate(out))


def counted(monkeypatch):
    """Rows of every table that is written out."""
    rows, write = [], jj.materialise

    def materialise(df, name):
        out = write(df, name)
        rows.append((out.count(), name))
        return out

    monkeypatch.setattr(jj, "materialise", materialise)
    return rows


def test_similar_sets_do_not_expand_into_their_pairs(spark, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK", 100)  # several blocks a key
    rows = counted(monkeypatch)
    pairs = family(3)
    want = brute(pairs, 3, 90)
    assert 1 < len({c for _, _, c in want}) < len(pairs)
    monkeypatch.setattr(jj, "CENTRES", 0)
    assert found(similar_components(docs_of(spark, pairs), 3, 90)) == want
    buckets = next(n for n, name in rows if name == "buckets")
    sets = [n for n, name in rows if name in ("set-pairs", "set-links")]
    assert sets and max(sets) < min(len(pairs) ** 2 // 20, buckets)


def test_blocks_of_few_shingles(spark, monkeypatch):
    """Blocks are cut by the shingles they hold too; sets of one key then meet across blocks."""
    monkeypatch.setattr(jj, "CENTRES", 0)
    monkeypatch.setattr(jj, "BLOCK_SHINGLES", 2000)
    pairs = near_copies(7) + [(1000 + i, t) for i, t in family(4, 60)]
    assert found(similar_components(docs_of(spark, pairs), 3, 90)) == brute(pairs, 3, 90)


def test_pairs_are_unpacked_few_at_a_time(monkeypatch):
    monkeypatch.setattr(jj, "SET_BYTES", 1000)
    bodies = [jj_pack(f"{i} " + "x " * 200) for i in range(50)]
    right = [bodies[0]] * 50
    parts = list(jj._texts_of_pairs(bodies, right))
    assert [p[0] for p in parts[1:]] == [p[1] for p in parts[:-1]] and parts[0][0] == 0 and parts[-1][1] == 50
    assert all(len(texts) <= 5 and all(bodies[i] in texts and right[i] in texts for i in range(lo, hi)) for lo, hi, texts in parts)


def jj_pack(text):
    return zlib.compress(text.encode(), 1)


@pytest.fixture
def many_partitions(spark):
    """A session whose shuffles have far more partitions than small tables need."""
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def files_written(monkeypatch, module):
    """Files of every table that ``module`` writes out, one for each task that had rows."""
    files, write = [], module.materialise

    def materialise(df, name):
        out = write(df, name)
        files.append((len(out.inputFiles()), name))
        return out

    monkeypatch.setattr(module, "materialise", materialise)
    return files


def test_components_take_no_more_tasks_than_their_links_need(spark, monkeypatch, many_partitions):
    files = files_written(monkeypatch, components)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 500)] + [(i, i - 7) for i in range(1007, 1100)]
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    want = sorted((x, find(x)) for x in root if find(x) != x)
    assert sorted(map(tuple, components.connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect())) == want
    assert max(n for n, _ in files[1:]) <= 2 * spark.sparkContext.defaultParallelism


def test_components_end_with_the_second_star_that_changes_nothing(spark, monkeypatch):
    files = files_written(monkeypatch, components)
    stars = [(100 * (i // 100), i) for i in range(1, 300) if i % 100]
    assert sorted((r, n) for n, r in components.connected(spark.createDataFrame(stars, "a bigint, b bigint")).collect()) == stars
    assert len(files) == 3


def test_small_tables_of_the_join_take_few_tasks(spark, monkeypatch, many_partitions):
    files = files_written(monkeypatch, jj)
    pairs = near_copies(5) + [(5000 + i, t) for i, t in family(6, 150)]
    monkeypatch.setattr(jj, "CENTRES", 1)
    assert found(similar_components(docs_of(spark, pairs), 3, 90)) == brute(pairs, 3, 90)
    small = [(n, name) for n, name in files if name not in ("set-classes", "buckets")]
    assert {"near-pairs", "set-texts", "set-links", "block-sets"} <= {name for _, name in small}
    assert max(small)[0] <= 2 * spark.sparkContext.defaultParallelism, max(small)
