import collections
import random
import re

import meterflow.llm.decontaminate as dec

from .util import SF, docs_of, documents


def words(t):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (t or "").lower())


def bag(w):
    return collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)])


def window_bags(w, n):
    k = min(n, 5)
    for p in range(max(len(w) - n, 0) + 1):
        part = w[p : p + n]
        yield p, collections.Counter(tuple(part[i : i + k]) for i in range(len(part) - k + 1))


def brute(pairs, items):
    out = []
    for d, t in pairs:
        w = words(t)
        for i, u in items:
            v = words(u)
            best = None
            for p, b in window_bags(w, len(v)) if v else ():
                both, union = sum((b & bag(v)).values()), sum((b | bag(v)).values())
                if both and 100 * both >= 80 * union and (best is None or both / union > best[0]):
                    best = (both / union, p)
            if best:
                out.append((d, i, round(best[0], 9), best[1], len(v)))
    return sorted(out, key=str)


def found(df, bench):
    return sorted(((r.doc_id, r.item_id, round(r.similarity, 9), r.start_word, r.n_words) for r in dec.find_matches(df, bench).collect()), key=str)


def bench_of(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, keys string")


def test_edited_passages_against_brute_force(spark):
    rng = random.Random(3)
    items = [(i, " ".join(f"w{rng.randrange(900)}" for _ in range(rng.choice((1, 3, 5, 12, 30, 60, 150))))) for i in range(25)]
    items += [(90, None), (91, "  ,, "), (92, "dup " * 20), (93, items[5][1]), (None, items[7][1])]
    pairs = []
    for d in range(80):
        text = [f"w{rng.randrange(900)}" for _ in range(rng.randrange(40))]
        v = words(rng.choice(items)[1])
        for _ in range(rng.randrange(4)):
            if v:
                at = rng.randrange(len(v))
                v[at : at + rng.randrange(2)] = ["new"] * rng.randrange(2)
        pairs.append((d, " ".join(text + v + text[::-1]).upper() if d % 5 == 0 else ", ".join(text + v)))
    pairs += [(200, None), (201, ""), (202, "dup " * 500), (203, pairs[4][1]), (203, pairs[4][1]), (None, items[4][1])]
    want = brute(pairs, items)
    assert len(want) > 30
    assert found(docs_of(spark, pairs), bench_of(spark, items)) == want


def test_documents_that_are_a_cut_item(spark):
    rng = random.Random(8)
    items = [(i, " ".join(f"w{rng.randrange(900)}" for _ in range(n))) for i, n in enumerate((9, 10, 14, 19, 24, 30, 31, 60, 150))]
    pairs = [(0, " ".join(words(items[5][1])[:26]))]
    for i, t in items:
        v = words(t)
        for percent in (10, 12, 15, 18, 20):
            cut = len(v) * percent // 100
            pairs += [(len(pairs), " ".join(v[: len(v) - cut])), (len(pairs) + 1, " ".join(v[cut:])), (len(pairs) + 2, " ".join(v[cut // 2 : len(v) - cut + cut // 2]))]
    want = brute(pairs, items)
    assert (0, 5, round(22 / 26, 9), 0, 30) in want and len(want) > 60
    bench, docs = bench_of(spark, items), docs_of(spark, pairs)
    assert found(docs, bench) == want
    assert {r.doc_id for r in dec.clean_documents(docs, bench).collect()} == {d for d, _ in pairs} - {w[0] for w in want}


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = found(documents(spark), bench)
    assert whole
    monkeypatch.setattr(dec, "BLOCK_ITEMS", 7)
    assert found(documents(spark), bench) == whole
    left = dec.clean_documents(documents(spark), bench)
    assert left.columns == documents(spark).columns
    assert {r.doc_id for r in documents(spark).collect()} - {r.doc_id for r in left.collect()} == {w[0] for w in whole}


def test_empty_tables(spark):
    assert found(docs_of(spark, []), bench_of(spark, [(1, "a b c d e f")])) == []
    assert found(docs_of(spark, [(1, "a b c d e f")]), bench_of(spark, [])) == []
    assert dec.clean_documents(docs_of(spark, [(1, "a")]), bench_of(spark, [])).count() == 1
