import math
import random
import re
from collections import Counter

import meterflow.llm.lexical_search as ls
import pytest

from .util import docs_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(pairs, items, top=10):
    bags = [Counter(terms(t)) for _, t in pairs]
    sizes = [sum(b.values()) for b in bags]
    n_docs, all_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for (doc, _), bag, n in zip(pairs, bags, sizes):
            score = 0
            for t in set(terms(text)) & set(bag):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 90 + ((90 * n * n_docs) // all_terms)
                score += w * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, doc) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def found(spark, pairs, items, **options):
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, term string")
    return sorted((tuple(r) for r in ls.search(docs_of(spark, pairs), bench, **options).collect()), key=str)


def random_corpus(seed, n, vocabulary=120):
    rng = random.Random(seed)
    words = [f"{w}{i}" for i, w in enumerate(["Été", "the", "日本", "X", "naïve"] * (vocabulary // 5))]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [", ".join(rng.choices(words, weights, k=rng.choice([0, 1, 5, 40, 300]))) for _ in range(n)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(12)))) for i in range(25)]
    return texts, items


@pytest.mark.parametrize("chars", [1 << 23, 3000, 200])
def test_random_corpora_equal_brute_force(spark, chars):
    texts, items = random_corpus(chars, 400)
    pairs = [((1 << 60) + 2 * i + 1, t) for i, t in enumerate(texts)]
    pairs += [(None, texts[5]), (None, None), (3, ""), (4, "..."), (5, texts[7]), (5, texts[7])]
    items += [(100, None), (101, ""), (102, "nowhere else"), (1, "the1 the1 THE1"), (1, "the1"), (None, "x3")]
    assert found(spark, pairs, items, shard_chars=chars) == brute(pairs, items)
    assert found(spark, pairs, items, top=3, shard_chars=chars) == brute(pairs, items, 3)


def test_ties_are_broken_by_id_across_shards(spark):
    pairs = [(i, "same words here") for i in range(100, 0, -1)] + [(None, "same words here")] + [(200 + i, "other text") for i in range(50)]
    items = [(1, "same"), (2, "words here"), (3, "other same")]
    assert found(spark, pairs, items, shard_chars=300) == brute(pairs, items)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, None), (2, "-")], [(1, "a")]) == []


def test_items_in_several_blocks(spark, monkeypatch):
    texts, items = random_corpus(9, 100)
    monkeypatch.setattr(ls, "ITEM_CHARS", 120)
    pairs = list(enumerate(texts))
    assert found(spark, pairs, items) == brute(pairs, items)


def shards_of(texts, size, block, monkeypatch):
    """The index in this process, a shard of ``size`` documents each."""
    import pyarrow as pa

    monkeypatch.setattr(ls, "BLOCK", block)
    sizes = [len(terms(t)) for t in texts]
    n_docs, out = sum(n > 0 for n in sizes), []
    for lo in range(0, len(texts), size):
        shard = ls._Shard()
        shard.add(list(range(lo, min(lo + size, len(texts)))), texts[lo : lo + size])
        out.append(pa.Table.from_batches(list(shard.batches(lo, n_docs, sum(sizes)))))
    return out, n_docs


@pytest.mark.parametrize("size, block", [(50, 4), (1000, 16), (2000, 8)])
def test_small_blocks_and_rejection_before_unpacking(monkeypatch, size, block):
    rng = random.Random(size)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(3000)], k=rng.randrange(5, 80))) for _ in range(2000)]
    # Rare words beside very common ones.
    items = [(i, " ".join(rng.sample(words[:20], 4) + rng.sample(words[150:500], 2))) for i in range(30)]
    tables, n_docs = shards_of(texts, size, block, monkeypatch)
    df = Counter(t for text in texts for t in set(terms(text)))
    opened = Counter()
    unpack = ls.Lists._unpack
    monkeypatch.setattr(ls.Lists, "_unpack", lambda self, at, lo, hi: (opened.update(n=hi - lo), unpack(self, at, lo, hi))[1])
    got, postings = [], 0
    for item, text in items:
        query_terms = sorted({t for t in terms(text) if t in df})
        hashes = ls.term_hashes([" ".join(query_terms)])[0]
        weights = ls.np.array([ls.weight_of(n_docs, df[t]) for t in query_terms], ls.np.int64)
        heap = ls.Heap(10)
        for table in tables:
            lists = ls.Lists(table)
            postings += int(lists.sizes[ls.np.isin(lists.terms, hashes)].sum())
            ls.search_shard(lists, ls.Query(hashes, weights), heap)
        got += [(item, rank, int(d), int(s)) for rank, (s, d) in enumerate(zip(heap.score, heap.id), 1)]
    assert sorted(got, key=str) == brute(list(enumerate(texts)), items)
    assert opened["n"] <= 0.75 * postings


def test_lists_with_wide_counts(spark):
    pairs = [(1, "a " * 70_000 + "b"), (2, "a b " * 300), (3, "b")]
    items = [(1, "a"), (2, "a b")]
    assert found(spark, pairs, items) == brute(pairs, items)
