import collections
import hashlib
import random

from meterflow.llm.substring_dedup import remove_repeats

from .util import docs_of, documents


def brute(pairs, window):
    words = [(t or "").encode().split() for _, t in pairs]
    seen = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(pairs, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def test_passages_branches_and_loops(spark):
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(5000)}"
    passage = [[word() for _ in range(n)] for n in (34, 35, 36, 50, 90, 200)]
    pairs = []
    for i in range(60):
        text = [word() for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passage)
            lo = rng.randrange(len(p) // 3 + 1)
            text += p[lo : len(p) - rng.randrange(len(p) // 4 + 1)] + [word() for _ in range(rng.randrange(30))]
        pairs.append((i, " ".join(text)))
    pairs += [(100, "a " * 34), (101, "b " * 35), (102, "c " * 36), (103, "d e " * 40), (104, None), (105, ""), (106, " ".join(passage[5]))]
    pairs += [(107, pairs[3][1]), (108, " ".join(str(i) for i in range(30_000))), (109, "x " + "y" * 100_000), (110, " ".join(passage[4])), (110, " ".join(passage[4])), (None, "n " * 40)]
    assert found(remove_repeats(docs_of(spark, pairs))) == brute(pairs, 35)


def test_documents_against_brute_force(spark):
    docs = documents(spark)
    pairs = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(remove_repeats(docs)) == brute(pairs, 35)


def test_small_window_and_empty_table(spark):
    pairs = [(1, "a b c d e f"), (2, "x b c d y"), (3, "b c d")]
    assert found(remove_repeats(docs_of(spark, pairs), window=3, k=2)) == brute(pairs, 3)
    assert found(remove_repeats(docs_of(spark, []))) == []
