import hashlib
import random
import re
import time

import meterflow.llm.pii as pii
from meterflow.llm.queries import op9_pii

from .util import SF, docs_of, documents

PLAIN = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
)


def luhn(digits):
    odd = [int(c) for c in digits[-1::-2]]
    even = [sum(divmod(2 * int(c), 10)) for c in digits[-2::-2]]
    return (sum(odd) + sum(even)) % 10 == 0


def brute(text):
    out = []
    for kind, (name, pattern) in enumerate(PLAIN):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {"email": True, "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}
            if name == "ip":
                fits["ip"] = all(int(p) <= 255 for p in m[0].split("."))
            if fits[name]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def found(df):
    return sorted(((r.doc_id, [tuple(s) for s in r.base]) for r in pii.find_pii(df).collect()), key=str)


def test_random_texts(spark):
    rng = random.Random(1)
    letters = "0123456789.+@- ()a_%\n12345é😀"
    pairs = [(i, "".join(rng.choices(letters, k=rng.randrange(60)))) for i in range(1500)]
    pairs += list(enumerate(["a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "0001.2.3.255 256.1.1.1", "4111 1111 1111 1111", "+1 (017) 555-7713", None, "", "+1 234 567 89", "a@b.c a@b.c"], 5000))
    pairs += [(5000, "a@b.c_d@e.f"), (None, "x@y.z")]
    assert found(docs_of(spark, pairs)) == sorted(((d, brute(t)) for d, t in pairs), key=str)


def test_very_long_texts_take_linear_time(spark):
    pairs = list(enumerate(["1" * 200_000, "a" * 200_000, "1 " * 50_000, "+1" + " " * 100_000, "1.2.3.4 " * 5000, "x" * 100_000 + "@y.z"]))
    want = sorted(((d, brute(t)) for d, t in pairs), key=str)  # the plain expressions are quadratic: not timed
    began = time.time()
    assert found(docs_of(spark, pairs)) == want
    assert time.time() - began < 120


def test_documents_and_empty_table(spark):
    docs = documents(spark)
    want = sorted(((r.doc_id, brute(r.text)) for r in docs.select("doc_id", "text").collect()), key=str)
    assert found(docs) == want
    assert found(docs_of(spark, [])) == []


def test_bootstrap_finds_identifiers_that_no_base_expression_matches(spark):
    cards = [4000000000000000 + 7919 * i for i in range(4000)]
    good = [str(c) for c in cards if luhn(str(c))][:30]
    bad = [str(c) for c in cards if not luhn(str(c))][:2]
    pairs = [(i, f"please charge card {c} today") for i, c in enumerate(good)]
    pairs += [(100, f"we kept card {bad[0]} on file"), (101, f"the year {bad[1]} or 1999 has no card"), (102, "item 12 of 99")]
    out = {r.doc_id: [tuple(s) for s in r.added] for r in pii.find_pii(docs_of(spark, pairs)).collect()}
    assert out[100] == [(13, 4, 29)]
    assert not any(v for k, v in out.items() if k != 100)


def added(spark, pairs):
    text = dict(pairs)
    rows = pii.find_pii(docs_of(spark, pairs)).collect()
    return {r.doc_id: [text[r.doc_id][a:b] for a, _, b in r.added] for r in rows if r.added}


def test_bootstrap_is_not_bound_to_the_form_of_the_seeds(spark):
    mails = [f"{n}@example.org" for n in ("anna", "bert", "cleo", "dora", "emil", "fred", "gina", "hugo", "iris", "jens")]
    phones = [f"+1 (743) 555-38{i}" for i in range(10, 40)]
    pairs = [(i, f"Please write to <{m}>, thanks.") for i, m in enumerate(mails)]
    pairs += [(i, f"the identifier: {c}\nwas given") for i, c in enumerate(phones, 100)]
    pairs += [(200, "they write to anna-at-example and wait"), (201, "her identifier: 123-45-6789."), (202, "his identifier: HVKQ"), (203, "an identifier: AB 12 cd\twas found"), (204, "nothing else is here")]
    # Seeds without digits, candidates of other forms, runs of words between two neighbours.
    assert added(spark, pairs) == {200: ["anna-at-example"], 201: ["123-45-6789"], 202: ["HVKQ"], 203: ["AB 12 cd"]}


def test_found_instances_bring_up_further_contexts(spark):
    mails = [f"{n}@example.org" for n in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    pairs = [(i, f"account: {m}") for i, m in enumerate(mails)]
    names = [f"user-{n}" for n in ("one", "two", "three", "four", "five", "six", "seven")]
    pairs += [(100 + i, f"account: {n}") for i, n in enumerate(names)] + [(200 + i, f"nickname {n}") for i, n in enumerate(names)]
    pairs += [(300, "nickname zorro"), (301, "no account here")]
    out = added(spark, pairs)
    assert out[300] == ["zorro"] and all(out[k] == [n] for b in (100, 200) for k, n in enumerate(names, b))


def test_query_digest(spark):
    text = {r.doc_id: r.text for r in documents(spark).collect()}
    for r in op9_pii(spark, SF).collect():
        spans = brute(text[r.doc_id])
        said = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == j for _, k, _ in spans) for j in range(4))
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))
