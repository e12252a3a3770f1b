import gzip
import hashlib

import pytest

from meterflow.llm import warc
from meterflow.session import work_dir

SCHEMA = "page_id bigint, url string, html string, key string, file string, digest string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)


def expected(rows):
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        same = [j for j, _, g in rows if len(data) >= 1000 and (g or "") == (h or "")]
        top = max((j for j in same if j is not None), default=None)
        again = len(same) > 1 and i != top
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a.example.org/x", "p" * 1000),
    (2, "http://b.example.org/x", "p" * 1000),
    (3, "http://b.example.org/x", "p" * 999),
    (4, "http://b.example.org/x", "p" * 999),
    (5, None, None),
    (6, "", ""),
    (7, "http://h/ a\r\nb\t?q=é#frag", "line\r\n\r\nWARC/1.1\r\n\r\n" * 100),
    (8, "http://h/big", "é" * 700_000),
    (None, "http://h/null", "q" * 2000),
    (9, "http://h/q", "q" * 2000),
    (-3, "not a url", "é" * 700_000),
]


def test_cases_through_the_index(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    got = sorted((tuple(r) for r in warc.archive_and_read(pages_of(spark, ROWS)).collect()), key=str)
    assert got == expected(ROWS)


def test_repeated_rows_are_records_of_their_own(spark):
    rows = [(1, "http://a/", "s" * 1500)] * 3 + [(0, "http://a/", "s" * 1500)]
    got = sorted((tuple(r) for r in warc.archive_and_read(pages_of(spark, rows)).collect()), key=str)
    assert [r[3] for r in got] == ["revisit"] + ["response"] * 3 and got[0][4] == 1


def test_empty_table(spark):
    assert warc.archive_and_read(pages_of(spark, [])).collect() == []


def test_lookup_of_some_and_payloads(spark):
    archives, index = work_dir(spark, "warc"), work_dir(spark, "warc-index")
    pages = pages_of(spark, ROWS)
    ix = warc.build_index(warc.write_archives(pages, archives), index, archives)
    want = pages.where("page_id in (7, 8)").select("url", "page_id").union(spark.createDataFrame([("http://none/", 77)], "url string, page_id bigint"))
    got = {r.page_id: bytes(r.payload).decode() for r in warc.lookup(spark, ix, want, payload=True).collect()}
    assert got == {7: ROWS[6][2], 8: ROWS[7][2]}


def test_keys_sort_by_reversed_host():
    assert warc.url_key("https://user@A.Example.org:443/x?y#z") == "org,example,a)/x?y"
    assert warc.url_key("http://h:8080") == "h:8080)/"
    assert warc.capture_key(None, None) < warc.capture_key(None, -5) < warc.capture_key(None, 3)


def test_damage_is_noticed():
    data = warc.record(1, "http://a/", b"payload", hashlib.sha1(b"payload").digest())
    assert warc.parse(data)["payload"] == b"payload"
    assert gzip.decompress(gzip.compress(data)) == data
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"payload\r", b"paxload\r"))
