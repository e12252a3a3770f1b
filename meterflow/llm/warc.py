"""WARC archives with a two-level capture index.

Writing: every task writes archive files of its rows into the shared folder, one
gzip member per record, and reports each record's file, offset and length. The
report is written as a table; only records in it count, so a task that is run
again leaves nothing but an unread file behind. Of records with equal payloads of
at least ``REVISIT_BYTES`` the one with the largest id is the response and the
others are revisits that refer to it. The payload is not shuffled for that: only
digests that occur more than once are joined to it.

Index: captures are range-partitioned and sorted by reversed-host URL and id.
Each part is a file of compressed blocks of ``BLOCK_LINES`` lines and a sparse
directory with the first key of each block. The top level has the key range of
each part, as many rows as there are parts.

Lookup: requests are range-partitioned and sorted the same way. A task bisects
the top level, then that part's directory, reads the one block (a range read),
bisects its lines, and range-reads the records. Nothing else of an archive is
read.

Defined cases: a null payload is empty; a null URL has the key ``-``; a null id
is kept as null and ranks below all others; rows that repeat id and URL are
records of their own, all found under their key; repeated rows of the largest id
are all responses. Payloads and URLs of any length are written whole; line ends
and blanks in a URL are percent-encoded in the archive. Extra columns are
ignored. An empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm.common import materialise
from meterflow.session import work_dir

REVISIT_BYTES = 1000
BLOCK_LINES = 512
ARCHIVE_BYTES = 256 << 20  # an archive file is closed after this many bytes
DATE = "2000-01-01T00:00:00Z"  # pages carry no time of capture
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CAPTURE = "key string, page_id bigint, file string, offset bigint, length bigint"
_CAPTURE_NAMES = ["key", "page_id", "file", "offset", "length"]
_CAPTURE_TYPES = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
READ_BYTES = 1 << 24  # of the archives that one task of a full read takes, about
_URL = re.compile(r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?(?P<host>\[[^\]]*\]|[^/?#:]*)(?::(?P<port>\d*))?(?P<rest>[^#]*)", re.I | re.S)
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def _safe(url: str) -> str:
    return _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)


def url_key(url: str | None) -> str:
    """Reversed-host sort key: ``https://a.example.org/x?y#z`` is ``org,example,a)/x?y``."""
    if url is None:
        return "-"
    m = _URL.match(_safe(url))
    if m is None:
        return _safe(url)
    host = ",".join(reversed(m["host"].lower().strip(".").split(".")))
    port = "" if m["port"] in (None, "", "80", "443") else ":" + m["port"]
    return f"{host}{port}){m['rest'] or '/'}"


def capture_key(url: str | None, page_id: int | None) -> str:
    """URL key and id; ids sort as numbers, null first."""
    return f"{url_key(url)} {0 if page_id is None else page_id + (1 << 63) + 1:020d}"


def _record_id(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id, url, payload: bytes, digest: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC record, uncompressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {_safe(url)}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        *([f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {_PROFILE}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of one record; the payload of a response is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).digest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda f: None if f is None or f == "<urn:page:null>" else int(f[10:-1])
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "payload_bytes": size,
        "payload_digest": digest.hex(),
        "record_type": kind,
        "refers_to": number(fields.get("WARC-Refers-To")),
        "payload": payload if kind == "response" else None,
    }


def _file_system(path: str):
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path if re.match(r"^[a-z][a-z0-9+.-]*:", path) else f"file://{path}")
    return system, inner


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all rows as records below ``path``; the table of captures."""
    body = F.coalesce(F.col(html_col).cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    large = rows.where(F.octet_length("payload") >= REVISIT_BYTES)
    again = large.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("response")).where("n > 1")
    again = materialise(again.select("digest", "response"), "repeated-digests")
    rows = rows.join(again.withColumn("known", F.lit(True)), "digest", "left")
    revisit = F.col("known").isNotNull() & (F.octet_length("payload") >= REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(F.col("response"))
    rows = rows.select("page_id", "url", "payload", "digest", "response", revisit.alias("revisit"))

    # Arrow, not pandas: a null would turn a column of ids to floats.
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(path)
        system.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        try:
            for b in batches:
                found = []
                for values in zip(*b.columns):
                    page, url, payload, digest, response, again = (v.as_py() for v in values)
                    data = record(page, url, payload, digest, response if again else None, again)
                    data = gzip.compress(data, 6, mtime=0)
                    if out is not None and at + len(data) > ARCHIVE_BYTES:
                        out.close()
                        out = None
                    if out is None:
                        name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{base}/{name}", compression=None)
                    out.write(data)
                    found.append((capture_key(url, page), page, name, at, len(data)))
                    at += len(data)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), _CAPTURE_TYPES)], names=_CAPTURE_NAMES)
        finally:
            if out is not None:
                out.close()

    return materialise(rows.mapInArrow(run, _CAPTURE), "captures")


@dataclass(frozen=True)
class Index:
    """Top level: ``first`` key, file of blocks and file of the directory of every part, in key order."""

    path: str
    archives: str
    first: list[str]
    names: list[str]


def build_index(captures: DataFrame, path: str, archives: str) -> Index:
    """Write the index of ``captures`` below ``path``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = _file_system(path)
        system.create_dir(base, recursive=True)
        out, name, directory, pending = None, "", [], []

        def block():
            data = gzip.compress("".join(pending).encode(), 6, mtime=0)
            directory.append((pending[0].split("\t", 1)[0], out.tell(), len(data)))
            out.write(data)
            pending.clear()

        for b in batches:
            for key, file, offset, length in zip(b["key"], b["file"], b["offset"], b["length"]):
                if out is None:
                    name = f"captures-{uuid.uuid4().hex}"
                    out = system.open_output_stream(f"{base}/{name}.blocks", compression=None)
                pending.append(f"{key}\t{file}\t{offset}\t{length}\n")
                if len(pending) >= BLOCK_LINES:
                    block()
        if out is not None:
            if pending:
                block()
            out.close()
            with system.open_output_stream(f"{base}/{name}.directory") as f:
                f.write(json.dumps(directory).encode())
            yield pd.DataFrame({"first": [directory[0][0]], "name": [name]})

    ordered = captures.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    top = materialise(ordered.select("key", "file", "offset", "length").mapInPandas(run, "first string, name string"), "capture-parts")
    parts = sorted((r["first"], r["name"]) for r in top.collect())  # one row per part
    return Index(path, archives, [p[0] for p in parts], [p[1] for p in parts])


class _Reader:
    """Range reads of one task; the files last used stay open, the directories and blocks last used stay read."""

    def __init__(self, index: Index):
        self.index = index
        self.system, self.base = _file_system(index.path)
        self.archive_system, self.archive_base = _file_system(index.archives)
        self.files: OrderedDict = OrderedDict()
        self.kept: OrderedDict = OrderedDict()

    def read(self, system, path: str, offset: int, length: int) -> bytes:
        f = self.files.pop(path, None) or system.open_input_file(path)
        self.files[path] = f
        if len(self.files) > 64:
            self.files.popitem(last=False)[1].close()
        f.seek(offset)
        return f.read(length)

    def _keep(self, key, make):
        if key not in self.kept:
            self.kept[key] = make()
            if len(self.kept) > 16:
                self.kept.popitem(last=False)
        return self.kept[key]

    def directory(self, part: int) -> tuple[list, list[str]]:
        """Blocks of a part, and their first keys."""

        def make():
            with self.system.open_input_stream(f"{self.base}/{self.index.names[part]}.directory") as f:
                entries = json.loads(f.read())
            return entries, [e[0] for e in entries]

        return self._keep(part, make)

    def lines(self, part: int, n: int) -> tuple[list[list[str]], list[str]]:
        """Lines of a block, and their keys."""

        def make():
            _, offset, length = self.directory(part)[0][n]
            data = gzip.decompress(self.read(self.system, f"{self.base}/{self.index.names[part]}.blocks", offset, length))
            lines = [line.split("\t") for line in data.decode().split("\n")[:-1]]
            return lines, [x[0] for x in lines]

        return self._keep((part, n), make)

    def captures(self, key: str) -> Iterator[tuple[str, int, int]]:
        """File, offset and length of every capture with this key."""
        part = max(bisect_left(self.index.first, key) - 1, 0)
        while part < len(self.index.first) and self.index.first[part] <= key:
            _, firsts = self.directory(part)
            n = max(bisect_left(firsts, key) - 1, 0)
            while n < len(firsts) and firsts[n] <= key:
                lines, keys = self.lines(part, n)
                for _, file, offset, length in lines[bisect_left(keys, key) : bisect_right(keys, key)]:
                    yield file, int(offset), int(length)
                n += 1
            part += 1

    def close(self):
        for f in self.files.values():
            f.close()


_RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def lookup(spark: SparkSession, index: Index, requests: DataFrame, payload: bool = False, tasks: int | None = None) -> DataFrame:
    """Records of ``requests(url, page_id)``, one row per capture found, read by ``tasks`` tasks."""

    @F.pandas_udf("string")
    def key(url: pd.Series, page_id: pd.Series) -> pd.Series:
        return pd.Series([capture_key(u, None if pd.isna(p) else int(p)) for u, p in zip(url, page_id)], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(index)
        try:
            for b in batches:
                places = [c for k in b.column("key").to_pylist() for c in reader.captures(k)]
                rows = []
                for file, offset, length in sorted(places):
                    data = reader.read(reader.archive_system, f"{reader.archive_base}/{file}", offset, length)
                    row = parse(zlib.decompress(data, 31))
                    rows.append([row[c] for c in columns])
                    if payload and len(rows) >= 256:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)
        finally:
            reader.close()

    schema = _RECORD + (", payload binary" if payload else "")
    columns = [c.strip().split(" ")[0] for c in schema.split(",")]
    kinds = [{"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.strip().split(" ")[1]] for c in schema.split(",")]

    def batch_of(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=columns)

    # Ids pass through as text: a null would turn a pandas column to floats.
    keyed = requests.select(key(F.col("url").cast("string"), F.col("page_id").cast("bigint").cast("string")).alias("key")).distinct()
    keyed = keyed.repartitionByRange(tasks, "key") if tasks else keyed.repartitionByRange("key")
    return keyed.sortWithinPartitions("key").mapInArrow(run, schema)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Archive all pages, index them, and read every record back through the index."""
    spark = pages.sparkSession
    archives, index = work_dir(spark, "warc"), work_dir(spark, "warc-index")
    captures = write_archives(pages, archives)
    # Keys are small, what they stand for is not: the tasks go by the archives' size.
    size = captures.agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // READ_BYTES))
    return lookup(spark, build_index(captures, index, archives), pages.select("url", "page_id"), tasks=tasks)
