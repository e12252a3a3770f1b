"""SentencePiece encoding and decoding with a batched trellis in numpy.

A text becomes units of white space and word; each distinct unit of a batch is
encoded once. Words of equal length advance together, one position at a time: at
every position all piece lengths are probed at once, substring hashes against
the sorted hashes of the pieces, and a maximum over the candidates stores the
back pointer. The value of a candidate is the value of the position it starts at,
plus the piece's score (unigram models), plus the score of following the last
piece there (BPE models: zero if the two pieces can stand side by side, else
minus infinity).

Why BPE models fit: the merge result of a string is the one segmentation in which
every two neighbours, merged on their own, stay as they are, and of any prefix
only one last piece satisfies that. So a first-order trellis with one state per
position finds what the merge loop finds. Two pieces can stand side by side if
undoing their merges, latest first, never meets a merge over the boundary that
would have come earlier. Words over ``LONG`` characters and runs of blanks go
through the merge loop itself (``Model.merge``), with the same result.

Characters without a piece become their UTF-8 bytes if the model has byte
pieces, else the unknown piece. The model file is read once on the driver and
sent to the tasks; its path is a parameter.

Defined cases: a null or empty text has no ids; decoding null gives an empty
text. Decoding an encoded text gives it back, but for U+2581, which the models
use for a blank and which comes back as one. Unknown ids raise an error.
Extra columns are ignored, repeated rows are each answered.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm.common import in_chunks, mix, powers

BLANK = "▁"
LONG = 48
_UNIT = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
_B = np.uint64(0x8CB92BA72F3D8DD7 | 5)
_NEVER = np.int64(1 << 40)
UNIGRAM, BPE = 1, 2


class Model:
    """Pieces of a model file, their hashes in sorted order, and for BPE how each piece was merged."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        with open(path, "rb") as f:
            spec = pb.ModelProto()
            spec.ParseFromString(f.read())
        norm = spec.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models without text normalisation are supported")
        self.kind = spec.trainer_spec.model_type
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError(f"model type {self.kind} is neither unigram nor BPE")
        self.prefix = norm.add_dummy_prefix
        self.pieces = [p.piece for p in spec.pieces]
        types = np.array([p.type for p in spec.pieces])
        self.scores = np.array([p.score for p in spec.pieces], np.float64)
        kinds = pb.ModelProto.SentencePiece
        self.byte = np.full(256, -1, np.int64)
        for i in np.flatnonzero(types == kinds.BYTE):
            self.byte[int(self.pieces[i][1:-1], 16)] = i
        self.unknown = int(np.flatnonzero(types == kinds.UNKNOWN)[0])
        self.control = set(np.flatnonzero(types == kinds.CONTROL).tolist())
        normal = np.flatnonzero(types == kinds.NORMAL)
        self.index = {self.pieces[i]: int(i) for i in normal}
        self.none = len(self.pieces)  # stands for a character without a piece
        self.floor = float(self.scores[normal].min()) - 10.0
        # Merge order: better score first. Atoms are never merged.
        self.rank = np.full(self.none + 1, -1, np.int64)
        order = normal[np.lexsort((normal, -self.scores[normal]))]
        self.rank[order] = np.unique(-self.scores[order], return_inverse=True)[1]
        self.atom = np.ones(self.none + 1, bool)
        self.left = np.full(self.none + 1, -1, np.int64)
        self.right = np.full(self.none + 1, -1, np.int64)
        usable = []
        for i in normal.tolist():
            p = self.pieces[i]
            if len(p) == 1 or self.kind == UNIGRAM:
                usable.append(i)
            elif p.strip(BLANK):
                halves = self.merge(p, last=False)
                if len(halves) == 2:  # else the merge loop never makes this piece
                    self.left[i], self.right[i] = halves
                    self.atom[i] = False
                    usable.append(i)
        self.length = np.array([len(p) for p in self.pieces] + [1], np.int64)
        self.hash = np.zeros(self.none + 1, np.uint64)
        for i in usable:
            self.hash[i] = _string_hash(self.pieces[i])
        self.hash[self.none] = np.uint64(0x1B873593CC9E2D51)
        use = np.array(usable)
        by = np.argsort(self.hash[use])
        self.keys, self.key_ids = self.hash[use][by], use[by]
        if len(np.unique(self.keys)) != len(self.keys):
            raise ValueError("two pieces share a hash")
        # One bit per hash prefix turns most misses away before the binary search.
        self.door = np.zeros(1 << 20, bool)
        self.door[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        self.longest = int(self.length[use].max())

    def probe(self, hashes: np.ndarray) -> np.ndarray:
        """Piece of each hash, -1 where there is none."""
        out = np.full(len(hashes), -1, np.int64)
        some = np.flatnonzero(self.door[(hashes >> np.uint64(44)).astype(np.int64)])
        wanted = hashes[some]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = self.keys[at] == wanted
        out[some[hit]] = self.key_ids[at[hit]]
        return out

    def merge(self, text: str, last: bool = True) -> list[int]:
        """The merge loop on one string: best score first, leftmost of equals.

        With ``last`` unset the final merge is left out.
        """
        part: list[str | None] = list(text)
        after = list(range(1, len(part) + 1))
        before = list(range(-1, len(part) - 1))
        heap: list[tuple[int, int, str]] = []

        def offer(i):
            j = after[i]
            if j < len(part):
                both = part[i] + part[j]
                k = self.index.get(both)
                if k is not None and (last or both != text):
                    heapq.heappush(heap, (int(self.rank[k]), i, both))

        for i in range(len(part) - 1):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i] if part[i] is not None else len(part)
            if j >= len(part) or part[i] + part[j] != both:
                continue
            part[i], part[j] = both, None
            after[i] = after[j]
            if after[i] < len(part):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [self.index.get(p, self.none if len(p) == 1 else -1) for p in part if p is not None]

    def side_by_side(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each two pieces stay apart when merged on their own."""
        out = np.ones(len(left), bool)
        rows = np.arange(len(left))
        a, b = left.copy(), right.copy()
        limit = np.full(len(left), _NEVER)
        up = powers(_B, self.longest + 1)
        while len(rows):
            both = self.probe(self.hash[a] * up[self.length[b]] + self.hash[b])
            clash = (both >= 0) & (np.where(both >= 0, self.rank[both], _NEVER) < limit)
            out[rows[clash]] = False
            go = ~clash & ~(self.atom[a] & self.atom[b])
            rows, a, b, limit = rows[go], a[go], b[go], limit[go]
            ra = np.where(self.atom[a], -1, self.rank[a])
            rb = np.where(self.atom[b], -1, self.rank[b])
            undo = ra > rb  # of equal merges the left one came first
            limit = np.where(undo, ra, rb + 1)
            a, b = np.where(undo, self.right[a], a), np.where(undo, b, self.left[b])
        return out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and where each word begins in them.

        -1-c stands for a character c without a piece.
        """
        size = np.fromiter(map(len, words), np.int64, len(words))
        coded: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # words, ids of each, all ids
        for n in np.unique(size):
            rows = np.flatnonzero(size == n)
            if n > LONG and self.kind == BPE:
                spelt = [self._spell(words[r], self.merge(words[r])) for r in rows]
                coded.append((rows, np.array([len(x) for x in spelt]), np.concatenate(spelt)))
                continue
            step = max(1, (1 << 21) // int(n))
            for lo in range(0, len(rows), step):
                some = rows[lo : lo + step]
                coded.append((some, *self._trellis([words[r] for r in some], int(n))))
        counts = np.zeros(len(words), np.int64)
        for rows, own, _ in coded:
            counts[rows] = own
        first = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(first[-1], np.int64)
        for rows, own, ids in coded:
            out[np.repeat(first[rows] - (np.cumsum(own) - own), own) + np.arange(len(ids))] = ids
        return out, first

    def _spell(self, word: str, ids: list[int]) -> np.ndarray:
        at, spelt = 0, []
        for i in ids:
            spelt.append(i if i != self.none else -1 - ord(word[at]))
            at += int(self.length[i])
        return np.array(spelt, np.int64)

    def _trellis(self, words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
        rows = len(words)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(rows, n)
        value = mix(codes.astype(np.uint64) + np.uint64(1)).reshape(rows, n)
        up = powers(_B, n + 1)
        prefix = np.zeros((rows, n + 1), np.uint64)
        for i in range(n):
            prefix[:, i + 1] = prefix[:, i] * _B + value[:, i]
        best = np.zeros((rows, n + 1))
        last = np.full((rows, n + 1), -1, np.int64)
        step = np.zeros((rows, n + 1), np.int64)
        for i in range(1, n + 1):
            most = min(i, self.longest)
            lengths = np.arange(most, 0, -1)
            found = self.probe((prefix[:, i : i + 1] - prefix[:, i - lengths] * up[lengths]).ravel()).reshape(rows, most)
            found[:, -1] = np.where(found[:, -1] < 0, self.none, found[:, -1])
            r, c = np.nonzero(found >= 0)
            piece, start = found[r, c], i - lengths[c]
            if self.kind == BPE:
                before = last[r, start]
                check = np.flatnonzero(start > 0)
                pairs, inverse = np.unique(before[check] * (self.none + 1) + piece[check], return_inverse=True)
                fits = self.side_by_side(pairs // (self.none + 1), pairs % (self.none + 1))
                gain = np.zeros(len(r))
                gain[check] = np.where(fits[inverse], 0.0, -np.inf)
            else:
                gain = np.where(piece == self.none, self.floor, self.scores[np.minimum(piece, self.none - 1)])
            total = np.full((rows, most), -np.inf)
            total[r, c] = best[r, start] + gain
            top = total.argmax(1)  # of equals the longest piece
            every = np.arange(rows)
            best[:, i] = total[every, top]
            last[:, i] = found[every, top]
            step[:, i] = lengths[top]
        back = []
        at = np.full(rows, n)
        every = np.arange(rows)
        while at.any():
            live = at > 0
            piece = np.where(live, last[every, at], -1)
            lone = piece == self.none
            if lone.any():
                piece = np.where(lone, -1 - codes[every, np.maximum(at - 1, 0)].astype(np.int64), piece)
            back.append(np.where(live, piece, np.iinfo(np.int64).min))
            at = at - np.where(live, step[every, at], 0)
        ids = np.stack(back[::-1], 1)
        keep = ids != np.iinfo(np.int64).min
        if not np.isfinite(best[:, n]).all():
            raise ValueError("a word has no segmentation")  # cannot be: every character has a piece or its own id
        return keep.sum(1), ids[keep]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text begins in them."""
        units: dict[str, int] = {}
        seen = units.setdefault
        flat: list[int] = []
        counts = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t:
                t = ((" " + t) if self.prefix else t).replace(" ", BLANK)
                own = [seen(u, len(units)) for u in _UNIT.findall(t)]
                counts[i] = len(own)
                flat += own
        ids, first = self._encode_units(list(units))
        use = np.array(flat, np.int64)
        size = np.diff(first)[use]
        total = np.concatenate([[0], np.cumsum(size)])
        out = ids[np.repeat(first[use] - total[:-1], size) + np.arange(total[-1])]
        return out.astype(np.int32), total[np.concatenate([[0], np.cumsum(counts)])]

    def _encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.kind == UNIGRAM:
            ids, first = self.encode_words(units)
            changed = {}
        else:
            # All blanks but the last of a run meet no letter; the last may merge with the word.
            runs = {i: len(u) - len(u.lstrip(BLANK)) - 1 for i, u in enumerate(units) if u[1:2] == BLANK}
            ids, first = self.encode_words([u[runs[i] :] if i in runs else u for i, u in enumerate(units)])
            blank = self.index.get(BLANK, self.none)
            changed = {}
            for i, more in runs.items():
                own = ids[first[i] : first[i + 1]]
                free = int(own[0] == blank)
                changed[i] = np.concatenate([self._spell(BLANK * (more + free), self.merge(BLANK * (more + free))), own[free:]])
        for i in np.unique(np.searchsorted(first, np.flatnonzero(ids < 0), side="right") - 1).tolist():
            changed.setdefault(i, ids[first[i] : first[i + 1]])
        if changed:
            for i, own in changed.items():
                if (own < 0).any():
                    changed[i] = np.array([x for v in own.tolist() for x in (self._bytes(chr(-1 - v)) if v < 0 else (v,))], np.int64)
            counts = np.diff(first)
            at = np.array(sorted(changed))
            same = np.ones(len(counts), bool)
            same[at] = False
            stay = ids[np.repeat(same, counts)]
            counts[at] = [len(changed[i]) for i in at]
            out = np.empty(counts.sum(), np.int64)
            moved = np.repeat(same, counts)
            out[moved] = stay
            out[~moved] = np.concatenate([changed[i] for i in at])
            ids, first = out, np.concatenate([[0], np.cumsum(counts)])
        return ids, first

    def _bytes(self, char: str) -> list[int]:
        ids = [int(self.byte[b]) for b in char.encode("utf-8", "surrogatepass")]
        return ids if min(ids) >= 0 else [self.unknown]

    def decode(self, ids: list[int]) -> str:
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            value = self._byte_of.get(i)
            if value is not None:
                raw.append(value)
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw = bytearray()
            if i < 0:
                raise IndexError(f"no piece {i}")
            out.append(" ⁇ " if i == self.unknown else "" if i in self.control else self.pieces[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        text = "".join(out).replace(BLANK, " ")
        return text[1:] if self.prefix and text[:1] == " " else text

    @property
    def _byte_of(self) -> dict[int, int]:
        have = self.__dict__.get("_bytes_by_id")
        if have is None:
            have = self._bytes_by_id = {int(i): b for b, i in enumerate(self.byte) if i >= 0}
        return have


def _string_hash(text: str) -> np.uint64:
    out = 0
    for v in mix(np.array([ord(c) + 1 for c in text], np.uint64)):
        out = (out * int(_B) + int(v)) & 0xFFFFFFFFFFFFFFFF
    return np.uint64(out)


CHUNK = 1 << 23  # characters encoded together: words repeat within a chunk, memory grows with it


def encode_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """``doc_id, text, ids`` of every row; with ``decode`` also ``decoded``, the text that the ids give back."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in in_chunks(texts, CHUNK):
                ids, first = coder.encode(texts[lo:hi])
                columns = [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo)]
                columns.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32())))
                if decode:
                    columns.append(pa.array([coder.decode(ids[i:j].tolist()) for i, j in zip(first[:-1], first[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id bigint, text string, ids array<int>" + (", decoded string" if decode else "")
    names = ["doc_id", "text", "ids"] + ["decoded"] * decode
    return rows.mapInArrow(run, schema)


def decode_column(spark: SparkSession, model: Model, ids):
    """Text of a column of id arrays."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([shared.value.decode(x.tolist()) if x is not None else "" for x in b], dtype=object)

    return decode(ids)
