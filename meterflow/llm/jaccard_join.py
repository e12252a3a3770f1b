"""Exact Jaccard self-join over word shingles, and its connected components.

Method: universe partitioning with the pigeonhole principle. Documents fall
into size bands. For a band, at most ``H`` shingles can differ between two
linked sets, so the hash space is cut into segments whose allowances sum to
more than ``H`` plus the largest allowance: of any linked pair at least two
segments stay within their allowance. A segment of allowance 1 is indexed as it
is; one of allowance 2 also with each one of its shingles left out, so it
survives one difference. Which mix a band uses is chosen by cost (index rows
against expected chance candidates). A form with more shingles than the band's
``light`` is indexed alone; lighter forms, which many unrelated sets share, only
in pairs of segments. A band's ``light`` is the largest of ``LIGHT`` for which
the pairs stay a fraction of the index rows. Two linked sets therefore always share an index key.

Keys are grouped and every set is compared with the smallest set under the key
it shares, so a key of k sets costs k comparisons, not k^2. A comparison first
looks at sizes and at sketches of 512 bits, one for the least shingle of each of as
many ranges of the hash. They differ in no more bits than the sets in shingles, and
those of linked sets differ in more than ``sketch_limit`` with a probability below
1e-20, less than that of a collision of shingle hashes. What passes is decided exactly
from the texts. Sets that still share a key but are in different components
after two such rounds meet in blocks of bounded size. There first the sketches say
which sets have a pair at all that they cannot rule out; only those sets go on, with
their texts, and their pairs are decided inside the block. A block gives out the links
that join components, never its pairs. No pair is lost. Sets that are many, similar
and unlinked still cost their square in comparisons, but not in rows or memory.

Defined cases: words are maximal runs outside space and 0x09-0x0D, A-Z
lower-cased; fewer than k words make one shingle of the whole sequence; a null
text, an empty one and one without words have the empty set, which links with
nothing. Repeated rows share a class. Null ids never name a component unless
all ids of it are null. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import Words, cut_words, fitted, in_chunks, materialise, mix, packed, rolling, unpack
from meterflow.llm.components import connected

LIGHT = (2, 1, 0, -1)
BAND_RATIO = 1.3
SHARED = 0.2  # cost model: chance that two sets of a band share a given shingle
PROBE_COST = 20.0  # cost model: one comparison against one index row
CENTRES = 2
SET_BYTES = 1 << 19  # of texts whose shingles a task holds at once; a longer text stands alone
TASK_TEXTS = 1 << 11  # texts, or pairs of texts, that are worth a task
BLOCK = 1024  # sets of a key in one block
BLOCK_SHINGLES = 1 << 19  # and their shingles, where these are held
SKETCH = 512  # bits
MISS = 1e-20
PARTS = [f"s{i}" for i in range(SKETCH // 64)]  # columns of a sketch


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, concatenated, with the text of each."""
    counts, starts = words.counts, words.starts
    grams = rolling(words.hashes, k)
    texts = np.repeat(np.arange(len(counts)), np.maximum(counts - k + 1, 0))
    first = np.repeat(starts[:-1] - np.concatenate([[0], np.cumsum(np.maximum(counts - k + 1, 0))[:-1]]), np.maximum(counts - k + 1, 0))
    hashes = grams[first + np.arange(len(texts))] if len(texts) else grams[:0]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = np.array([mix(rolling(words.hashes[starts[i] : starts[i + 1]], int(counts[i])) + np.uint64(counts[i]))[0] for i in short], np.uint64)
        texts, hashes = np.concatenate([texts, short]), np.concatenate([hashes, whole])
    order = np.lexsort((hashes, texts))
    texts, hashes = texts[order], hashes[order]
    new = np.ones(len(texts), bool)
    new[1:] = (texts[1:] != texts[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[new], texts[new]


def _group_sums(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """Wrapping sums of ``values`` by ascending ``groups``."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    at = np.searchsorted(groups, np.arange(n + 1))
    return total[at[1:]] - total[at[:-1]]


def set_keys(hashes: np.ndarray, texts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and a 128-bit key of each set."""
    sizes = np.bincount(texts, minlength=n)
    return sizes, _group_sums(mix(hashes), texts, n), _group_sums(mix(hashes + np.uint64(0x51ED270B)), texts, n)


def sketches(hashes: np.ndarray, texts: np.ndarray, n: int) -> np.ndarray:
    """``SKETCH`` bits of each set, as a row of longs: the hash space is cut into as many bins, each says one bit of its least shingle."""
    slot = texts * SKETCH + (hashes >> np.uint64(64 - SKETCH.bit_length() + 1)).astype(np.int64)
    least = np.ones(len(slot), bool)  # sets are sorted by shingle, so a bin's least comes first
    least[1:] = slot[1:] != slot[:-1]
    bits = np.zeros(n * SKETCH, np.uint8)
    bits[slot[least]] = (mix(hashes[least] ^ np.uint64(0x2545F4914F6CDD1D)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits).view(np.int64).reshape(n, SKETCH // 64)


def sketch_limit(percent: int) -> int:
    """Most bits in which the sketches of two linked sets differ, but for a chance of ``MISS``.

    The least shingle of a bin is the same in both sets with a probability of
    their similarity, and otherwise its bit is the same half the time, so the
    number of differing bits is bounded by Chernoff.
    """
    q = max((1 - percent / 100) / 2, 1e-9)
    for bits in range(math.ceil(q * SKETCH) + 1, SKETCH // 2):
        t = bits / SKETCH
        if SKETCH * (t * math.log(t / q) + (1 - t) * math.log((1 - t) / (1 - q))) > -math.log(MISS):
            return bits
    return SKETCH


class Bands:
    """Size bands and, per band, the chosen segments: ``exact`` of allowance 1, ``loose`` of allowance 2."""

    def __init__(self, percent: int, sizes: dict[int, int]):
        self.percent = percent
        top = max(sizes, default=1)
        low = [1]
        while low[-1] <= top:
            low.append(max(low[-1] + 1, int(low[-1] * BAND_RATIO)))
        self.low = np.array(low, np.int64)
        rows = np.zeros(len(low), np.int64)
        for size, n in sizes.items():
            rows[self.band(np.array([size]))[0]] += n
        self.exact, self.loose, self.differ, self.light = (np.zeros(len(low), np.int64) for _ in range(4))
        for b in range(len(low) - 1):
            largest = low[b + 1] - 1
            h = (100 - percent) * 2 * largest // (100 + percent)
            self.differ[b] = h
            if h:
                self.exact[b], self.loose[b] = self._allocate(h, low[b], int(rows[b] + rows[b - 1]))
                self.light[b] = self._lightness(low[b], int(self.exact[b]), int(self.loose[b]))

    @staticmethod
    def _allocate(h: int, size: int, rows: int) -> tuple[int, int]:
        best = None
        for loose in range(0, 4):
            largest = 2 if loose else 1
            exact = max(0, h + 1 + largest - 2 * loose)
            if exact + loose < 2:
                continue
            per = size / (exact + loose)
            keys = exact + loose * (1 + per)
            chance = rows * (exact * SHARED**per + loose * (1 + per) * SHARED ** max(per - 1, 0))
            cost = keys + PROBE_COST * chance
            if best is None or cost < best[0]:
                best = (cost, exact, loose)
        return best[1], best[2]

    @staticmethod
    def _lightness(size: int, exact: int, loose: int) -> int:
        mean = size / (exact + loose)  # shingles of a segment: about Poisson
        for light in LIGHT:
            share = sum(math.exp(-mean) * mean**i / math.factorial(i) for i in range(light + 1))
            forms = share * (exact + loose * (1 + mean))
            if forms * forms / 2 <= 0.25 * (exact + loose) + 4:
                break
        return light

    def band(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, sizes, side="right") - 1

    def keys(self, hashes: np.ndarray, texts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """All index keys of the sets, with the set of each."""
        sizes = np.bincount(texts, minlength=n)
        own = self.band(np.maximum(sizes, 1))
        out = [self._keys_in(hashes, texts, n, np.where(sizes > 0, own, -1))]
        # A set can link with larger sets of the next band.
        up = np.minimum(own + 1, len(self.low) - 2)
        reach = (sizes > 0) & (up > own) & (100 * sizes >= self.percent * self.low[up])
        if reach.any():
            out.append(self._keys_in(hashes, texts, n, np.where(reach, up, -1)))
        return np.concatenate([k for k, _ in out]), np.concatenate([t for _, t in out])

    def _keys_in(self, hashes, texts, n, band):
        live = (band >= 0) & (self.differ[band] > 0)
        segments = np.where(live, self.exact[band] + self.loose[band], 0)
        base = np.concatenate([[0], np.cumsum(segments)])
        total = int(base[-1])
        take = live[texts]
        h, t = hashes[take], texts[take]
        # Segments are equal ranges of the hash, so sorted sets keep them together.
        seg = ((h >> np.uint64(32)) * segments[t].astype(np.uint64)) >> np.uint64(32)
        slot = base[t] + seg.astype(np.int64)
        size = np.bincount(slot, minlength=total)
        owner = np.repeat(np.arange(n), segments)
        index = np.arange(total) - base[owner]
        salt = mix(band[owner].astype(np.uint64) * np.uint64(1 << 32) + index.astype(np.uint64) + np.uint64(1))
        token = mix(h ^ np.uint64(0x5851F42D4C957F2D))
        sums = _group_sums(token, slot, total)
        form, holder, weight, place = mix(sums + salt), owner, size, index
        loose = seg.astype(np.int64) < self.loose[band[t]]
        if loose.any():
            s = slot[loose]
            form = np.concatenate([form, mix(sums[s] - token[loose] + salt[s])])
            holder = np.concatenate([holder, owner[s]])
            weight = np.concatenate([weight, size[s] - 1])
            place = np.concatenate([place, index[s]])
        heavy = weight > self.light[band[holder]]
        keys, who = [form[heavy]], [holder[heavy]]
        lf, lh, lp = form[~heavy], holder[~heavy], place[~heavy]
        order = np.lexsort((lp, lh))
        lf, lh, lp = lf[order], lh[order], lp[order]
        step = 1
        while step < len(lf):  # light forms of one set in different segments, in pairs
            same = lh[step:] == lh[:-step]
            if not same.any():
                break
            pair = same & (lp[step:] != lp[:-step])
            keys.append(mix(lf[:-step][pair] * np.uint64(0x9FB21C651E98DF25) + lf[step:][pair]))
            who.append(lh[step:][pair])
            step += 1
        return np.concatenate(keys), np.concatenate(who)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _classes_of(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["text"].tolist()
            for lo, hi in in_chunks(texts, SET_BYTES):
                hashes, owner = shingle_sets(cut_words(texts[lo:hi], lower=True), k)
                size, key, check = set_keys(hashes, owner, hi - lo)
                out = {"doc_id": b["doc_id"].to_numpy()[lo:hi], "named": b["named"].to_numpy()[lo:hi], "tx": b["tx"].to_numpy()[lo:hi], "n": size.astype(np.int64), "key": _signed(key), "chk": _signed(check)}
                yield pd.DataFrame(out | dict(zip(PARTS, sketches(hashes, owner, hi - lo).T)))

    return run


def _keys_of(k: int, bands: Bands):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.empty(0, np.uint64)  # sets this task has indexed; copies add nothing
        for b in batches:
            texts = b["text"].tolist()
            for lo, hi in in_chunks(texts, SET_BYTES):
                hashes, owner = shingle_sets(cut_words(texts[lo:hi], lower=True), k)
                _, key, _ = set_keys(hashes, owner, hi - lo)
                _, first = np.unique(key, return_index=True)
                fresh = np.zeros(hi - lo, bool)
                fresh[first] = True
                fresh &= ~np.isin(key, seen)
                seen = np.concatenate([seen, key[fresh]])
                use = fresh[owner]
                sig, who = bands.keys(hashes[use], owner[use], hi - lo)
                if len(sig):
                    yield pd.DataFrame({"sig": _signed(sig), "key": _signed(key[who])})

    return run


def _texts_of_pairs(left: list[bytes], right: list[bytes]) -> Iterator[tuple[int, int, dict[bytes, str]]]:
    """Ranges of pairs with their texts unpacked, about ``SET_BYTES`` at a time; a text that repeats, as centres do, is unpacked once."""
    lo, size, texts = 0, 0, {}
    for i, pair in enumerate(zip(left, right)):
        for body in pair:
            if body not in texts:
                texts[body] = unpack(body)
                size += len(texts[body])
        if size > SET_BYTES or i == len(left) - 1:
            yield lo, i + 1, texts
            lo, size, texts = i + 1, 0, {}


def _linked(k: int, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            left, right = (b[c].tolist() for c in ("a_body", "b_body"))
            for lo, hi, texts in _texts_of_pairs(left, right):
                sets = dict(zip(texts, _sets(list(texts.values()), k)))
                ok = np.zeros(hi - lo, bool)
                for i in range(lo, hi):
                    x, y = sets[left[i]], sets[right[i]]
                    if len(x) and len(y) and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                        z = np.concatenate([x, y])
                        z.sort()
                        both = int(np.count_nonzero(z[1:] == z[:-1]))
                        ok[i - lo] = 100 * both >= percent * (len(x) + len(y) - both)
                if ok.any():
                    yield pd.DataFrame({"a": b["a"].to_numpy()[lo:hi][ok], "b": b["b"].to_numpy()[lo:hi][ok]})

    return run


def _sets(texts: list[str], k: int) -> list[np.ndarray]:
    hashes, owner = shingle_sets(cut_words(texts, lower=True), k)
    return np.split(hashes, np.searchsorted(owner, np.arange(1, len(texts))))


def similar_components(docs: DataFrame, k: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, tx, n_shingles, component_id, first``.

    Links are pairs with ``100 * |A & B| >= percent * |A | B|``. ``tx`` is the
    xxhash64 of the text, which tells rows of one id apart; ``first`` marks the
    component's row with the smallest id (then smallest ``tx``).
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("tx"), text.alias("text"))
    # Ids pass pandas without nulls, which would turn them to floats.
    sent = rows.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNotNull().alias("named"), "tx", "text")
    members = sent.mapInPandas(_classes_of(k), "doc_id bigint, named boolean, tx bigint, n bigint, key bigint, chk bigint, " + ", ".join(f"{c} bigint" for c in PARTS))
    members = materialise(members.withColumn("doc_id", F.when(F.col("named"), F.col("doc_id"))).drop("named"), "set-classes")
    # A class is one distinct set; its text is that of its first row.
    classes = members.where("n > 0").groupBy("key", "chk", "n").agg(F.min(F.struct("doc_id", "tx")).alias("rep"), *[F.first(c).alias(c) for c in PARTS])
    many = members.count()
    classes = materialise(fitted(classes, many).select("key", "chk", "n", "rep", *PARTS, F.monotonically_increasing_id().alias("cid")), "classes")
    # Sizes grow with the logarithm of nothing but the longest text: bounded by band.
    widths = {r["n"]: r["c"] for r in _size_histogram(classes).collect()}
    bands = Bands(percent, widths)
    index = rows.select("text").mapInPandas(_keys_of(k, bands), "sig bigint, key bigint")
    shared = _shared_keys(index)
    nodes = classes.select("key", "cid")
    buckets = materialise(shared.join(nodes, "key").select("sig", "cid"), "buckets")
    roots = _compare(rows, many, classes, buckets, k, percent).roots()
    names = fitted(classes.join(roots, F.col("cid") == F.col("node"), "left"), many).select("key", "chk", F.coalesce("root", "cid").alias("root"))
    own = members.select("doc_id", "tx", "n", "key", "chk").join(names, ["key", "chk"], "left")
    own = materialise(fitted(own.select("doc_id", "tx", "n", "root"), many), "set-members")
    least = own.where("root is not null").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "tx")).alias("least"))
    out = fitted(own.join(materialise(fitted(least, many), "component-names"), "root", "left"), many)
    lone = F.col("root").isNull()
    return out.select(
        "doc_id",
        "tx",
        F.col("n").alias("n_shingles"),
        F.when(lone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
        (lone | (F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("tx") == F.col("least.tx")))).alias("first"),
    )


def keep_first(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` without those that link, directly or not, to a smaller one; all columns.

    Rows that repeat id and text stay together.
    """
    gone = similar_components(docs, k, percent, id_col, text_col).where(~F.col("first")).select(F.col("doc_id").alias("g_id"), F.col("tx").alias("g_tx")).distinct()
    gone = materialise(gone, "set-gone")  # of known size: the texts are shuffled only if these rows are many
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(id_col).cast("bigint").alias("d_id"), F.xxhash64(text).alias("d_tx"))
    on = F.col("d_id").eqNullSafe(F.col("g_id")) & (F.col("d_tx") == F.col("g_tx"))
    return row.join(gone, on, "left_anti").select("row.*")


def _size_histogram(classes: DataFrame) -> DataFrame:
    """Sets by size, sizes rounded up to 5 %: as many rows as there are magnitudes."""
    step = F.ceil(F.log(1.05, F.col("n").cast("double")))
    return classes.groupBy(step.alias("s")).agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("c")).select("n", "c")


def _shared_keys(index: DataFrame) -> DataFrame:
    """Index rows whose key more than one set has, once each.

    Most keys are held by one set only. Range-partitioned and sorted by key and
    set, copies of a row are adjacent, and a row of a shared key has a neighbour
    with the same key and another set. The first and the last row of a partition
    may have theirs elsewhere and go on in any case: a key that only one set holds
    brings no pair. A key that very many sets share is spread over partitions.
    """
    ordered = index.repartitionByRange("sig", "key").sortWithinPartitions("sig", "key")
    return ordered.mapInPandas(_with_neighbour, "sig bigint, key bigint")


def _with_neighbour(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None  # last row so far, and whether it goes on
    for b in batches:
        if not len(b):
            continue
        sig, key = b["sig"].to_numpy(), b["key"].to_numpy()
        on = np.zeros(len(b), bool)
        on[0] = held is None  # the partition's first row: its neighbour is elsewhere
        if held is not None:
            sig, key, on = (np.concatenate(x) for x in zip(held, (sig, key, on)))
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
        sig, key, on = sig[new], key[new], on[new]
        pair = sig[1:] == sig[:-1]
        on[1:] |= pair
        on[:-1] |= pair
        held = sig[-1:], key[-1:], on[-1:]
        on = on[:-1]
        yield pd.DataFrame({"sig": sig[:-1][on], "key": key[:-1][on]})
    if held is not None:
        yield pd.DataFrame({"sig": held[0], "key": held[1]})


class _Links:
    """Links found so far, as the components they amount to; nothing is worked out again where none were added."""

    def __init__(self, spark):
        self.known = spark.createDataFrame([], "node bigint, root bigint")
        self.new: DataFrame | None = None

    def add(self, links: DataFrame) -> None:
        if not links.isEmpty():
            self.new = links if self.new is None else self.new.union(links)

    def roots(self) -> DataFrame:
        """``node, root`` of every linked set."""
        if self.new is not None:
            # A component that is known goes on as one link from each of its sets to its root.
            self.known = connected(self.known.select(F.col("root").alias("a"), F.col("node").alias("b")).union(self.new))
            self.new = None
        return self.known


def _compare(rows: DataFrame, docs: int, classes: DataFrame, buckets: DataFrame, k: int, percent: int) -> _Links:
    """Links among the sets of each bucket; there are ``docs`` documents, and no more sets."""
    links, left = _Links(rows.sparkSession), buckets
    for _ in range(CENTRES):
        # The smallest set still open under a key is its centre; it is compared
        # with the others and leaves the key.
        many = left.count()
        centre = materialise(fitted(left.groupBy("sig").agg(F.min("cid").alias("a")), many), "bucket-centres")
        others = materialise(fitted(left.join(centre, "sig").where("cid <> a"), many), "bucket-stars")
        pairs = fitted(others.select("a", F.col("cid").alias("b")).distinct(), many)
        pairs = materialise(_near(pairs, classes, percent, docs + many), "near-pairs")
        many_pairs = pairs.count()
        # One pair of each set first: most other pairs then join what is joined already.
        one = materialise(fitted(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), many_pairs), "first-pairs")
        links.add(_verified(one, rows, docs, classes, k, percent))
        rest = _apart(fitted(pairs.join(one, ["a", "b"], "left_anti"), many_pairs), links.roots(), docs + many_pairs)
        links.add(_verified(rest, rows, docs, classes, k, percent))
        left = materialise(_open(others.select("sig", "cid"), links.roots(), docs + many), "buckets")
        if left.isEmpty():
            return links
    # What is left under a key is compared block against block.
    many = left.count()
    left = fitted(left.join(links.roots().select(F.col("node").alias("cid"), F.col("root")), "cid", "left"), docs + many)
    links.add(_blockwise(left, many, rows, docs, classes, k, percent))
    return links


def _within(percent: int) -> str:
    """Condition under which sizes and sketches allow a link.

    Two linked sets differ in at most (100 - p) / (100 + p) of their summed
    sizes, and sketches differ in no more bits than the sets in shingles, nor in
    more than ``sketch_limit``.
    """
    bits = " + ".join(f"bit_count(a_{c} ^ b_{c})" for c in PARTS)
    sizes = f"100 * least(a_n, b_n) >= {percent} * greatest(a_n, b_n)"
    return f"{sizes} AND {100 + percent} * ({bits}) <= least({100 - percent} * (a_n + b_n), {100 + percent} * {sketch_limit(percent)})"


def _near(pairs: DataFrame, classes: DataFrame, percent: int, many: int) -> DataFrame:
    side = lambda x: classes.select(F.col("cid").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("n", *PARTS)])
    return fitted(fitted(pairs.join(side("a"), "a"), many).join(side("b"), "b").where(_within(percent)).select("a", "b"), many)


def _verified(pairs: DataFrame, rows: DataFrame, docs: int, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs that are links, decided on the texts."""
    pairs = materialise(pairs, "set-pairs")
    many = pairs.count()
    if not many:
        return pairs
    texts = _texts(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")), 2 * many, rows, docs, classes)
    both = pairs.join(texts.select(F.col("cid").alias("b"), F.col("body").alias("b_body")), "b")
    both = fitted(both, many, TASK_TEXTS).join(texts.select(F.col("cid").alias("a"), F.col("body").alias("a_body")), "a")
    both = fitted(both, many, TASK_TEXTS)
    return materialise(both.select("a", "b", "a_body", "b_body").mapInPandas(_linked(k, percent), "a bigint, b bigint"), "set-links")


def _texts(sets: DataFrame, many: int, rows: DataFrame, docs: int, classes: DataFrame) -> DataFrame:
    """``cid, body``: the packed text of each of up to ``many`` sets."""
    who = fitted(sets.select("cid").distinct().join(classes.select("cid", "rep.*"), "cid"), docs + many)
    texts = rows.alias("r").join(who.alias("i"), F.col("r.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("r.tx") == F.col("i.tx")))
    texts = fitted(texts.select("cid", "text"), docs, TASK_TEXTS).select("cid", packed(F.col("text")).alias("body"))
    return materialise(fitted(texts.dropDuplicates(["cid"]), many, TASK_TEXTS), "set-texts")


def _apart(pairs: DataFrame, roots: DataFrame, many: int) -> DataFrame:
    """Pairs of different components."""
    ra = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    rb = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    both = fitted(fitted(pairs.join(ra, "a", "left"), many).join(rb, "b", "left"), many)
    return both.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def _open(left: DataFrame, roots: DataFrame, many: int) -> DataFrame:
    """Keys that still hold sets of different components."""
    named = fitted(left.join(roots, F.col("cid") == F.col("node"), "left"), many).select("sig", "cid", F.coalesce("root", "cid").alias("root"))
    named = materialise(named, "named-keys")
    mixed = named.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("sig")
    return fitted(named.join(materialise(fitted(mixed, many), "mixed-keys"), "sig", "left_semi"), many).select("sig", "cid")


def _blockwise(left: DataFrame, many: int, rows: DataFrame, docs: int, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """Links ``a, b`` among the sets of each key, ``many`` in all, as many as join its components.

    Most sets have no pair that the sketches cannot rule out, so the texts are
    fetched for the others only. Keys of which the same sets are left are one.
    """
    sets = materialise(left.select("sig", "cid", F.coalesce("root", "cid").alias("root")), "open-sets")
    met = _dealt(sets, many, F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)), docs, classes.select("cid", "n", *PARTS))
    near = met.mapInPandas(_block_pairs(percent, _open_sets), "sig bigint, cid bigint, root bigint, n bigint")
    near = materialise(fitted(near.distinct(), many), "block-sets")
    alike = [F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("cid")).alias("x"), F.sum(F.xxhash64("cid", F.lit(1)).cast("decimal(38,0)")).alias("s")]
    keys = fitted(near.groupBy("sig").agg(*alike), many).groupBy("c", "x", "s").agg(F.min("sig").alias("sig")).select("sig")
    near = materialise(fitted(near.join(materialise(fitted(keys, many), "block-keys"), "sig", "left_semi"), many), "block-sets")
    many = near.count()
    if not many:
        return near.select(F.col("cid").alias("a"), F.col("cid").alias("b"))
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)), F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)))
    texts = _texts(near, many, rows, docs, classes)
    met = _dealt(near, many, blocks, docs, fitted(classes.select("cid", "n", *PARTS).join(texts, "cid"), docs, TASK_TEXTS))
    return materialise(fitted(met.mapInPandas(_block_pairs(percent, _links_in(k, percent)), "a bigint, b bigint").distinct(), many), "set-links")


def _dealt(sets: DataFrame, many: int, blocks, docs: int, held: DataFrame) -> DataFrame:
    """The sets of each key, ``many`` in all, dealt into blocks, with the columns of ``held``.

    Every pair of blocks of a key meets in one group, ``sig, i, j``, so no task
    needs more than two blocks of a key.
    """
    sizes = sets.groupBy("sig").agg(blocks.cast("int").alias("g"), F.count(F.lit(1)).alias("c"))
    sizes = materialise(fitted(sizes, many), "key-sizes")
    many = sizes.agg(F.sum(F.col("g") * F.col("c"))).first()[0] or 0  # a set is dealt once for each block of its key
    full = fitted(sets.join(sizes.select("sig", "g"), "sig"), many)
    full = full.withColumn("blk", F.pmod(F.xxhash64("cid"), F.col("g")).cast("int"))
    full = full.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    full = full.select("sig", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "blk", "cid", "root")
    # Sketches and texts come last: only the exchange that deals the blocks carries them.
    full = fitted(full.join(held, "cid"), docs + many, BLOCK)
    return fitted(full.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j"), many, BLOCK)


def _joined(steps: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    none = np.empty(0, np.int64)
    x, y = zip((none, none), *steps)
    return np.concatenate(x), np.concatenate(y)


def _pairs_in(b: pd.DataFrame, end: np.ndarray, near) -> pd.DataFrame:
    """Every pair that may be a link."""
    one, two = (b["cid"].to_numpy()[z] for z in _joined(near(b, end)))
    return pd.DataFrame({"a": np.minimum(one, two), "b": np.maximum(one, two)}).drop_duplicates()


def _open_sets(b: pd.DataFrame, end: np.ndarray, near) -> pd.DataFrame:
    """Sets that are in a pair that may be a link."""
    hit = np.zeros(len(b), bool)
    for x, y in near(b, end):
        hit[x] = hit[y] = True
    return b.loc[hit, ["sig", "cid", "root", "n"]]


def _links_in(k: int, percent: int):
    """Links that join components, decided on the texts."""

    def found(b: pd.DataFrame, end: np.ndarray, near) -> pd.DataFrame:
        links, lo = [np.empty((0, 2), np.int64)], 0
        weight = np.cumsum(b["n"].to_numpy())
        while lo < len(b):  # whole groups, together of bounded size, or one alone
            most = min(lo + 2 * BLOCK, int(np.searchsorted(weight, weight[lo] + BLOCK_SHINGLES)))
            hi = len(b) if most >= len(b) else max(int(end[lo]), int(np.searchsorted(end, end[most])))
            part = b.iloc[lo:hi]
            x, y = _joined(near(part, end[lo:hi] - lo))
            if len(x):
                links.append(_decided(part, x, y, k, percent))
            lo = hi
        a, c = np.sort(np.concatenate(links), axis=1).T
        return pd.DataFrame({"a": a, "b": c})

    return found


def _decided(b: pd.DataFrame, x: np.ndarray, y: np.ndarray, k: int, percent: int) -> np.ndarray:
    """Of the pairs of rows ``x, y`` the links, as pairs of sets, without those whose components earlier ones have joined."""
    row = np.concatenate([x, y])
    cid, first, at = np.unique(b["cid"].to_numpy()[row], return_index=True, return_inverse=True)
    row = row[first]  # one for each set: it can be under several keys
    component = np.unique(b["root"].to_numpy()[row], return_inverse=True)[1]
    pair = np.unique(np.minimum(at[: len(x)], at[len(x) :]) * len(cid) + np.maximum(at[: len(x)], at[len(x) :]))
    x, y = pair // len(cid), pair % len(cid)
    bodies, sets = b["body"].to_numpy()[row].tolist(), []
    for _, _, texts in _texts_of_pairs(bodies, bodies):  # different sets have different texts
        sets += _sets(list(texts.values()), k)
    size = np.array([len(s) for s in sets])
    # Numbers for shingles: a set is marked in one array and looked up from all others.
    number = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
    mark = np.zeros(len(number), bool)
    sets = np.split(number, np.cumsum(size)[:-1])
    links = []
    run = np.concatenate([[0], np.flatnonzero(np.diff(x)) + 1, [len(x)]])
    for lo, hi in zip(run[:-1], run[1:]):
        one, others = x[lo], y[lo:hi]
        others = others[component[others] != component[one]]
        if not len(others):
            continue
        mark[sets[one]] = True
        start = np.concatenate([[0], np.cumsum(size[others])[:-1]])
        both = np.add.reduceat(mark[np.concatenate([sets[o] for o in others])], start, dtype=np.int64)
        mark[sets[one]] = False
        for o in others[100 * both >= percent * (size[one] + size[others] - both)]:
            if component[o] != component[one]:
                component[component == component[o]] = component[one]
                links.append((cid[one], cid[o]))
    return np.array(links, np.int64).reshape(-1, 2)


def _block_pairs(percent: int, found=_pairs_in):
    """Runs ``found`` on whole groups, with a function that gives the pairs that sizes and sketches allow, step by step."""
    limit = sketch_limit(percent)

    def near(b: pd.DataFrame, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of pairs of each group; ``end`` is one past the last row of a row's group."""
        sketch = b[PARTS].to_numpy().astype(np.uint64)  # bitwise_count takes signed numbers by their absolute value
        i, j, blk, root, n = (b[c].to_numpy() for c in ("i", "j", "blk", "root", "n"))
        at = np.arange(len(b))
        step = 1
        while True:  # every row of every group with the row so many places on
            at = at[at + step < end[at]]
            if not len(at):
                break
            to = at + step
            ok = (root[at] != root[to]) & ((i[at] == j[at]) | (blk[at] != blk[to])) & (100 * np.minimum(n[at], n[to]) >= percent * np.maximum(n[at], n[to]))
            x, y = at[ok], to[ok]
            bits = np.bitwise_count(sketch[x] ^ sketch[y]).sum(1, dtype=np.int64)
            keep = (bits <= limit) & ((100 + percent) * bits <= (100 - percent) * (n[x] + n[y]))
            yield x[keep], y[keep]
            step += 1

    def ends(b: pd.DataFrame) -> np.ndarray:
        key = b[["sig", "i", "j"]].to_numpy()
        cut = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, [len(b)]])
        return np.repeat(cut[1:], np.diff(cut))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for b in batches:
            if not len(b):
                continue
            b = b if rest is None else pd.concat([rest, b], ignore_index=True)
            end = ends(b)
            whole = int(np.searchsorted(end, len(b)))  # the last group may go on in the next batch
            rest = b.iloc[whole:]
            if whole:
                yield found(b.iloc[:whole], end[:whole], near)
        if rest is not None:
            yield found(rest, np.full(len(rest), len(rest)), near)

    return run
