"""Personal data: four fixed kinds, and more identifiers by bootstrapped contexts.

Base spans come from four expressions (email, ip, card, phone) and their checks.
They seed a bootstrap: whole base spans are the first instances, with or without
digits. A lexical pattern is the word before, the word after, or both; it says
nothing of the value's form. Under one word the candidate is the single word next
to it, under a pair the run of up to ``RUN`` words between. A pattern is taken up
when it has ``SUPPORT`` known instances and at least ``SHARE`` of its occurrences
in the corpus hold a known one; both are counted over all texts. Spark scores the
graph of patterns and instances in ``ROUNDS`` rounds: a pattern by the share of its
instances that are known, an instance by its best-supported patterns. Instances of
a high score bring up further patterns where they occur again, up to ``GROWTHS``
times. Unknown candidates of any form under patterns of high confidence and support
become spans of kind ``context``. Candidates are whole words between white space,
without the punctuation around them. A word of more than ``NEAR`` characters is no
context. Occurrences are counted and found by 8-byte codes of the patterns; the
pattern's text decides.

Everything is built-in Spark expressions. A span's place is the sum of the
lengths of what ``split`` and ``regexp_extract_all`` return before it. The
expressions are written without backtracking (possessive, anchored by
look-behind), so time is linear in the text and no Java stack grows with it; they
match what the plain forms match.

Defined cases: a null text counts as empty; places are code points, the end is
exclusive; kinds may overlap each other, one kind never itself; repeated rows are
each answered; of overlapping spans of kind ``context`` the first is taken, then
the longest. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import materialise

KINDS = ("email", "ip", "card", "phone", "context")

# Fixed patterns of the four kinds, in forms that cannot backtrack.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})?+"
IP_FITS = rf"^{IP_PART}(?:\.{IP_PART}){{3}}$"

WORDS = r"(?<=\s)(?=\S)"  # between words; a word keeps the white space after it
STRIP = " \t\n\x0b\f\r.,;:!?\"'`<>[](){}|*"  # what a value or neighbour word is freed of at both ends
NEAR = 160  # characters of a neighbour word, at most
CONTEXT = 240  # characters next to a base span in which its neighbour words are looked for: a word and punctuation
RUN = 4  # words of a candidate between two neighbour words
ROUNDS = 3
GROWTHS = 2
CONFIDENT = 0.8
SUPPORT = 5  # known instances a pattern needs
SHARE = 0.5  # of a pattern's occurrences that hold a known instance


CHUNK = 128  # matches placed together; keeps the cost of long match lists linear


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _found(text: Column, pattern: str) -> Column:
    """Array of (start, end, value, before, after) of the matches."""
    kind = "array<struct<start:int,end:int,value:string,before:string,after:string>>"
    empty = F.array().cast(kind)

    def place(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["value"])
        more = F.right(x["gap"], F.lit(CONTEXT)).alias("before"), F.left(x["next"], F.lit(CONTEXT)).alias("after")
        one = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"), *more)
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def chunked(pairs):
        count = F.ceil(F.size(pairs) / F.lit(CHUNK)).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), count - 1), lambda c: F.slice(pairs, c * CHUNK + 1, F.lit(CHUNK)))
        long = lambda acc, x: acc + F.length(x["gap"]) + F.length(x["value"])
        # Where each chunk starts, then the matches of each from there.
        lengths = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), long))
        begins = F.aggregate(lengths, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        each = F.arrays_zip(F.slice(begins, 1, count).alias("at"), chunks.alias("c"))
        return F.flatten(F.transform(each, lambda e: F.aggregate(e["c"], F.struct(e["at"].alias("at"), empty.alias("out")), place, lambda acc: acc["out"])))

    def all_of(p):
        # The last gap has no match after it.
        n = F.size(p["found"])
        pairs = F.arrays_zip(F.slice(p["gaps"], 1, n).alias("gap"), p["found"].alias("value"), F.slice(p["gaps"], 2, n).alias("next"))
        return F.when(n > 0, _let(pairs, chunked)).otherwise(empty)

    return _let(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps")), all_of)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end, value, before, after) of the four kinds, by start, then kind; ``kind`` is its place in KINDS."""
    number = text.rlike("[0-9]")
    none = F.array().cast("array<struct<start:int,end:int,value:string,before:string,after:string>>")

    def of(kind, when, pattern, fits):
        spans = F.when(when, F.filter(_found(text, pattern), lambda m: fits(m["value"]))).otherwise(none)
        return F.transform(spans, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"), m["value"].alias("value"), m["before"].alias("before"), m["after"].alias("after")))

    return F.sort_array(
        F.concat(
            of(0, F.contains(text, F.lit("@")), EMAIL, lambda v: F.lit(True)),
            of(1, number, IP, lambda v: v.rlike(IP_FITS)),
            of(2, number, CARD, lambda v: F.length(_digits(v)).between(12, 19) & F.call_function("luhn_check", _digits(v))),
            of(3, F.contains(text, F.lit("+")), PHONE, lambda v: F.length(_digits(v)).between(9, 15)),
        )
    )


def _bare(word: Column) -> Column:
    return F.btrim(word, F.lit(STRIP))


def _near(word: Column) -> Column:
    """A neighbour word as patterns hold it; null where it is none."""
    bare = _bare(word)
    return F.when((bare != "") & (F.length(bare) <= NEAR), F.lower(bare))


def _patterns(before: Column, after: Column) -> Column:
    """The lexical patterns of a value between two neighbour words; null where a word is missing."""
    return F.array(F.concat(F.lit("<"), before), F.concat(F.lit(">"), after), F.concat(F.lit("="), before, F.lit("\t"), after))


def _code(pattern: Column) -> Column:
    """The code of a pattern's text, as ``_codes`` has it."""
    kind, rest = F.left(pattern, F.lit(1)), F.expr("substr(pattern, 2)")
    before, after = F.substring_index(rest, "\t", 1), F.substring_index(rest, "\t", -1)
    return F.when(kind == "=", F.xxhash64(kind, F.xxhash64(before), F.xxhash64(after))).otherwise(F.xxhash64(kind, F.xxhash64(rest)))


def _pieces(text: Column) -> Column:
    """Words of a text in pieces of ``CHUNK``: (begin, words, n), with the word before and the RUN + 1 words after."""

    def cut(words):
        count = F.ceil((F.size(words) - 1) / F.lit(CHUNK)).cast("int")
        numbers = F.sequence(F.lit(0), count - 1)
        lengths = F.transform(numbers, lambda c: F.length(F.array_join(F.slice(words, c * CHUNK + 2, F.lit(CHUNK)), "")))
        begins = F.aggregate(lengths, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        return _let(
            begins,
            lambda b: F.transform(
                numbers,
                lambda c: F.struct(
                    F.get(b, c).alias("begin"),
                    F.slice(words, c * CHUNK + 1, F.lit(CHUNK + RUN + 2)).alias("words"),
                    F.least(F.size(words) - 1 - c * CHUNK, F.lit(CHUNK)).alias("n"),
                ),
            ),
        )

    return _let(F.concat(F.array(F.lit("")), F.split(text, WORDS, -1)), cut)


def _codes(words: Column, n: Column) -> Column:
    """Array of (at, k, code): the pattern codes around the runs of ``k`` words that begin at word ``at`` of a piece."""

    def around(hashes):
        def of(at):
            before = F.get(hashes, at - 1)

            def code(k, *parts):
                known = parts[1].isNotNull() & parts[-1].isNotNull()
                return F.when(known, F.struct(at.alias("at"), F.lit(k).alias("k"), F.xxhash64(*parts).alias("code")))

            pairs = [code(k, F.lit("="), before, F.get(hashes, at + k)) for k in range(1, RUN + 1)]
            return F.array(code(1, F.lit("<"), before), code(1, F.lit(">"), F.get(hashes, at + 1)), *pairs)

        return F.flatten(F.transform(F.sequence(F.lit(1), n), of))

    # Each word is bared and lowered once.
    hashes = F.transform(words, lambda w: _let(_near(w), lambda x: F.when(x.isNotNull(), F.xxhash64(x))))
    return _let(hashes, around)


def _pieces_of(rows: DataFrame) -> DataFrame:
    """``row, piece, begin, words, n`` of ``rows(row, text)``."""
    return rows.select("row", F.posexplode(_pieces(F.col("text"))).alias("piece", "p")).select("row", "piece", "p.*")


def _occurrences(rows: DataFrame) -> DataFrame:
    """``row, piece, at, k, code`` of every place around which a pattern could stand."""
    out = _pieces_of(rows).select("row", "piece", F.explode(_codes(F.col("words"), F.col("n"))).alias("c"))
    return out.where("c IS NOT NULL").select("row", "piece", "c.at", "c.k", "c.code")


def _runs(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """The runs at ``hits(row, piece, at, k, ...)`` that touch no base span: their columns and ``start, end, value, patterns``."""
    hits = materialise(hits, "pii-hits")  # its size is known to the planner then
    held = rows.join(hits.select("row").distinct(), "row", "left_semi")
    reach = F.col("begin") + F.length(F.array_join("words", ""))
    near = F.filter("base", lambda s: (s["end"] > F.col("begin")) & (s["start"] < F.col("reach")))  # of the base spans, those at the piece
    pieces = _pieces_of(held).withColumn("reach", reach).join(held.select("row", "base"), "row").withColumn("base", near)
    at = hits.join(pieces, ["row", "piece"])
    own = F.array_join(F.slice("words", F.col("at") + 1, F.col("k")), "")
    ahead = F.length(F.array_join(F.slice("words", F.lit(2), F.col("at") - 1), ""))
    at = at.withColumn("raw", own).withColumn("value", _bare(F.col("raw"))).where("value != ''")
    lead = F.length("raw") - F.length(F.ltrim(F.col("raw"), F.lit(STRIP)))
    at = at.withColumn("start", F.col("begin") + ahead + lead).withColumn("end", F.col("start") + F.length("value"))
    at = at.where(~F.exists("base", lambda s: (s["start"] < F.col("end")) & (F.col("start") < s["end"])))
    patterns = _patterns(_near(F.get("words", F.col("at") - 1)), _near(F.get("words", F.col("at") + F.col("k"))))
    return at.select(*hits.columns, "start", "end", "value", patterns.alias("patterns"))


def _worthwhile(rows: DataFrame, places: DataFrame) -> DataFrame:
    """``pattern, code`` of the patterns of ``places(value, pattern, n)`` with enough known instances and occurrences."""
    able = places.groupBy("pattern").agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("known")).where(f"values >= {SUPPORT}")
    able = materialise(able.select("pattern", "known", _code(F.col("pattern")).alias("code")), "pii-able")
    seen = _occurrences(rows).join(able.select("code").distinct(), "code", "left_semi").groupBy("code").agg(F.count(F.lit(1)).alias("all"))
    return able.join(seen, "code").where(F.col("known") >= F.lit(SHARE) * F.col("all")).select("pattern", "code")


def _under(rows: DataFrame, good: DataFrame) -> DataFrame:
    """``row, start, end, value, pattern`` of the runs under the patterns ``good(pattern, code)``."""
    runs = _runs(rows, _occurrences(rows).join(good, "code").drop("code"))
    return runs.where(F.array_contains("patterns", F.col("pattern"))).select("row", "start", "end", "value", "pattern")


def _again(rows: DataFrame, fresh: DataFrame) -> DataFrame:
    """``value, pattern, n``: where the values of ``fresh(value)`` stand."""
    head = _bare(F.get(F.split(F.col("value"), r"\s", 2), F.lit(0)))
    heads = fresh.select(F.xxhash64(head).alias("code")).distinct()
    firsts = F.transform(F.slice("words", F.lit(2), F.col("n")), lambda w: F.xxhash64(_bare(w)))
    at = _pieces_of(rows).select("row", "piece", F.posexplode(firsts).alias("at", "code")).join(heads, "code", "left_semi")
    hits = at.select("row", "piece", (F.col("at") + 1).alias("at"), F.explode(F.array(*[F.lit(k) for k in range(1, RUN + 1)])).alias("k"))
    runs = _runs(rows, hits).join(fresh, "value", "left_semi")
    # Single words stand under one neighbour too, longer runs between two.
    each = runs.select("value", "k", F.explode("patterns").alias("pattern")).where("pattern IS NOT NULL AND (k = 1 OR pattern LIKE '=%')")
    return each.groupBy("value", "pattern").agg(F.count(F.lit(1)).alias("n"))


def _confident(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Patterns of ``edges(pattern, value, known)`` that end up with high confidence, and the instances' scores."""
    # An instance seen as a base span anywhere is known with certainty.
    score = edges.groupBy("value").agg(F.max(F.col("known").cast("double")).alias("score"))
    for _ in range(ROUNDS):
        weighed = edges.join(score, "value")
        patterns = weighed.groupBy("pattern").agg((F.sum("score") / F.count(F.lit(1))).alias("confidence"), F.sum("score").alias("support"))
        patterns = materialise(patterns.where(f"confidence >= {CONFIDENT} AND support >= {SUPPORT}").select("pattern", "confidence"), "pii-patterns")
        # 1 - product of the patterns' doubts, certainty for the seeds.
        doubt = F.exp(F.sum(F.log1p(-F.least(F.coalesce("confidence", F.lit(0.0)), F.lit(0.999)))))
        score = edges.join(patterns, "pattern", "left").groupBy("value").agg(
            F.greatest(F.max(F.col("known").cast("double")), F.lit(1.0) - doubt).alias("score")
        )
        score = materialise(score, "pii-scores")
    return patterns.select("pattern"), score


def _bootstrap(rows: DataFrame) -> DataFrame:
    """``row, start, end`` of the candidates under confident patterns, of ``rows(row, text, base)``."""
    seed = rows.select(F.explode("base").alias("s"))
    before = _near(F.regexp_extract(_bare(F.col("s.before")), r"(\S+)$", 1))
    after = _near(F.regexp_extract(_bare(F.col("s.after")), r"^(\S+)", 1))
    seed = seed.select(F.col("s.value").alias("value"), F.explode(_patterns(before, after)).alias("pattern"))
    known = materialise(seed.where("pattern IS NOT NULL").groupBy("value", "pattern").agg(F.count(F.lit(1)).alias("n")), "pii-seeds")
    places, good, runs, confident = known, None, None, None
    for turn in range(GROWTHS + 1):
        new = _worthwhile(rows, places)
        new = materialise(new if good is None else new.join(good, "pattern", "left_anti"), "pii-good")
        if new.isEmpty():
            break
        good = new if good is None else good.union(new)
        more = materialise(_under(rows, new), "pii-runs")
        runs = more if runs is None else runs.union(more)
        edges = runs.select("pattern", "value", F.lit(False).alias("known")).union(known.join(good, "pattern", "left_semi").select("pattern", "value", F.lit(True)))
        edges = materialise(edges.groupBy("pattern", "value").agg(F.max("known").alias("known")), "pii-edges")
        confident, score = _confident(edges)
        if turn == GROWTHS:
            break
        fresh = materialise(score.where(f"score >= {CONFIDENT}").select("value").join(known, "value", "left_anti"), "pii-fresh")
        if fresh.isEmpty():
            break
        places = known.union(materialise(_again(rows, fresh), "pii-again"))
    if runs is None:
        return rows.limit(0).select("row", F.lit(0).alias("start"), F.lit(0).alias("end"))
    return runs.join(confident, "pattern", "left_semi").select("row", "start", "end").distinct()


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, added`` of every row: arrays of (start, kind, end)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    # Written with the spans, so that nothing below computes them again.
    rows = rows.withColumn("base", base_spans(F.col("text"))).withColumn("row", F.monotonically_increasing_id())
    rows = materialise(rows, "pii-base")
    new = _bootstrap(rows)
    new = new.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", (-F.col("end")).alias("end")))).alias("all"))

    def apart(acc, x):
        one = F.array(F.struct(x["start"].alias("start"), F.lit(4).alias("kind"), (-x["end"]).alias("end")))
        return F.when(x["start"] >= acc["at"], F.struct((-x["end"]).alias("at"), F.concat(acc["out"], one).alias("out"))).otherwise(acc)

    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    added = F.aggregate("all", F.struct(F.lit(0).alias("at"), empty.alias("out")), apart, lambda acc: acc["out"])
    new = materialise(new.select("row", added.alias("added")), "pii-added")
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    out = rows.select("row", "doc_id", plain.alias("base")).join(new, "row", "left")
    return out.select("doc_id", "base", F.coalesce("added", empty).alias("added"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
