"""JSON payload checks on the message value.

A payload is accepted when its bytes are valid UTF-8 and the text is exactly
one JSON object. Spark's ``try_parse_json`` stops after the first value, so
text after it is found separately. An object whose first closing brace is the end
of the text, the producer's form, is whole. For other objects and arrays, string
literals are blanked, every character but brackets is dropped, and the first
return of the bracket depth to zero must be the last bracket. Scalars must match
the scalar grammar as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .text import WHITE_SPACE

# No alternation inside a loop and possessive quantifiers: Java then matches in
# a loop instead of one stack frame per character.
_STRING_LITERAL = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_NOT_BRACKET = r"[^\[\]{}]"
_SCALAR = r'^\s*(-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?|true|false|null|"[^"\\]*+(?:\\.[^"\\]*+)*+")\s*$'

_JSON_SPACE = " \t\r\n"

REASON_NULL = "null_value"
REASON_UTF8 = "invalid_utf8"
REASON_MALFORMED = "malformed_json"
REASON_NOT_OBJECT = "not_an_object"


def as_text(value: Column) -> Column:
    """Message value (binary or string) as text."""
    return value.cast("string")


def accept_repeated_keys(spark: SparkSession) -> None:
    """Repeated keys of an object are accepted, the last one wins.

    The parser takes this from a session setting; it is set here, so that a
    payload is not judged by what session it happens to run in.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def parse(value_text: Column) -> Column:
    return F.try_parse_json(value_text)


def _closes_at_end(brackets: Column) -> Column:
    # The position (1-based) where the depth first drops back to zero must be
    # the last bracket.
    chars = F.split(brackets, "")
    init = F.struct(F.lit(0).alias("d"), F.lit(0).alias("z"), F.lit(0).alias("n"))

    def step(acc, c):
        d = acc["d"] + F.when(c.isin("{", "["), 1).otherwise(-1)
        n = acc["n"] + 1
        z = F.when((acc["z"] == 0) & (d == 0), n).otherwise(acc["z"])
        return F.struct(d.alias("d"), z.alias("z"), n.alias("n"))

    return F.aggregate(chars, init, step, lambda acc: acc["z"] == F.length(brackets))


def _opening(value_text: Column) -> Column:
    """First character of a text that parses: ``{`` of an object, ``[`` of an array.

    It tells the kind without the schema of everything inside.
    """
    return F.left(F.ltrim(value_text, F.lit(_JSON_SPACE)), F.lit(1))


def _whole_text(value_text: Column, opening: Column) -> Column:
    """True when nothing but whitespace follows the first JSON value."""
    stripped = F.rtrim(value_text, F.lit(WHITE_SPACE))
    # An object can only end at a closing brace: where the text's first one is
    # also its end, no look inside is needed.
    flat = F.instr(stripped, "}") == F.length(stripped)
    brackets = F.regexp_replace(F.regexp_replace(value_text, _STRING_LITERAL, '""'), _NOT_BRACKET, "")
    # The bracket text goes into several expressions; as a lambda's argument it is computed once.
    balanced = F.get(F.transform(F.array(brackets), lambda b: F.when(b.isin("{}", "[]"), F.lit(True)).otherwise(_closes_at_end(b))), F.lit(0))
    return (
        F.when(opening == "{", F.when(flat, F.lit(True)).otherwise(stripped.endswith("}") & balanced))
        .when(opening == "[", stripped.endswith("]") & balanced)
        .otherwise(value_text.rlike(_SCALAR))
    )


def string_key(parsed: Column, key: str) -> Column:
    """Value of a top-level key when it is a JSON string; null otherwise (E5)."""
    path = f"$.{key}"
    kind = F.schema_of_variant(F.variant_get(parsed, path, "variant"))
    return F.when(kind == "STRING", F.try_variant_get(parsed, path, "string"))


def malformed_reason(value: Column, text: Column | None = None, parsed: Column | None = None) -> Column:
    """Why a payload is rejected, or null when it is one JSON object.

    ``text`` and ``parsed`` may be given as already computed columns.
    """
    text = as_text(value) if text is None else text
    parsed = parse(text) if parsed is None else parsed
    opening = _opening(text)
    return (
        F.when(value.isNull(), F.lit(REASON_NULL))
        .when(~F.is_valid_utf8(text), F.lit(REASON_UTF8))
        .when(parsed.isNull(), F.lit(REASON_MALFORMED))
        .when(~_whole_text(text, opening), F.lit(REASON_MALFORMED))
        .when(opening != "{", F.lit(REASON_NOT_OBJECT))
    )
