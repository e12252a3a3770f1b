"""Chat formatting from a declarative template, with a loss flag per segment.

A ``Template`` names the roles, the strings put around each turn, which roles
carry loss, and the finite-state machine over roles as ``state -> role ->
state``. Every turn becomes three segments: head (no loss), text (loss as its
role says), tail (no loss). Texts are escaped so that no control string of the
template can occur in them, and ``read_back`` inverts the output exactly. The
escapes follow from the template; one whose output could not be read back is
refused.

Defined cases: a null text or role counts as empty; turns of a conversation are
ordered by turn (nulls first), ties by role, then text, repeated rows all stay;
a conversation that breaks the turn order is still formatted, with
``valid = false`` and the first bad position (0-based) in ``bad_at``. A role the
template does not declare is written as ``?role``, carries no loss and is
invalid. Extra columns are ignored. A conversation is one output value, so its
turns meet in one task; conversations never share one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    labels: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    open: str = "### "
    after_label: str = ": "
    close: str = "</turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    steps: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "system", "user": "user"},
            "system": {"user": "user"},
            "user": {"assistant": "assistant"},
            "assistant": {"user": "user"},
        }
    )
    final: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        shown = list(self.labels.values())
        if not self.after_label or not self.close or len(set(shown)) < len(shown) or any(x.startswith("?") for x in shown):
            raise ValueError("a template needs a close, a string after the label, and different labels that do not begin with ?")
        if any("\\" in x for x in (self.open, self.after_label, self.close, *shown)):
            raise ValueError("the backslash is the escape character")
        for label in (*shown, "?"):
            head = self.open + label + self.after_label
            if (label + self.after_label).find(self.after_label) != len(label):
                raise ValueError(f"the label {label!r} runs into what follows it")
            # Neither inside a head nor over its end may the closing string begin.
            if self.close in head or any(head.endswith(self.close[:i]) for i in range(1, len(self.close))):
                raise ValueError(f"the closing string begins inside the head of {label!r}")

    @property
    def escapes(self) -> tuple[tuple[str, str], ...]:
        """Raw and escaped form of the escape character and of every character that can begin a control string."""
        raw = list(dict.fromkeys(x[0] for x in (self.open, self.close, self.after_label, "?") if x))
        codes = (c for c in CODES if c not in raw)
        return (("\\", "\\\\"), *((r, "\\" + c) for r, c in zip(raw, codes)))


CODES = "hlcqwxyz"  # more letters than there can be characters to escape, so that some are free


def escape(text: Column, t: Template = Template()) -> Column:
    for raw, esc in t.escapes:
        text = F.replace(text, F.lit(raw), F.lit(esc))
    return text


def unescape(text: Column, t: Template = Template()) -> Column:
    """Inverse of ``escape``: cut at doubled backslashes, undo the rest in each part."""

    def part(p):
        for raw, esc in t.escapes[1:]:
            p = F.replace(p, F.lit(esc), F.lit(raw))
        return p

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), part), "\\")


def _label(role: Column, t: Template) -> Column:
    out = F.concat(F.lit("?"), escape(role, t))
    for name, label in t.labels.items():
        out = F.when(role == name, F.lit(label)).otherwise(out)
    return out


def _role(label: Column, t: Template) -> Column:
    out = unescape(F.substring(label, 2, 2147483647), t)
    for name, shown in t.labels.items():
        out = F.when(label == shown, F.lit(name)).otherwise(out)
    return out


def format_turns(rows: DataFrame, t: Template = Template()) -> DataFrame:
    """One row per conversation: ``conv_id, segments, formatted, valid, bad_at``.

    ``segments`` is an array of (text, loss); ``formatted`` joins their texts.
    """
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    convs = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("t"))
    convs = convs.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segments(x):
        head = F.concat(F.lit(t.open), _label(x["role"], t), F.lit(t.after_label))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(x["text"], t).alias("text"), x["role"].isin(*t.loss_roles).alias("loss")),
            F.struct(F.lit(t.close).alias("text"), F.lit(False).alias("loss")),
        )

    # The machine: fold the roles; once a step is missing the state stays bad
    # and the position of that turn is kept.
    moves = F.create_map(*[F.lit(x) for s, m in t.steps.items() for r, to in m.items() for x in (f"{s}\n{r}", to)])

    def step(acc, role):
        to = F.element_at(moves, F.concat(acc["state"], F.lit("\n"), role))
        broken = acc["bad_at"].isNotNull() | to.isNull()
        return F.struct(
            F.coalesce(to, F.lit("")).alias("state"),
            (acc["at"] + F.lit(1)).alias("at"),
            F.when(broken, F.coalesce(acc["bad_at"], acc["at"])).alias("bad_at"),
        )

    zero = F.struct(F.lit(t.start).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad_at"))
    walked = F.aggregate(F.transform("turns", lambda x: x["role"]), zero, step)
    out = convs.select("conv_id", F.flatten(F.transform("turns", segments)).alias("segments"), walked.alias("w"))
    return out.select(
        "conv_id",
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        (F.col("w.bad_at").isNull() & F.col("w.state").isin(*t.final)).alias("valid"),
        F.col("w.bad_at").alias("bad_at"),
    )


def read_back(formatted: Column, t: Template = Template()) -> Column:
    """Array of (role, text, loss) that the formatted text says."""
    pieces = F.split(formatted, f"\\Q{t.close}\\E", -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(p):
        cut = F.locate(t.after_label, p, len(t.open) + 1)
        label = F.substring(p, F.lit(len(t.open) + 1), cut - F.lit(len(t.open) + 1))
        role = _role(label, t)
        return F.struct(
            role.alias("role"),
            unescape(F.substring(p, cut + F.lit(len(t.after_label)), F.length(p)), t).alias("text"),
            role.isin(*t.loss_roles).alias("loss"),
        )

    return F.transform(pieces, turn)


def masked_text(segments: Column, t: Template = Template()) -> Column:
    """Unescaped text under the loss mask, in order, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], t)), "")
