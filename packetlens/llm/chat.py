"""Chat formatting by a finite-state machine over roles, with loss flags per segment.

A template declares, for each role, the marks around its texts, whether its text counts in
the loss, and which roles may come before it. A role names the machine's state after it, so
the order of turns is valid if every step from one state to the next is allowed; a window
over a conversation's turns walks the machine.

Control strings inside a text are escaped: backslashes are doubled, then a backslash follows
the first character of each control string. No control string is left in an escaped text,
so the output splits at the marks, and unescaping gives the text back.

* Null texts are empty; null roles are the role ``""``. Roles the template lacks are written
  with the marks of unknown roles, and make their conversation invalid.
* Turns of one number are ordered by role and text; repeated rows are turns of their own.
* Rows with a null conv_id form a conversation; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<start>", "<end>"


@dataclass(frozen=True)
class Role:
    opening: str
    closing: str
    loss: bool
    after: tuple[str, ...]


@dataclass(frozen=True)
class Template:
    roles: dict[str, Role]
    #: Marks of roles that ``roles`` lacks; the role itself stands between the first two.
    unknown: tuple[str, str, str]
    final: tuple[str, ...]
    #: The strings that marks are made of; none is left in an escaped text.
    controls: tuple[str, ...]


INSTRUCT = Template(
    {
        "system": Role("<<SYS>>\n", "\n<</SYS>>\n", False, (START,)),
        "user": Role("<s>[INST] ", " [/INST]", False, (START, "system", "assistant")),
        "assistant": Role("[REPLY] ", " </s>\n", True, ("user",)),
    },
    ("[ROLE]", "[/ROLE]", "[/END]"),
    ("assistant",),
    ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[REPLY]", "[ROLE]", "[/ROLE]", "[/END]"),
)


def quoted(text: str) -> str:
    """A regular expression that matches ``text`` alone."""
    return "".join(c if c.isalnum() else f"\\{c}" for c in text)


def escaped(text: Column, template: Template) -> Column:
    rest = "|".join(f"{quoted(c[0])}(?={quoted(c[1:])})" for c in template.controls)
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({rest})", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _by_role(role: Column, template: Template, what) -> Column:
    found = F.when(F.lit(False), F.lit(None))
    for name, r in template.roles.items():
        found = found.when(role == name, F.lit(what(r)))
    return found


def turns(rows: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """conv_id, place (from 0), role, allowed (by the machine), is_last, and the turn's
    segments in order: opening, text, closing, each with its loss flag."""
    clean = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    role = F.col("role")
    before = F.coalesce(F.lag("role").over(order), F.lit(START))
    steps = F.lit(False)
    for name, r in template.roles.items():
        steps = steps | ((role == name) & F.col("state").isin(*r.after))
    left, middle, right = template.unknown
    opening = F.coalesce(
        _by_role(role, template, lambda r: r.opening),
        F.concat(F.lit(left), escaped(role, template), F.lit(middle)))
    closing = F.coalesce(_by_role(role, template, lambda r: r.closing), F.lit(right))
    loss = F.coalesce(_by_role(role, template, lambda r: r.loss), F.lit(False))

    def segment(text: Column, flag: Column) -> Column:
        return F.struct(text.alias("text"), flag.alias("loss"))

    no = F.lit(False)
    return clean.select(
        "conv_id", (F.row_number().over(order) - 1).alias("place"), "role", "text",
        before.alias("state"), F.lead("role").over(order).isNull().alias("is_last"),
    ).select(
        "conv_id", "place", "role",
        (steps & (~F.col("is_last") | role.isin(*template.final))).alias("allowed"),
        F.array(segment(opening, no), segment(escaped(F.col("text"), template), loss),
                segment(closing, no)).alias("segments"),
    )


def formatted(rows: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """conv_id, valid (the order of turns), formatted text, and its segments: the length in
    code points of each and its loss flag. A row holds a conversation, so its size is that of
    the longest one."""
    own = turns(rows, template)
    packed = own.groupBy("conv_id").agg(
        F.min("allowed").alias("valid"),
        F.array_sort(F.collect_list(F.struct("place", "segments"))).alias("t"))
    segments = F.flatten(F.col("t.segments"))
    return packed.select("conv_id", "valid", segments.alias("s")).select(
        "conv_id", "valid", F.array_join(F.col("s.text"), "").alias("formatted"),
        F.transform("s", lambda x: F.struct(
            F.length(x["text"]).alias("n_chars"), x["loss"].alias("loss"))).alias("mask"),
    )


def read_back(chats: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """conv_id, the turns (role and text) parsed from ``formatted``, the texts under the loss
    mask, and ``formatted``. Turns end where a closing mark stands, as no text holds one."""
    left, middle, right = template.unknown
    closings = [r.closing for r in template.roles.values()] + [right]
    ends = "|".join(f"(?<={quoted(c)})" for c in closings)
    pieces = F.filter(F.split("formatted", ends), lambda p: p != "")

    def role_of(p: Column) -> Column:
        found = unescaped(F.substring_index(F.substr(p, F.lit(len(left) + 1)), middle, 1))
        for name, r in template.roles.items():
            found = F.when(p.startswith(r.opening), F.lit(name)).otherwise(found)
        return found

    def text_of(p: Column) -> Column:
        head = F.length(F.substring_index(p, middle, 1)) + len(middle)
        found = F.substr(p, head + 1, F.length(p) - head - len(right))
        for r in template.roles.values():
            own = F.substr(p, F.lit(len(r.opening) + 1), F.length(p) - len(r.opening) - len(r.closing))
            found = F.when(p.startswith(r.opening), own).otherwise(found)
        return unescaped(found)

    parsed = F.transform(pieces, lambda p: F.struct(role_of(p).alias("role"), text_of(p).alias("text")))
    # Where each segment of the mask begins, by adding up lengths.
    spans = F.aggregate(
        "mask", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("texts")),
        lambda acc, m: F.struct(
            (acc["at"] + m["n_chars"]).alias("at"),
            F.when(m["loss"], F.concat(acc["texts"], F.array(
                F.substr(F.col("formatted"), acc["at"] + 1, m["n_chars"])))).otherwise(acc["texts"]).alias("texts")))
    return chats.select(
        "conv_id", "valid", "formatted", parsed.alias("turns"),
        F.transform(spans["texts"], unescaped).alias("loss_texts"))
