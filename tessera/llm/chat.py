"""Conversations as training texts with a loss mask, by Spark expressions alone.

The turns of a conversation are collected as structs and sorted, adjacent turns of one role become one
block by array functions, and the blocks are joined to one text. A template gives each role an opening and a
closing mark, and one mark stands between the turns of a block. Where the first character of a mark and the rest
of one meet inside a text, a backslash is put between them (one more, where backslashes stand there already),
which can be undone exactly. The loss mask lists the lengths of all parts of the text in order, marks and texts in turn,
each with whether it is learned.

Defined cases: a null text is empty, a null role is the empty role; any role the template does not know is written
with its name. Turns come by (turn, role, text), nulls first, so ties and repeated rows have one order, and
each row is a turn. A null conversation id is an id like any other. An empty table gives no rows. Extra
columns are left out. A conversation is one row, and so has to fit in one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.texts import let


@dataclass(frozen=True)
class Template:
    """Marks by role. The first character of a mark occurs nowhere else in any mark."""

    roles: tuple[tuple[str, str, str], ...] = (
        ("system", "[SYS]", "[/SYS]"),
        ("user", "[INST]", "[/INST]"),
        ("assistant", "<s>", "</s>"),
    )
    #: Before the name of another role, between name and text, and after the text.
    other: tuple[str, str, str] = ("[ROLE]", "[TEXT]", "[/ROLE]")
    between: str = "[NEXT]"
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        heads = {m[0] for m in self.marks}
        if any(c in heads or c == "\\" for m in self.marks for c in m[1:]):
            raise ValueError("a mark starts inside another, or has a backslash")

    @property
    def openings(self) -> list[str]:
        return [r[1] for r in self.roles] + [self.other[1]]

    @property
    def closings(self) -> list[str]:
        return [r[2] for r in self.roles] + [self.other[2]]

    @property
    def marks(self) -> list[str]:
        return [*self.openings, *self.closings, self.other[0], self.between]

    @property
    def inner(self) -> tuple[str, str]:
        """Patterns of a mark's first character and of its rest."""
        heads = "".join(sorted({re.escape(m[0]) for m in self.marks}))
        return f"([{heads}])", f"({'|'.join(sorted({re.escape(m[1:]) for m in self.marks}))})"


def _any(marks: list[str]) -> str:
    return "|".join(re.escape(m) for m in marks)


def escaped(text: Column, template: Template) -> Column:
    head, rest = template.inner
    return F.regexp_replace(text, rf"{head}(\\*){rest}", r"$1\\$2$3")


def unescaped(text: Column, template: Template) -> Column:
    head, rest = template.inner
    return F.regexp_replace(text, rf"{head}\\(\\*){rest}", r"$1$2$3")


def _blocks(turns: Column) -> Column:
    """Adjacent turns of one role as ``(role, texts)``."""
    size = F.size(turns)

    def starts_block(i):
        return (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"])

    def block(starts):
        return F.transform(starts, lambda start, k: F.struct(
            F.get(turns, start)["role"].alias("role"),
            F.transform(
                F.slice(turns, start + 1, F.coalesce(F.get(starts, k + 1), size) - start), lambda t: t["text"]
            ).alias("texts"),
        ))

    return let(F.filter(F.sequence(F.lit(0), size - 1), starts_block), block)


def _parts(block: Column, template: Template) -> Column:
    """A block as ``(mark, text, learned)`` in order; the closing mark has an empty text."""
    role = block["role"]
    opening, closing = F.lit(template.other[1]), F.lit(template.other[2])
    for name, first, last in template.roles:
        opening = F.when(role == name, F.lit(first)).otherwise(opening)
        closing = F.when(role == name, F.lit(last)).otherwise(closing)

    def part(mark, text, learned):
        return F.struct(mark.alias("mark"), text.alias("text"), learned.alias("learned"))

    name = F.when(
        role.isin([r[0] for r in template.roles]), F.array().cast("array<struct<mark:string,text:string,learned:boolean>>")
    ).otherwise(F.array(part(F.lit(template.other[0]), escaped(role, template), F.lit(False))))
    texts = F.transform(block["texts"], lambda text, i: part(
        F.when(i == 0, opening).otherwise(F.lit(template.between)),
        escaped(text, template),
        role.isin(list(template.learned)),
    ))
    return F.concat(name, texts, F.array(part(closing, F.lit(""), F.lit(False))))


def formatted(
    rows: DataFrame, template: Template = Template(), conv_id: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text",
) -> DataFrame:
    """``(conv_id, formatted, mask)``: the whole text of each conversation and its loss mask, an array of
    ``(chars, learned)`` over all of the text."""
    plain = rows.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("one"),
    )
    turns = plain.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    blocks = turns.select("conv_id", _blocks(F.col("turns")).alias("blocks"))
    parts = blocks.select(
        "conv_id", F.flatten(F.transform("blocks", lambda b: _parts(b, template))).alias("parts")
    )
    return parts.select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: F.concat(p["mark"], p["text"])), "").alias("formatted"),
        F.flatten(F.transform("parts", lambda p: F.array(
            F.struct(F.length(p["mark"]).alias("chars"), F.lit(False).alias("learned")),
            F.struct(F.length(p["text"]).alias("chars"), p["learned"].alias("learned")),
        ))).alias("mask"),
    )


def _turns(text: Column, template: Template) -> Column:
    """The turns ``(role, text)`` that a formatted text holds."""
    roles = {opening: name for name, opening, _ in template.roles}

    def of(block):
        def read(pieces):
            role = unescaped(F.substr(F.get(pieces, F.lit(0)), F.lit(len(template.other[0]) + 1)), template)
            for opening, name in roles.items():
                role = F.when(F.startswith(block, F.lit(opening)), F.lit(name)).otherwise(role)
            return F.transform(
                F.split(F.get(pieces, F.lit(1)), re.escape(template.between)),
                lambda t: F.struct(role.alias("role"), unescaped(t, template).alias("text")),
            )

        return let(F.split(block, _any(template.openings)), read)

    def all_of(blocks):
        return F.flatten(F.transform(F.slice(blocks, 1, F.size(blocks) - 1), of))

    return let(F.split(text, _any(template.closings)), all_of)


def _learned(text: Column, mask: Column, template: Template) -> Column:
    """The texts under the loss mask, in order, unescaped."""
    texts = F.transform(
        F.split(text, _any(template.marks)),
        lambda t, i: F.struct(t.alias("text"), F.get(mask, 2 * i - 1)["learned"].alias("learned")),
    )
    return F.transform(F.filter(texts, lambda t: t["learned"]), lambda t: unescaped(t["text"], template))


def read_back(made: DataFrame, template: Template = Template()) -> DataFrame:
    """``made`` with ``turns``, an array of ``(role, text)``, and ``learned``, the texts under the mask, both
    taken from the formatted text and its mask alone."""
    return made.withColumns({
        "turns": _turns(F.col("formatted"), template),
        "learned": _learned(F.col("formatted"), F.col("mask"), template),
    })


def digests(rows: DataFrame, template: Template = Template(), **columns: str) -> DataFrame:
    """Counts and hashes of what each formatted conversation gives back."""
    back = read_back(formatted(rows, template, **columns), template).select(
        "conv_id", "formatted", "turns", F.array_join("learned", "").alias("learned")
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
