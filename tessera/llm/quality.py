"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Per document the projection counts words, their characters, symbols, stop words, repeated lines
and words in repeated three-word windows. Every rule of ``RULES`` is a ratio of two of these
counts between two bounds, tested in whole numbers, so that no rounding is involved.

Defined cases: a null or blank text has no words and fails the base rule; null ids and any other
null columns pass through; repeated rows are judged alike, each on its own; extra columns stay as
they are unless their names are those of the results, which then replace them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.texts import let, whole_text, words

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the and of to in is that for it on are with be was as by "
    "der die das und den von zu mit für ist nicht ein eine auf des im "
    "le la les et des de que un une du pour qui dans par est sur "
    "el los las y del en por con para una se lo como más su al"
).split()

SYMBOLS = r"[#*$%&|<>]"


class Rule(NamedTuple):
    """``low <= 100 * part / whole <= high``; a missing bound is open. ``whole`` may be 1."""

    name: str
    part: str
    whole: str
    low: int | None
    high: int | None


# Thresholds in hundredths.
RULES = [
    Rule("length", "n_words", "1", 50 * 100, None),
    Rule("word_length", "word_chars", "n_words", 300, 1000),
    Rule("symbols", "n_symbols", "n_words", None, 10),
    Rule("stop_words", "n_stop_words", "n_words", 2, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 40),
]

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_stop_words", "n_lines",
]


def _repeated_words(w: Column) -> Column:
    """Words in three-word windows that occur twice or more.

    Windows are sorted by their words; equal neighbours are repeats. Their places, in order, cover
    three words each, or as many as there are before the next place.
    """
    windows = F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.struct(x.alias("a"), F.get(w, i + 1).alias("b"), F.get(w, i + 2).alias("c"), i.alias("i")),
    )

    def same(x: Column, y: Column) -> Column:
        return (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    def places(s: Column) -> Column:
        kept = F.filter(
            s,
            lambda x, i: F.coalesce(same(x, F.get(s, i + 1)), F.lit(False))
            | F.coalesce(same(x, F.get(s, i - 1)), F.lit(False)),
        )
        return F.array_sort(F.transform(kept, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
            F.lit(0),
            lambda total, x: total + x,
        )

    return let(let(F.sort_array(windows), places), covered)


def counts(text: Column) -> Column:
    """A struct of all counts of a text, as longs."""
    with_word = r"[^\x20\x09-\x0D]"

    def of_lines(lines: Column) -> list[Column]:
        return [
            (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
            F.size(lines).alias("n_lines"),
        ]

    def of_words(w: Column) -> list[Column]:
        return [
            F.size(w).alias("n_words"),
            F.length(F.array_join(w, "")).alias("word_chars"),
            F.size(F.filter(w, lambda x: x.isin(STOP_WORDS))).alias("n_stop_words"),
            _repeated_words(w).alias("n_repeat_words"),
        ]

    def all_of(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(with_word))
        return F.struct(
            let(words(t), lambda w: F.struct(*of_words(w))).alias("w"),
            let(lines, lambda rows: F.struct(*of_lines(rows))).alias("l"),
            F.regexp_count(t, F.lit(SYMBOLS)).alias("n_symbols"),
        )

    found = let(text, all_of)
    return let(
        found,
        lambda x: F.struct(
            *[
                (x["n_symbols"] if c == "n_symbols" else x["l"][c] if c.endswith("lines") else x["w"][c])
                .cast("long").alias(c)
                for c in COUNTS
            ]
        ),
    )


def _base_failed(value) -> Column:
    return (value("n_words") < 50) | (value("n_repeat_words") * 100 > value("n_words") * 50)


def compiled(value=F.col, rules: list[Rule] = RULES) -> Column:
    """The names of the rules that a row of counts breaks, as one expression; ``value`` gives a
    count by its name."""

    def term(name: str) -> Column:
        return F.lit(int(name)).cast("long") if name.isdigit() else value(name)

    broken = []
    for rule in rules:
        part, whole = term(rule.part) * 100, term(rule.whole)
        bad = F.lit(False)
        if rule.low is not None:
            bad = bad | (part < whole * rule.low)
        if rule.high is not None:
            bad = bad | (part > whole * rule.high)
        broken.append(F.when(bad, F.lit(rule.name)))
    return F.array_compact(F.array(*broken))


def judged(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """``docs`` with all counts, ``base_failed``, ``broken`` (names of rules) and ``kept``."""
    rest = [c for c in docs.columns if c not in {*COUNTS, "base_failed", "broken", "kept", "__counts"}]
    rest = [F.col(f"`{c}`") for c in rest]
    return (
        docs.select(*rest, counts(whole_text(text)).alias("__counts"))
        .select(*rest, "__counts.*")
        .withColumn("base_failed", _base_failed(F.col))
        .withColumn("broken", compiled(rules=rules))
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
    )


def passing(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """The documents that break no rule, as they are. The counts are made once per row, inside the
    filter, and rows keep all columns, whatever their names."""
    verdict = let(
        counts(whole_text(text)),
        lambda c: ~_base_failed(c.getField) & (F.size(compiled(c.getField, rules)) == 0),
    )
    return docs.where(verdict)
