"""First text that contains both words of a pair, without comparing pairs with texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import scratch
from tessera.operators.keyed import spread_group

# Rows of the prefix table that every task may hold, and the longest prefix it is tried with.
PREFIX_ROWS = 500_000
LONGEST_PREFIX = 6

# Leading characters that tell whether any word begins at a place of a text.
START = 3


def _prefix_length(vocabulary: DataFrame, prefix_rows: int) -> tuple[int, list[int]]:
    """The longest prefix with at most ``prefix_rows`` different values, and the lengths of the words
    up to ``START``; one row of counts."""
    sizes = range(1, LONGEST_PREFIX + 1)
    row = vocabulary.agg(
        F.collect_set(F.least(F.length("word"), F.lit(START))).alias("starts"),
        *[F.count_distinct(F.substring("word", 1, k)).alias(str(k)) for k in sizes],
    ).first()
    longest = max((k for k in sizes if row[str(k)] <= prefix_rows), default=1)
    return longest, sorted({min(size, longest) for size in row["starts"]})


def first_containing(
    pairs: DataFrame, texts: DataFrame, order: str, prefix_rows: int = PREFIX_ROWS
) -> DataFrame:
    """For each distinct ``(a, b)`` of ``pairs``, the least ``order`` among the rows of ``texts``
    whose ``text`` contains ``a`` and ``b``. Pairs without such a text are left out.

    Both words must be in the form in which they are searched. An empty word is in every text.

    1. The vocabulary holds each word once. It is written, as it is read several times.
    2. The prefix table holds, per leading characters, the lengths of the words that begin so. The
       prefix is as long as a table of bounded size allows, so that it can be broadcast. A still
       smaller table of the first characters tells which prefix lengths are worth a look.
    3. Each place of each text is looked up in the two tables, which leaves the substrings that have
       the prefix and the length of a word. Only those are shuffled, to meet the vocabulary.
    4. Each pair meets the texts of its rarer word, by equality, and the other word is looked for in those;
       what is left holds the pair, and the first text is a plain minimum. Pairs that nobody
       asked for are never made.
    """
    vocabulary = scratch.materialise(
        pairs.select(F.explode(F.array("a", "b")).alias("word")).distinct(), "vocabulary"
    )
    distinct_texts = texts.where(F.col("text") != "").groupBy("text").agg(F.min(order).alias("first"))
    found = scratch.materialise(words_in(vocabulary, distinct_texts, "first", prefix_rows), "found-words")
    return first_of_pairs(pairs, found, "first").withColumnRenamed("first", order)


def words_in(vocabulary: DataFrame, texts: DataFrame, order: str, prefix_rows: int = PREFIX_ROWS) -> DataFrame:
    """``(word, text, order)``: the words of ``vocabulary`` that each of ``texts`` contains; both are distinct, and the
    vocabulary should come from a file, as it is read several times."""
    prefix, start_sizes = _prefix_length(vocabulary, prefix_rows)
    start = min(START, prefix)
    starts = F.broadcast(
        vocabulary.groupBy(F.substring("word", 1, start).alias("start")).agg(
            F.collect_set(F.least(F.length("word"), F.lit(prefix))).alias("sizes")
        )
    )
    prefixes = F.broadcast(
        vocabulary.groupBy(F.substring("word", 1, prefix).alias("gram")).agg(
            F.collect_set(F.length("word")).alias("lengths")
        )
    )

    places = texts.select(
        "text", order, F.explode(F.sequence(F.lit(1), F.length("text"))).alias("pos")
    ).withColumn("ahead", F.expr(f"substring(text, pos, {prefix})"))
    # A substring that ends with the text is shorter than asked for, and then not of that size. The
    # empty word is looked up once per text, at its first character.
    short = places.select(
        "*", F.explode(F.array(*[F.lit(size) for size in start_sizes])).alias("start_size")
    ).where((F.col("start_size") > 0) | (F.col("pos") == 1))
    begun = (
        short.withColumn("start", F.expr("left(ahead, start_size)"))
        .where(F.length("start") == F.col("start_size"))
        .join(starts, "start")
        .select("text", order, "pos", "ahead", "start_size", F.explode("sizes").alias("size"))
        .where(F.least("size", F.lit(start)) == F.col("start_size"))
    )
    candidates = (
        begun.withColumn("gram", F.expr("left(ahead, size)"))
        .where(F.length("gram") == F.col("size"))
        .join(prefixes, "gram")
        .select("text", order, "pos", "size", F.explode("lengths").alias("word_length"))
        .where(F.least("word_length", F.lit(prefix)) == F.col("size"))
        .where(F.col("word_length") <= F.length("text") - F.col("pos") + 1)
        .select("text", order, F.expr("substring(text, pos, word_length)").alias("word"))
    )
    return candidates.join(vocabulary.select("word"), "word").distinct()


def first_of_pairs(pairs: DataFrame, found: DataFrame, order: str) -> DataFrame:
    """For each distinct pair the least ``order`` of a text that has both words, by the rows of ``words_in``."""
    texts_of = spread_group(found, ["word"], F.count(F.lit(1)).alias("n"))
    wanted = pairs.select("a", "b").distinct()
    wanted = (
        wanted.join(texts_of.select(F.col("word").alias("a"), F.col("n").alias("n_a")), "a")
        .join(texts_of.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b")
    )
    rarer = F.col("n_a") <= F.col("n_b")
    asked = wanted.select(
        "a", "b", F.when(rarer, F.col("a")).otherwise(F.col("b")).alias("word"),
        F.when(rarer, F.col("b")).otherwise(F.col("a")).alias("other"),
    )
    held = asked.join(found, "word").where(F.col("text").contains(F.col("other")))
    return spread_group(held, ["a", "b"], F.min(order).alias(order))
