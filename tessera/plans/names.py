"""Name containment kept up to date while names and texts come in: for each pair of words ever asked for, the first text
that contains both, as ``first_containing`` gives it for all pairs and texts so far.

Tables in hash buckets (``buckets.py``):

* ``words``, by their first characters: new texts are held against the words that begin like one of their places;
* ``grams`` from each substring of up to ``GRAM`` characters to the keys of the texts that have it, and ``texts`` by
  key: new words are held against the texts that have their first characters, and no other text is read;
* ``found``, from each word to the texts that contain it, the inverted index: a new pair of words that are known
  already is answered from it without any text being searched;
* ``pairs`` by their first word: pairs asked for before are looked at again in new texts only;
* ``firsts``, the answer.

The 64-bit key of a text only tells which texts to read; texts themselves decide. Each batch makes a version of its own
number from the last one below it, so a batch that is run again gives the same state. Pairs and texts that were given
before cost a lookup; a text that comes again with a lower order counts with that. Pairs with a null, and null and empty
texts, are left out; an empty word is in every other text, and only it is held against all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import scratch
from tessera.operators.containment import PREFIX_ROWS, first_of_pairs, words_in
from tessera.sources import buckets

GRAM = 3

_TABLES = {
    "pairs": (["a"], "a STRING, b STRING"),
    "words": (["gram"], "gram STRING, word STRING"),
    "texts": (["k"], "k BIGINT, text STRING, first BIGINT"),
    "grams": (["gram"], "gram STRING, k BIGINT"),
    "found": (["word"], "word STRING, text STRING, first BIGINT"),
    "firsts": (["a", "b"], "a STRING, b STRING, first BIGINT"),
}


def _begin(word: str) -> Column:
    return F.substring(word, 1, GRAM).alias("gram")


def _grams(texts: DataFrame) -> DataFrame:
    """``(gram, k)``: the substrings of each text that are as long as the begin of a word can be."""
    places = texts.select("k", "text", F.explode(F.sequence(F.lit(1), F.length("text"))).alias("at"))
    sizes = F.explode(F.array(*[F.lit(n) for n in range(1, GRAM + 1)])).alias("size")
    return places.select("k", "text", "at", sizes).select(F.expr("substring(text, at, size)").alias("gram"), "k").distinct()


def _least(keys: list[str]) -> buckets.Combine:
    return lambda stored, changes: stored.unionByName(changes).groupBy(*keys).agg(F.min("first").alias("first"))


def _added(stored: DataFrame, changes: DataFrame) -> DataFrame:
    return stored.unionByName(changes).distinct()


def advance(
    pairs: DataFrame, texts: DataFrame, root: str, version: int, order: str, prefix_rows: int = PREFIX_ROWS
) -> None:
    """Take in one batch, as version ``version``: the words ``(a, b)`` of ``pairs``, and ``texts`` with a column ``text``
    and the whole number ``order``."""
    spark = pairs.sparkSession
    held = buckets.load(spark, root, buckets.latest(spark, root, version)).tables

    def stored(name: str, keys: DataFrame) -> DataFrame:
        return buckets.lookup(spark, root, held.get(name), keys, _TABLES[name][1])

    def updated(name: str, changes: DataFrame, combine: buckets.Combine) -> buckets.Table:
        keys, ddl = _TABLES[name]
        return buckets.update(scratch.materialise(changes, name), root, name, keys, ddl, held.get(name), combine)

    asked = scratch.materialise(pairs.select("a", "b").dropna().distinct(), "asked")
    new_pairs = scratch.materialise(asked.join(stored("pairs", asked), ["a", "b"], "left_anti"), "new-pairs")
    words = scratch.materialise(
        new_pairs.select(F.explode(F.array("a", "b")).alias("word")).distinct().select(_begin("word"), "word"), "words"
    )
    new_words = scratch.materialise(words.join(stored("words", words), ["gram", "word"], "left_anti"), "new-words")

    given = scratch.materialise(
        texts.where(F.col("text") != "").groupBy(F.xxhash64("text").alias("k"), "text")
        .agg(F.min(order).cast("long").alias("first")), "given-texts",
    )
    earlier = stored("texts", given).withColumnRenamed("first", "__held")
    new_texts = scratch.materialise(
        given.join(earlier, ["k", "text"], "left").where(F.col("__held").isNull() | (F.col("first") < F.col("__held")))
        .drop("__held"), "new-texts",
    )

    if new_pairs.isEmpty() and new_texts.isEmpty():
        buckets.commit(spark, root, version, held)
        return

    # New texts against every word, then new words against the texts before.
    grams = scratch.materialise(_grams(new_texts), "grams")
    begins = grams.select("gram").unionByName(spark.createDataFrame([("",)], "gram string")).distinct()
    known = stored("words", begins).join(begins, "gram", "left_semi")
    here = scratch.materialise(_searched(known.unionByName(new_words), new_texts, prefix_rows), "found-here")
    there = _searched(new_words, _sharing(spark, root, held, new_words, stored), prefix_rows)
    found = updated("found", here.unionByName(there), _least(["word", "text"]))

    # Pairs asked before have news in new texts only; new pairs are answered from the index.
    met = here.select("word").distinct()
    again = stored("pairs", met.select(F.col("word").alias("a")))
    index = buckets.lookup(spark, root, found, words, _TABLES["found"][1])
    index = scratch.materialise(index.join(words.select("word"), "word", "left_semi"), "index")
    answers = first_of_pairs(again, here, "first").unionByName(first_of_pairs(new_pairs, index, "first"))

    buckets.commit(spark, root, version, {
        "pairs": updated("pairs", new_pairs, _added),
        "words": updated("words", new_words, _added),
        "texts": updated("texts", new_texts, _least(["k", "text"])),
        "grams": updated("grams", grams, _added),
        "found": found,
        "firsts": updated("firsts", answers, _least(["a", "b"])),
    })


def _sharing(spark: SparkSession, root: str, held: dict[str, buckets.Table], words: DataFrame, stored) -> DataFrame:
    """The stored texts that have the begin of one of these words."""
    if "texts" in held and not words.where(F.col("word") == "").isEmpty():
        return buckets.read(spark, root, held["texts"])
    keys = stored("grams", words).join(words.select("gram").distinct(), "gram", "left_semi").select("k").distinct()
    keys = scratch.materialise(keys, "sharing")
    return stored("texts", keys).join(keys, "k", "left_semi")


def _searched(words: DataFrame, texts: DataFrame, prefix_rows: int) -> DataFrame:
    """``(word, text, first)`` of the words in these texts."""
    words = scratch.materialise(words.select("word").distinct(), "vocabulary")
    texts = scratch.materialise(texts.select("text", "first"), "searched")
    if words.isEmpty() or texts.isEmpty():
        return words.sparkSession.createDataFrame([], _TABLES["found"][1])
    return words_in(words, texts, "first", prefix_rows).select("word", "text", "first")


def firsts(spark: SparkSession, root: str, order: str = "first", version: int | None = None) -> DataFrame:
    """``(a, b, order)`` as of a version, or the latest, for the pairs asked for until then that some text contains."""
    number = buckets.latest(spark, root) if version is None else version
    held = buckets.load(spark, root, number).tables
    if "firsts" not in held:
        found = spark.createDataFrame([], _TABLES["firsts"][1])
    else:
        found = buckets.read(spark, root, held["firsts"])
    return found.withColumnRenamed("first", order)
