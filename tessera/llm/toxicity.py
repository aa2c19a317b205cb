"""Toxicity by weak supervision: many lexicon and pattern voters, a label model, a linear classifier.

1. Voters are words and word beginnings that occur far more often in texts labelled toxic; a likelihood
   ratio decides, against the number of patterns tried. Patterns of the same texts are one voter from the start, and
   all that pass the test are kept. They vote "toxic" or abstain; one more voter says "clean" where no pattern occurs. Labels come from ``TRAIN_ROWS`` rows at most, never
   from held-out ones (crc32 of the id modulo 3 is 1).
2. The label model estimates by expectation-maximisation how often each voter is right, and from the
   votes how far voters depend on each other: patterns that nearly always fire together are one voter, and
   the say of a voter is divided by its correlated company.
   The counts of step 1 are the prior.
3. A logistic classifier over the voters is trained on the posterior labels, not on the given ones.
4. Every whole text is scored in Spark with the voters and weights. Their number is bounded by the sample: a voter
   is a set of its texts, and has to occur in several.

Scores depend on the text alone. Defined cases: a null or empty text is scored like one without any
pattern; rows with a null id are not held out and never used for training; repeated labels of a
document count as toxic if any is; repeated rows are scored alike, equal texts train once; without labels
of both kinds all scores are 0; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.texts import as_bytes, per_row, slices, whole_text

#: Bounds of the sample of labelled rows, by label; taken by hash of the id.
TRAIN_ROWS = {1: 6_000, 0: 14_000}
PREFIXES = range(3, 9)
PREDICT_AT = 0.7

#: The part of a voter's training texts that are labelled toxic, at least.
LEAST_SHARE = 0.9

#: Words kept with their voters per worker; a full store starts anew.
CACHE_WORDS = 300_000

_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def patterns(word: str) -> list[str]:
    """A word, and its beginnings marked by a hyphen."""
    return [word, *(word[:n] + "-" for n in PREFIXES if n <= len(word))]


class Model(NamedTuple):
    """``voters`` gives the feature of each pattern; ``weights`` end with those of the number of
    features found and the intercept."""

    voters: dict[str, int]
    weights: np.ndarray


def training_rows(docs: DataFrame, labels: DataFrame, bounds: dict[int, int] | None = None) -> DataFrame:
    """``(k, text, toxic)``: different texts of a bounded sample of the labels.

    The sample is chosen from the labels alone; its bounded number of ids goes to the documents, so no
    text is shuffled to find it.
    """
    open_ = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    chosen = None
    for label, n in (bounds or TRAIN_ROWS).items():
        part = open_.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        chosen = part if chosen is None else chosen.unionByName(part)
    named = docs.select(F.col("doc_id"), whole_text().alias("text"))
    rows = named.join(F.broadcast(chosen), "doc_id")
    return rows.groupBy(F.xxhash64("text").alias("k"), "text").agg(F.max("toxic").alias("toxic"))


def counted(rows: DataFrame) -> DataFrame:
    """``(pattern, toxic, clean, texts)``: in how many training texts each pattern occurs, and in which: the
    exclusive or of their keys."""

    def count(batches):
        for batch in slices(batches, "text"):
            found = (Counter(), Counter())
            texts: dict[str, int] = {}
            marks = zip(*(batch.column(c).to_pylist() for c in ("k", "toxic")), strict=True)
            for raw, (key, toxic) in zip(as_bytes(batch.column("text")), marks, strict=True):
                own = {p for w in set(_WORD.findall(raw.decode().lower())) for p in patterns(w)}
                found[toxic].update(own)
                for p in own:
                    texts[p] = texts.get(p, 0) ^ key
            every = list(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(every, pa.string())] + [pa.array([found[k][p] for p in every], pa.int64()) for k in (1, 0)]
                + [pa.array(list(texts.values()), pa.int64())],
                names=["pattern", "toxic", "clean", "texts"],
            )

    return (
        rows.select("k", "text", "toxic").mapInArrow(count, "pattern string, toxic long, clean long, texts long")
        .groupBy("pattern").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_xor("texts").alias("texts"))
    )


def selected(counts: DataFrame, toxic: int, clean: int) -> list[tuple[list[str], int, int]]:
    """The patterns whose likelihood ratio beats the best that chance would give among so many; those that occur in
    the same texts together, the shortest first."""
    tried = counts.where(F.col("toxic") + F.col("clean") > 1).count()
    every, t, c = toxic + clean, F.col("toxic"), F.col("clean")
    rate = F.lit(toxic / every)

    def term(k: Column, n: Column) -> Column:
        return F.when(k > 0, k * F.log(k / n)).otherwise(0.0)

    n = t + c
    ratio = 2 * (term(t, n * rate) + term(c, n * (1 - rate)))
    named = F.struct(F.length("pattern").alias("length"), "pattern")
    rows = (
        counts.where((t > 1) & (t / n >= LEAST_SHARE)).withColumn("ratio", ratio)
        .where(F.col("ratio") > 2 * np.log(max(2, tried)))
        .groupBy("texts", "toxic", "clean").agg(F.max("ratio").alias("ratio"), F.sort_array(F.collect_list(named)).alias("own"))
        .orderBy(F.desc("ratio"), "own").collect()
    )
    return [([o["pattern"] for o in r["own"]], r["toxic"], r["clean"]) for r in rows]


def hits(text: str, voters: dict[str, int], cache: dict[str, tuple[int, ...]]) -> list[int]:
    """The voters that fire on a text."""
    found: set[int] = set()
    for word in set(_WORD.findall(text.lower())):
        own = cache.get(word)
        if own is None:
            own = tuple(voters[p] for p in patterns(word) if p in voters)
            if len(cache) >= CACHE_WORDS:
                cache.clear()
            if len(word) <= 40:
                cache[word] = own
        if own:
            found.update(own)
    return sorted(found)


def vote_rows(rows: DataFrame, voters: dict[str, int]) -> tuple[list[list[int]], np.ndarray]:
    """The votes on the bounded sample, and its labels."""
    cache: dict[str, tuple[int, ...]] = {}
    made = per_row(rows, ["k", "toxic"], "text", lambda raw: (hits(raw.decode(), voters, cache),), "fired array<int>")
    found = made.orderBy("k").select("fired", "toxic").collect()
    return [r["fired"] for r in found], np.array([r["toxic"] for r in found])


def matrix(fired: list[list[int]], voters: int) -> np.ndarray:
    x = np.zeros((len(fired), voters), np.float32)
    for row, own in enumerate(fired):
        x[row, own] = 1
    return x


def company(x: np.ndarray) -> np.ndarray:
    """How much voters fire together: of the rows where either of two does, the part where both do."""
    together = x.T @ x
    alone = np.maximum(1, np.diag(together))
    return together / np.maximum(1, alone[:, None] + alone[None, :] - together)


def merged(x: np.ndarray, same: float = 0.6) -> np.ndarray:
    """The voter of each pattern: patterns that fire with an earlier one almost always are one voter."""
    close = company(x) >= same
    voter = np.full(x.shape[1], -1)
    leaders: list[int] = []
    for k in range(x.shape[1]):
        found = [n for n, j in enumerate(leaders) if close[k, j]]
        if found:
            voter[k] = found[0]
        else:
            voter[k] = len(leaders)
            leaders.append(k)
    return voter


def label_model(
    x: np.ndarray, prior: np.ndarray, none_prior: tuple[int, int], rate: float, rounds: int = 50
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(posterior, accuracy, say)`` from votes ``x`` (rows by voters, 1 for "toxic", 0 to abstain).

    ``prior`` holds the counts of toxic and clean texts per voter, ``none_prior`` those of texts without any
    vote. Abstaining says nothing, but a row without any vote has the vote of one more voter, "clean".
    """
    none = x.sum(axis=1) == 0
    belief = prior + [[0.5, 0.5]]
    # Voters that agree because both are right are no company; correlation among voted rows is.
    voted = x[~none]
    centred = voted - voted.mean(axis=0) if len(voted) else voted
    spread = np.sqrt(np.maximum(1e-9, (centred**2).sum(axis=0)))
    related = np.clip((centred.T @ centred) / np.outer(spread, spread), 0, 1)
    np.fill_diagonal(related, 1)
    related[related < 0.5] = 0
    say = 1 / related.sum(axis=1)
    accuracy = belief[:, 0] / belief.sum(axis=1)
    clean = (none_prior[1] + 0.5) / (sum(none_prior) + 1)
    posterior = np.full(len(x), rate)
    for _ in range(rounds):
        odds = np.log(accuracy / (1 - accuracy)) - np.log(rate / (1 - rate))
        logit = np.log(rate / (1 - rate)) + x @ (say * odds)
        logit[none] = np.log((1 - clean) / clean)
        following = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        right = x.T @ following + belief[:, 0]
        accuracy = np.clip(right / (x.sum(axis=0) + belief.sum(axis=1)), 0.01, 0.999)
        if none.any():
            clean = np.clip(((1 - following[none]).sum() + none_prior[1] + 0.5) / (none.sum() + sum(none_prior) + 1), 0.5, 0.999)
        if np.abs(following - posterior).max() < 1e-6:
            break
        posterior = following
    return posterior, accuracy, say


def _features(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.log1p(x.sum(axis=1, keepdims=True)), np.ones((len(x), 1))], axis=1).astype(float)


def trained(x: np.ndarray, posterior: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Weights of the logistic classifier, by Newton steps; the intercept is not held down."""
    f = _features(x)
    hold = np.full(f.shape[1], 0.1)
    hold[-2:] = 0.01
    weights = np.zeros(f.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(f @ weights, -30, 30)))
        slope = f.T @ (posterior - p) - hold * weights
        bend = (f * (p * (1 - p))[:, None]).T @ f + np.diag(hold)
        step = np.linalg.solve(bend, slope)
        weights += step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return weights


def fitted(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from the sample; None without labels of both kinds, or without any voter."""
    rows = training_rows(docs, labels).persist()
    try:
        number = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not number.get(0) or not number.get(1):
            return None
        found = selected(counted(rows), number[1], number[0])
        if not found:
            return None
        voters = {p: k for k, (own, _, _) in enumerate(found) for p in own}
        fired, toxic = vote_rows(rows, voters)
        x = matrix(fired, len(found))
        voter = merged(x)
        first = np.unique(voter, return_index=True)[1]
        x = np.stack([x[:, voter == v].max(axis=1) for v in range(len(first))], axis=1)
        voters = {p: int(voter[k]) for p, k in voters.items()}
        found = [found[k] for k in first]
        rate = number[1] / (number[0] + number[1])
        none = x.sum(axis=1) == 0
        none_prior = (int(toxic[none].sum()), int((toxic[none] == 0).sum()))
        posterior, _, _ = label_model(x, np.array([[t, c] for _, t, c in found], float), none_prior, rate)
        return Model(voters, trained(x, posterior))
    finally:
        rows.unpersist()


def score(fired: list[int], model: Model | None) -> float:
    if model is None:
        return 0.0
    w = model.weights
    return float(1 / (1 + np.exp(-np.clip(w[fired].sum() + w[-2] * np.log1p(len(fired)) + w[-1], -30, 30))))


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """``(doc, held_out, score, predicted)`` of each row."""
    model = fitted(docs, labels)
    cache: dict[str, tuple[int, ...]] = {}

    def make(raw: bytes) -> tuple:
        if model is None:
            return (0.0,)
        return (score(hits(raw.decode(), model.voters, cache), model),)

    made = per_row(docs, [doc], text, make, "score double")
    return made.select(
        doc, held_out(doc).alias("held_out"), "score",
        F.when(F.col("score") >= PREDICT_AT, 1).otherwise(0).alias("predicted"),
    )
