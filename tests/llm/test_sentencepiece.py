import hashlib
import random

import pytest
import sentencepiece as library
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import sentencepiece as S


@pytest.fixture(scope="module")
def encoder():
    return S.Encoder(S.vocabulary())


@pytest.fixture(scope="module")
def by_scores():
    return S.Encoder(S.vocabulary()._replace(merges=False))


@pytest.fixture(scope="module")
def scores():
    return {p: (i, s) for p, i, s in S.vocabulary().pieces}


def brute(text, scores, unknown):
    """The best score over all segmentations of the whole text."""
    marked = (" " + text).replace(S.MARK, "\uffff").replace(" ", S.MARK)
    best = [0.0] + [float("-inf")] * len(marked)
    for end in range(1, len(marked) + 1):
        best[end] = best[end - 1] + unknown
        for start in range(max(0, end - 16), end):
            if marked[start:end] in scores:
                best[end] = max(best[end], best[start] + scores[marked[start:end]][1])
    return best[-1]


def score_of(ids, by_id, unknown):
    """The score of a segmentation; runs of bytes count once per character."""
    total = 0.0
    for i in ids:
        if i in by_id:
            total += by_id[i]
    raw = bytes(i - 3 for i in ids if 3 <= i < 259)
    return total + unknown * len(raw.decode())


def test_same_ids_as_the_library(encoder):
    model = library.SentencePieceProcessor(model_file=S.DEFAULT_MODEL)
    rng = random.Random(4)
    syllables = "the and tion er re ed es on in ou ble th at is a i é ß ä ung 12 3 . , !! 梦 😀 == ab aa aaa".split()
    for _ in range(3000):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 6))]
        text = "".join(w + rng.choice([" ", " ", "  ", "\n", " " * rng.randint(1, 40), "\t "]) for w in words)
        assert encoder.encode(text) == model.encode(text), text


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("  abcdeinrst\n\t▁éß梦\U0001f600\x00.,<>")), max_size=60))
def test_best_score_and_exact_round_trip(encoder, by_scores, scores, text):
    assert encoder.decode(encoder.encode(text)) == text.encode()
    ids = by_scores.encode(text)
    assert by_scores.decode(ids) == text.encode()
    if text:
        by_id = {i: s for i, s in scores.values()}
        assert score_of(ids, by_id, by_scores.unknown) == pytest.approx(brute(text, scores, by_scores.unknown))


def test_rows(spark):
    rows = [(1, None, 1), (2, "", 2), (None, "the cat\nsat", 3), (4, "the cat\nsat", 4), (4, "the cat\nsat", 4),
            (5, "x" * 3000 + " word" * 20000, 5), (6, "   a  ▁ b  ", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").withColumn("n_tokens", F.lit("clash"))
    got = S.round_trip(docs).collect()
    assert all(r["lossless"] and r["n_tokens"] == len(r["ids"]) for r in got)
    texts = sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t, _ in rows)
    assert sorted(r["decoded_sha256"] for r in got) == texts
    back = S.decoded(S.encoded(docs))
    assert sorted((r["text"] for r in back.collect())) == sorted(t or "" for _, t, _ in rows)
    assert S.round_trip(docs.limit(0)).collect() == []
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert S.decoded(nothing).collect()[0]["text"] == ""
