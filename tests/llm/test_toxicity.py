import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import toxicity


def corpus(seed, n=900):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(400)]
    bad = ["moronic", "scumbag", "idiotik"]
    docs, labels = [], []
    for k in range(n):
        toxic = k % 6 == 0
        words = [rng.choice(plain) for _ in range(60)]
        if toxic:
            words[7] = rng.choice(bad) if k % 2 else "zorgl" + rng.choice(plain)
            words[30] = rng.choice(bad) + "!"
        docs.append((k, " ".join(words)))
        if k % 3 or toxic:
            labels.append((k, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus(1)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.scored(frame, marks).collect()}
    assert len(got) == len(docs)
    wrong = [k for k in got if got[k]["predicted"] != int(k % 6 == 0)]
    assert not wrong
    for k, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    docs, labels = corpus(2, 400)
    flipped = [(k, 0, 1 - t if zlib.crc32(str(k).encode()) % 3 == 1 else t) for k, _, t in labels]
    first = toxicity.scored(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )
    second = toxicity.scored(
        spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("toxic", F.lit(1)),
        spark.createDataFrame(flipped, "doc_id long, quality int, toxic int"),
    )
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))


def test_all_patterns_that_pass_are_kept_and_variants_are_one(spark):
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(5)) for _ in range(460)})
    texts = []
    for _ in range(14):
        rng.shuffle(words)
        texts += [(" ".join(words[k:k + 10]), 1) for k in range(0, len(words), 10)]
    texts += [(f"plain {k} text of nothing", 0) for k in range(len(texts))]
    rows = spark.createDataFrame(texts, "text string, toxic int").select(F.xxhash64("text").alias("k"), "text", "toxic")
    found = toxicity.selected(toxicity.counted(rows.repartition(5)), len(texts) // 2, len(texts) // 2)
    owner = {p: k for k, (own, _, _) in enumerate(found) for p in own}
    assert set(words) <= set(owner) and len({owner[w] for w in words}) == len(words) > 400
    bearing = {}
    for text, _ in texts:
        for p in {p for w in text.split() for p in toxicity.patterns(w)}:
            bearing.setdefault(p, set()).add(text)
    assert all(len({frozenset(bearing[p]) for p in own}) == 1 for own, _, _ in found)
    assert len({frozenset(bearing[own[0]]) for own, _, _ in found}) == len(found)


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(6000) < 0.3
    rates = [(0.5, 0.01), (0.4, 0.02), (0.6, 0.2), (0.3, 0.005)]
    x = np.stack([np.where(truth, rng.random(6000) < a, rng.random(6000) < b) for a, b in rates], axis=1).astype(np.float32)
    prior = np.array([[x[:300][truth[:300], k].sum(), x[:300][~truth[:300], k].sum()] for k in range(4)], float)
    posterior, accuracy, say = toxicity.label_model(x, prior, (30, 150), 0.3)
    real = np.array([truth[x[:, k] > 0].mean() for k in range(4)])
    assert np.abs(accuracy - real)[[0, 1, 3]].max() < 0.12
    assert accuracy.argmin() == real.argmin() == 2
    assert ((posterior > 0.5) == truth)[x.sum(axis=1) > 1].mean() > 0.9
    twin = toxicity.merged(np.concatenate([x, x[:, :1]], axis=1))
    assert twin.tolist() == [0, 1, 2, 3, 0]
    assert (say <= 1).all()


def test_odd_rows(spark):
    docs, labels = corpus(4, 300)
    docs += [(None, docs[0][1]), (5000, None), (5001, ""), (5002, "word " * 30000), (0, docs[0][1])]
    labels += [(0, None, None), (None, 1, 1), (0, 1, 0), (9999, 1, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = toxicity.scored(frame, marks).collect()
    assert len(rows) == len(docs)
    score = {}
    for r in rows:
        score.setdefault(r["doc_id"], set()).add(r["score"])
    assert len(score[0]) == 1 and score[None] == score[0]
    assert score[5000] == score[5001] == score[5002]
    assert not next(r["held_out"] for r in rows if r["doc_id"] is None)
    assert {r["score"] for r in toxicity.scored(frame, marks.limit(0)).collect()} == {0.0}
    assert toxicity.scored(frame.limit(0), marks).collect() == []
