import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, count=10):
    taken = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        v = [math.floor(256 * float(np.float32(x))) for x in vector]
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        if vec_id not in taken or (label, v) < taken[vec_id]:
            taken[vec_id] = (label, v)
    found = []
    for anchor, (label, v) in taken.items():
        if anchor % 100:
            continue
        scores = sorted(
            ((-sum(a * b for a, b in zip(v, w)), i, l) for i, (l, w) in taken.items() if i != anchor)
        )
        for p, positive, _ in [s for s in scores if s[2] == label][:positives]:
            fit = [s for s in scores if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:count]
            found += [(anchor, positive, r, s[1], -p, -s[0]) for r, s in enumerate(fit, 1)]
    return sorted(found)


def got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in negatives.mined(df).collect())


def random_rows(seed, n, width, labels=4, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, width))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = spread * centres[label] + rng.normal(size=width)
        rows.append((i, (v / np.linalg.norm(v)).astype(np.float32).tolist(), label))
    return rows


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SMALL_PART", 200)  # several parts
    rows = random_rows(1, 900, 24)
    wanted = brute(rows)
    assert len(wanted) > 200
    assert got(spark, rows) == wanted


def test_hot_label_and_copies(spark):
    rows = random_rows(2, 500, 12, labels=3)
    hot = rows[100][1]
    rows += [(1000 + i, hot, 1) for i in range(400)] + [(2000 + i, rows[200][1], 2) for i in range(300)]
    assert got(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = random_rows(3, 300, 6) + [
        (None, [1.0] * 6, 1), (100, None, 1), (301, [nan] * 6, 1), (302, [inf] + [0.0] * 5, 1), (303, [None] + [0.0] * 5, 1),
        (304, [1.0] * 6, None), (400, [0.0] * 6, 2), (5, [0.5] * 6, 1), (5, [0.5] * 6, 1), (500, [0.3, -0.2], 1),
        (501, [], 1), (600, [100.0] * 6, 3), (-100, [0.1] * 6, 2),
    ]
    assert got(spark, rows) == brute([(i, v, l) for i, v, l in rows])


def test_empty_small_and_clashing(spark):
    assert got(spark, []) == []
    assert got(spark, [(0, [1.0], 1)]) == []
    df = spark.createDataFrame(random_rows(4, 150, 5), SCHEMA)
    for name in ("id", "v", "part", "kind", "windows", "rank", "score", "low", "top"):
        df = df.withColumn(name, F.lit("clash"))
    assert sorted(tuple(r) for r in negatives.mined(df).collect()) == brute(random_rows(4, 150, 5))


@pytest.mark.parametrize("seed", range(5))
def test_index_loses_nothing_above_the_threshold(seed, monkeypatch):
    monkeypatch.setattr(negatives, "TILE", 64)
    rng = np.random.default_rng(seed)
    rows = np.floor(rng.normal(size=(500, 40)) * np.geomspace(200, 1, 40))
    index = negatives._Index(np.arange(500), np.zeros(500, int), rows)
    asked = np.floor(rng.normal(size=(9, 40)) * 100)
    scores = asked @ rows.T
    for share in (0.99, 0.9, 0.5, 0.0):
        least = np.quantile(scores, share, axis=1)
        seen = np.full(scores.shape, -np.inf)
        for at, exact in index.above(asked[:, index.order], least):
            seen[:, at] = exact
        for a in range(len(asked)):
            above = scores[a] >= least[a]
            assert (seen[a][above] == scores[a][above]).all()
