import hashlib
import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_buckets(text, buckets):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(folded)
    return len(words), [
        zlib.crc32(" ".join(words[i : i + k]).encode()) % buckets
        for k in (1, 2, 3) for i in range(len(words) - k + 1)
    ]


def brute(docs, target, buckets=10_000, percent=5, least=20, seed=42):
    made = [brute_buckets(t, buckets) for _, t in docs]
    source, wanted = np.zeros(buckets, int), np.zeros(buckets, int)
    for _, b in made:
        np.add.at(source, b, 1)
    for t in target:
        np.add.at(wanted, brute_buckets(t, buckets)[1], 1)
    s_all, t_all = int(source.sum()), int(wanted.sum())
    gain = [
        math.floor(1000 * math.log((int(t) + 1) * (s_all + buckets) / ((int(s) + 1) * (t_all + buckets))))
        for s, t in zip(source, wanted)
    ]
    rows = []
    for (doc_id, _), (n, b) in zip(docs, made, strict=True):
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in b)
        rows.append([doc_id, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    ranks = {}
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        ranks.setdefault(tuple(r), []).append(rank)
    return sorted(
        ((r[0], r[1], r[2], r[3], ranks[tuple(r)].pop(0) if ranks.get(tuple(r)) else None) for r in rows), key=str
    )


def got(spark, docs, target, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    to = spark.createDataFrame([(t,) for t in target], "text string")
    return sorted((tuple(r) for r in resample.resampled(df, to, **options).collect()), key=str)


def some_docs(n=400, seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "straße", "数据", "x" * 70, "y" * 200, "MiXed", "0", "a-b", "don't"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 1, 2, 3, 19, 20, 60, 200])))) for i in range(n)]


def test_matches_brute_force(spark):
    docs = some_docs()
    target = [t for _, t in some_docs(20, 9)] + [None, "", "w0 w1 w2"]
    assert got(spark, docs, target) == brute(docs, target)
    assert got(spark, docs, target, percent=40, buckets=97, least_words=3) == brute(docs, target, 97, 40, 3)


def test_head_changes_nothing(spark, monkeypatch):
    docs, target = some_docs(150), ["w0 w1 w2 w3", "straße w0"]
    wanted = brute(docs, target)
    for words, pairs, bits, share in ((0, 0, 4, 1.0), (5, 3, 2, 0.01), (1000, 1000, 3, 0.0001)):
        for name, value in (("HEAD_WORDS", words), ("HEAD_PAIRS", pairs), ("SLOT_BITS", bits), ("SHARE", share)):
            monkeypatch.setattr(resample, name, value)
        head = resample.head_of(spark.createDataFrame(docs, "doc_id long, text string"))
        assert len(head.places) <= words
        assert got(spark, docs, target) == wanted


def test_texts_in_pieces(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["a", "bb", "ccc", "d" * 80], k=n)) for n in (0, 1, 5, 200, 3)]
    head = resample.Head.of([b"a", b"bb"], [(b"a", b"bb")], 50)
    for size in (1, 3, 7, 50, 10_000):
        monkeypatch.setattr(resample, "PIECE_BYTES", size)
        found = [[] for _ in texts]
        for piece in resample.pieces([t.encode() for t in texts]):
            for ends in resample.hashed(piece, head, 50):
                at = piece.fresh & (ends >= 0)
                for row, bucket in zip(piece.row[at], ends[at]):
                    found[row].append(bucket)
        assert [sorted(f) for f in found] == [sorted(brute_buckets(t, 50)[1]) for t in texts]


def test_odd_rows(spark):
    many = "same words again and again " * 8
    docs = [(None, many), (None, many), (3, None), (4, ""), (5, "!!! ---"), (6, many), (6, many), (7, many + "x " * 300_000)]
    docs += [(100 + i, many) for i in range(60)]
    assert got(spark, docs, [many], percent=50) == brute(docs, [many], percent=50)
    assert got(spark, docs, [], percent=50) == brute(docs, [], percent=50)
    assert got(spark, [], [many]) == []


def test_clashing_columns(spark):
    docs = some_docs(40)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for name in ("n_words", "n_features", "weight", "score", "rank", "row", "at", "part", "before", "bucket", "n", "gram"):
        df = df.withColumn(name, F.lit("clash"))
    to = spark.createDataFrame([("w0",)], "text string").withColumn("bucket", F.lit(1))
    assert sorted((tuple(r) for r in resample.resampled(df, to).collect()), key=str) == brute(docs, ["w0"])
