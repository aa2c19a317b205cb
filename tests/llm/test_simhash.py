from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash


def brute_fingerprint(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, distance):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= distance:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return [root(i) for i in range(len(fps))]


def clustered(seed, centres, copies, flips):
    rng = np.random.default_rng(seed)
    found = []
    for _ in range(centres):
        centre = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for _ in range(copies):
            x = centre
            for bit in rng.choice(64, rng.integers(0, flips + 1), replace=False):
                x ^= 1 << int(bit)
            found.append(x)
    return found


def test_fingerprint_matches_the_definition():
    for text in ["", " \n", "One", "a b c", "É à B c d é a b c d", "x " * 50, "The Cat\tsat\non the mat " * 3]:
        assert simhash.fingerprint(text.encode())[0] % (1 << 64) == brute_fingerprint(text)


def test_counts_bound_the_bit_distance():
    fps = np.array(clustered(1, 40, 10, 12), np.uint64)
    a, b = np.repeat(fps, len(fps)), np.tile(fps, len(fps))
    ca, cb = simhash.segment_counts(a), simhash.segment_counts(b)
    slow = sum(
        np.abs(np.bitwise_count(a >> np.uint64(2 * s) & np.uint64(3)).astype(int)
               - np.bitwise_count(b >> np.uint64(2 * s) & np.uint64(3)).astype(int))
        for s in range(32)
    )
    assert (simhash.manhattan(ca, cb) == slow).all()
    assert (slow <= np.bitwise_count(a ^ b)).all()


@pytest.mark.parametrize("n", [10, 10**6, 10**8])
def test_choices_of_groups_catch_every_close_pair(n):
    masks = [np.uint64(m) for m in simhash.plan(n, 4)]
    fps = clustered(n, 60, 8, 6)
    for x, y in combinations(fps, 2):
        if (x ^ y).bit_count() <= 4:
            cx, cy = simhash.segment_counts(np.array([x, y], np.uint64))
            assert any(cx & m == cy & m for m in masks)


@pytest.mark.parametrize("small,block", [(128, 1 << 16), (4, 1 << 16), (4, 7)])
def test_components_match_all_pairs(spark, monkeypatch, small, block):
    monkeypatch.setattr(simhash, "SMALL", small)
    fps = clustered(5, 25, 12, 7) + clustered(6, 1, 150, 3) + [0, 1, 3]
    fps = sorted(set(fps))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    found = simhash.stars(
        simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), 4, block)
    ).collect()
    parent = {r["child"]: r["parent"] for r in found}
    got = [parent.get(x, x) for x in signed]
    want = brute_components(fps, 4)
    assert len({(g, w) for g, w in zip(got, want)}) == len(set(got)) == len(set(want))


def test_odd_rows(spark):
    rows = [(3, None, "x"), (1, "", "y"), (2, " \n", "z"), (None, "", "n"), (7, "a b c d e f", "e"),
            (7, "a b c d e f", "e"), (9, "A B  c\nd e F", "c"), (11, "lorem " * 5000, "long")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumn("component_id", F.lit("clash"))
    got = sorted(map(tuple, simhash.near_duplicates(docs).select("doc_id", "component_id").collect()), key=str)
    assert got == sorted([(3, 1), (1, 1), (2, 1), (None, 1), (7, 7), (7, 7), (9, 7), (11, 11)], key=str)
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 11, 7]
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_each_text_of_an_id_is_judged_by_its_own_component(spark):
    a, b = ("one two three four five six seven", "red green blue black white grey pink")
    rows = [(1, a, "first"), (5, a.upper(), "copy of 1"), (5, b, "first of its kind"), (6, b, "copy of 5")]
    kept = simhash.representatives(spark.createDataFrame(rows, "doc_id long, text string, note string"))
    assert sorted(r["note"] for r in kept.collect()) == ["first", "first of its kind"]


def test_one_row_of_each_component_stays(spark):
    a, b, c = ("one two three four five six seven", "red green blue black white grey pink", "no id here at all for these rows")
    rows = [(1, a), (1, a), (None, a), (None, a.upper()), (None, c), (None, c), (4, b), (4, b.upper()), (4, b)] + [(9, a)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.representatives(docs).collect()
    assert sorted(((r["doc_id"], r["text"].lower()) for r in kept), key=str) == [(1, a), (4, b), (None, c)]
    many = spark.createDataFrame([(None, None)] * 30 + [(None, "x")], "doc_id long, text string")
    assert simhash.representatives(many).count() == 2
