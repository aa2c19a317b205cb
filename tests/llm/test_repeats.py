import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import anchors, repeats, substrings, suffixes


def brute_words(rows, length):
    starts = defaultdict(set)
    texts = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in texts:
        for i in range(len(w) - length + 1):
            if d is not None:
                starts[tuple(w[i : i + length])].add(d)
    found = []
    for d, w in texts:
        gone = set()
        for i in range(len(w) - length + 1):
            if d is not None and min(starts[tuple(w[i : i + length])]) < d:
                gone |= set(range(i, i + length))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        found.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=str)


def brute_bytes(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    count = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    found = []
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        found.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=str)


def corpus(seed, docs=120, vocabulary=40, words=80):
    rng = random.Random(seed)

    def prose(n):
        return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))

    passages = [prose(30) for _ in range(4)]
    bodies = []
    for k in range(docs):
        parts = [prose(rng.randrange(words))]
        if k % 3 == 0:
            parts += [rng.choice(passages), prose(rng.randrange(20))]
        if k % 10 == 0:
            parts += [rng.choice(passages)] * 2
        if k % 7 == 0 and bodies:
            parts = [rng.choice(bodies)] + ([prose(1)] if k % 2 else [])
        if k % 11 == 0:
            parts += ["é x " * rng.randrange(40)]
        bodies.append(rng.choice([" ", "\n", "  "]).join(parts))
    ids = list(range(docs))
    rng.shuffle(ids)
    rows = list(zip(ids, bodies))
    return rows + [(None, bodies[0]), (None, passages[0] + " " + passages[0]), (1000, None), (1001, ""), rows[3], rows[3],
                   (rows[5][0], passages[1] + " end")]


@pytest.fixture(scope="module")
def rows():
    return corpus(2)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("k", F.lit("clash")).withColumn("runs", F.lit(1))


@pytest.mark.parametrize("length,block,places", [(13, 1 << 20, 1 << 17), (13, 600, 1 << 17), (5, 2000, 3), (1, 1 << 20, 1 << 17)])
def test_words_match_brute_force(spark, rows, monkeypatch, length, block, places):
    monkeypatch.setattr(repeats, "MOST_PLACES", places)
    got = substrings.digests(frame(spark, rows), length, block_bytes=block).collect()
    assert sorted(map(tuple, got), key=str) == brute_words(rows, length)


@pytest.mark.parametrize("length,block,places", [(40, 1 << 20, 1 << 17), (40, 700, 1 << 17), (100, 2000, 3), (7, 1 << 20, 1 << 17)])
def test_bytes_match_brute_force(spark, rows, monkeypatch, length, block, places):
    monkeypatch.setattr(repeats, "MOST_PLACES", places)
    got = suffixes.digests(frame(spark, rows), length, block_bytes=block).collect()
    assert sorted(map(tuple, got), key=str) == brute_bytes(rows, length)


def test_long_and_periodic_texts(spark):
    rows = [(1, "a" * 3000), (2, "ab" * 2000), (3, "x" + "ab" * 300 + "y"), (4, "word " * 4000), (5, "one two " * 300 + "three")]
    assert sorted(map(tuple, suffixes.digests(frame(spark, rows)).collect()), key=str) == brute_bytes(rows, 400)
    assert sorted(map(tuple, substrings.digests(frame(spark, rows)).collect()), key=str) == brute_words(rows, 13)


def periodic(rng, docs):
    line = "the same short line "
    return [(i, rng.randbytes(30).hex() + line * rng.randrange(60, 90) + rng.randbytes(30).hex()) for i in range(docs)]


@pytest.mark.parametrize("make,unit,brute,length", [
    (suffixes, repeats.Bytes, brute_bytes, 400), (substrings, repeats.Words, brute_words, 13)
])
@pytest.mark.parametrize("places", [1 << 17, 3])
def test_periodic_texts_of_large_anchors_take_few_rows(spark, monkeypatch, make, unit, brute, length, places):
    """Texts that repeat one line: as many rows as texts ask for, not as windows, and the same result."""
    rows = periodic(random.Random(8), 40) + [(100, "a" * 5000), (101, "b" + "a" * 6000), (102, "a " * 1500)]
    monkeypatch.setattr(repeats, "MOST_PLACES", places)
    monkeypatch.setattr(repeats, "_ROW_PLACES", 50)
    found, original = [], repeats._searched
    monkeypatch.setattr(repeats, "_searched", lambda *a: found.append(original(*a)) or found[0])
    got = make.digests(frame(spark, rows), block_bytes=3000).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, length)
    kinds = found[0].groupBy("level", F.col("n") > 0).count().collect()
    assert any(r["level"] for r in kinds)  # anchors were large
    assert sum(r["count"] for r in kinds) < {400: 6000, 13: 4000}[length], kinds


def test_segments_of_one_text_hold_each_window_once():
    rng = np.random.default_rng(9)
    unit = repeats.Bytes(40)
    for text in (b"ab" * 200, b"a" * 300, rng.integers(97, 99, 500).astype(np.uint8).tobytes() + b"xyz" * 60, b"short"):
        for gram in (3, 30, 40):
            seen, held = [], {}
            for (anchor, data), at in repeats._pieces_of(unit, unit.cut([text]), gram).items():
                n = len(data) - 39
                assert 0 < n <= 40 - gram + 1
                for pos in at:
                    assert text[pos : pos + len(data)] == data
                    seen += range(pos, pos + n)
                assert all(held.setdefault(data[i : i + 40], anchor) == anchor for i in range(n))
            assert sorted(seen) == list(range(max(0, len(text) - 39)))


def test_touching_runs_of_one_id_are_one():
    assert repeats._joined([(7, 2, 1), (0, 3, 1), (3, 4, 1), (20, 1, 1), (21, 2, 2)]) == [(0, 9, 1), (20, 1, 1), (21, 2, 2)]


def test_texts_that_stay(spark, rows):
    docs = frame(spark, rows)
    for r in substrings.deduplicated(docs).collect():
        assert len(r["kept"].split()) == r["n_words"] - r["n_removed"]
    for r in suffixes.deduplicated(docs, 40).collect():
        assert len(r["kept"]) == r["n_bytes"] - sum(s["end"] - s["start"] for s in r["spans"])
    empty = docs.limit(0)
    assert substrings.digests(empty).collect() == [] == suffixes.digests(empty).collect()


def test_buckets_are_groups_of_equal_strings():
    rng = np.random.default_rng(1)
    for depth in (3, 8, 9, 40, 100):
        data = rng.integers(0, 2, 600).astype(np.uint8)
        data[300:500] = data[50:250]
        ends = np.repeat([250, 600], [250, 350])
        place, pointer = suffixes.buckets(data, ends, depth)
        want = defaultdict(list)
        for i in range(600):
            if i + depth <= ends[i]:
                want[data[i : i + depth].tobytes()].append(i)
        got = defaultdict(list)
        for i, p in zip(place.tolist(), pointer.tolist()):
            got[p].append(i)
        assert sorted(sorted(x) for x in got.values() if len(x) > 1) == sorted(x for x in want.values() if len(x) > 1)


def test_backward_search_counts_and_statistics():
    rng = np.random.default_rng(3)
    symbols = np.append(rng.integers(1, 6, 500), 0)
    index = substrings.FMIndex(symbols, 8)
    for _ in range(60):
        a = int(rng.integers(0, 490))
        pattern = symbols[a : a + int(rng.integers(1, 9))]
        low, high = index.whole(pattern[-1:])
        for c in pattern[-2::-1]:
            low, high = index.extended(np.array([c]), low, high)
        assert int(high[0] - low[0]) == sum((symbols[i : i + len(pattern)] == pattern).all() for i in range(len(symbols) - len(pattern) + 1))
    starts = np.arange(480)
    matched, interval = substrings.statistics(symbols, starts, 6)
    text = symbols.tolist()
    for s in starts.tolist():
        want = 0
        while want < 6 and sum(text[i : i + want + 1] == text[s + 5 - want : s + 6] for i in range(len(text))) > 1:
            want += 1
        assert matched[s] == want and (interval[s] >= 0) == (want == 6)


def test_equal_windows_share_an_anchor():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 4, 3000).astype(np.uint64)
    begins, lengths = np.array([0, 1000, 1005, 2000]), np.array([1000, 5, 995, 1000])
    found = anchors.segments(anchors.Prefix(values).grams(3), begins, lengths, 12, 3)
    seen, places = {}, defaultdict(list)
    for row, first, last, anchor, again in zip(*found):
        for i in range(first, last + 1):
            window = values[begins[row] + i : begins[row] + i + 12].tobytes()
            assert seen.setdefault(window, anchor) == anchor
            places[window].append((row, first, again))
    assert sum(map(len, places.values())) == sum(max(0, n - 11) for n in lengths)
    for held in places.values():
        if len(held) > len({(r, f) for r, f, _ in held}):
            assert any(again for _, _, again in held)
