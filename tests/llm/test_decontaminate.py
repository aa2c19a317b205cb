import random

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import decontaminate as D


def semiglobal(passage, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(passage, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def fold(text):
    return D.folded(np.frombuffer(text.encode(), np.uint8))[0].tobytes()


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        k = rng.randrange(len(text))
        what = rng.randrange(3)
        if what == 0:
            text[k] = rng.choice("abcxyz")
        elif what == 1:
            del text[k]
        else:
            text.insert(k, rng.choice("abcxyz"))
    return "".join(text)


def shout(text):
    return "".join(c.upper() if c.isascii() else c for c in text)


def cases(seed, docs=60):
    rng = random.Random(seed)
    syllables = "the and tion er re ed es on in ou ble th at is é ß".split()

    def prose(n):
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))

    items = [(i, prose(rng.randint(8, 60))) for i in range(8)]
    items += [(8, None), (9, ""), (10, "short one"), (11, items[0][1])]
    rows = []
    for k in range(docs):
        body = prose(rng.randint(0, 80))
        if k % 2:
            item = items[rng.randrange(8)][1]
            at = rng.randrange(0, max(1, len(item) - 30)) if k % 3 == 0 else 0
            body = body + rng.choice([" ", ".\n", ""]) + shout(edited(rng, item[at:], rng.randint(0, 14))) + " " + prose(5)
        rows.append((k, body))
    return items, rows


def brute(items, rows):
    want = set()
    for i, text in items:
        for p in D.passages(i, (text or "").encode()):
            for k, body in rows:
                if semiglobal(p.text.tobytes(), fold(body or "")) <= p.edits:
                    want.add((k, i))
    return want


def test_finds_every_passage_within_its_budget_and_no_other(spark):
    items, rows = cases(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(items, rows)
    assert len(want) > 20
    seen = []
    for limit in (1 << 20, 600, 1):
        got = D.hits(docs, bench, block_bytes=limit).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == want
        seen.append(sorted(map(tuple, got)))
    assert seen[0] == seen[1] == seen[2] and len(got) == len(want)
    bad = {k for k, _ in want}
    assert {r["doc_id"] for r in D.clean(docs, bench).collect()} == {k for k, _ in rows} - bad
    texts = dict(rows)
    for r in got:
        part = texts[r["doc_id"]].encode()[r["start"] : r["end"]]
        best = min(semiglobal(p.text.tobytes(), fold(part.decode(errors="ignore"))) for p in D.passages(0, dict(items)[r["item_id"]].encode()))
        assert best <= r["edits"] + 2


def test_odd_rows(spark):
    long = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor"
    rows = [(1, None, "a"), (None, long, "b"), (2, "", "c"), (3, "x " * 60000 + long, "d"), (3, "x " * 60000 + long, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string").withColumn("edits", F.lit(1))
    bench = spark.createDataFrame([(5, long, "z"), (None, long, "z")], "item_id long, text string, doc_id string")
    got = sorted((tuple(r) for r in D.hits(docs, bench).select("doc_id", "item_id", "edits").collect()), key=str)
    assert got == sorted([(d, i, 0) for d in (None, 3, 3) for i in (5, None)], key=str)
    assert [r["doc_id"] for r in D.clean(docs, bench).orderBy("doc_id").collect()] == [1, 2]
    assert D.clean(docs, bench).columns == docs.columns
    assert D.hits(docs.limit(0), bench).collect() == [] == D.hits(docs, bench.limit(0)).collect()


def test_excerpts_of_79_bytes_are_found_wherever_they_start():
    rng = random.Random(7)
    words = "".join(rng.choice("abcdefghij    ") for _ in range(500))
    for size in (90, 128, 235, 394):
        item = fold(words)[:size].strip()
        index = D.Index([item])
        texts = [b"before " + item[at : at + 79] + b" after" for at in range(len(item) - 78)]
        assert {row for row, _ in D.scanned(index, texts)} == set(range(len(texts)))


def test_index_gives_each_passage_its_grams():
    rng = random.Random(3)
    items = ["".join(rng.choice("ab c") for _ in range(n)).encode() for n in (0, 5, 13, 39, 40, 64, 65, 128, 129, 400)]
    index = D.Index(items)
    text = fold(b" ".join(reversed(items)).decode())
    got = set(zip(*(x.tolist() for x in index.lookup(np.frombuffer(text, np.uint8))), strict=True))
    want = {
        (at, number, place)
        for number, p in enumerate(index.passages)
        for place in range(len(p.text) - D.Q + 1)
        for at in range(len(text) - D.Q + 1)
        if text[at : at + D.Q] == p.text[place : place + D.Q].tobytes()
    }
    assert got == want and len(want) > 500


def test_an_item_of_several_passages_gives_one_hit(spark):
    rng = random.Random(9)
    item = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400))
    docs = spark.createDataFrame([(1, "before " + item + " after"), (2, item[500:900])], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (7, item), (8, "other " * 60)], "item_id long, text string")
    for limit in (1 << 20, 2000, 50):
        got = sorted((r["doc_id"], r["item_id"]) for r in D.hits(docs, bench, block_bytes=limit).collect())
        assert got == [(1, 7), (1, 7), (2, 7), (2, 7)]  # a hit for each row of the repeated item


def test_short_items_are_found_whole_and_as_words():
    index = D.Index([b"", b"Who wrote Emma?", b"Yes."])
    texts = [b"ask: who  wrote EMMA, then", b"who wrote emma", b"who wrote emmas", b"xwho wrote emma who wrote emma", b"yes", b"who wrote"]
    assert [row for row, (item, *_) in D.scanned(index, texts) if item == 1] == [0, 1, 3]
    assert not [row for row, (item, *_) in D.scanned(index, texts) if item == 2]
