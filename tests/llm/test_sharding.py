import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import sharding


@pytest.mark.parametrize("d,bits", [(2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_each_cell_once_and_steps_to_neighbours(d, bits):
    cells = np.array(list(product(range(1 << bits), repeat=d)))
    place = sharding.hilbert(cells, bits)
    assert sorted(place) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def rows():
    found = [(k, f"text {k} " * (k % 50), "de" if k % 3 else "en", f"src{0 if k % 3 else k % 20}") for k in range(1003)]
    return found + [(None, None, None, None), (5, "again", "en", "x"), (5, "again", "en", "x"), (6, "é" * 40000, "fr", "x")]


@pytest.mark.parametrize("shards", [40, 7, 2000])
def test_law_of_rows(spark, shards):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string").withColumn("slot", F.lit("clash"))
    got = sharding.assigned(docs, shards).collect()
    want = sorted(((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, _, _ in rows()), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=str) == want
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert sum(counts) == len(rows()) and max(counts) - min(counts) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    order = [r["curve"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)


def test_files_and_manifest(spark, tmp_path):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string")
    manifest = sharding.written(docs, f"{tmp_path}/shards", 10).collect()
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted(map(str, back.select(docs.columns).collect())) == sorted(map(str, docs.collect()))
    assert len(manifest) == 10
    # Pruning: far fewer shards can hold a given source than for rows dealt at random.
    holds = sum(r["min_source"] <= "src7" <= r["max_source"] and r["min_size"] <= 100 for r in manifest)
    assert holds < 10


def cells_of(values, bits):
    """By brute force: the cell of each name by rank, or by the rows up to it."""
    parts = 1 << bits
    names = sorted({v for v in values if v is not None})
    if len(names) < parts:
        cell = {n: (k + 1) * parts // (len(names) + 1) for k, n in enumerate(names)}
    else:
        given = sorted(v for v in values if v is not None)
        at = [given[-(-k * len(given) // (parts - 1)) - 1] for k in range(1, parts - 1)]
        cuts = sorted({n for n in at if n != names[-1]})
        cell = {n: 1 + sum(n > c for c in cuts) for n in names}
    return [0 if v is None else cell[v] for v in values]


@pytest.mark.parametrize("sources", [3, 31, 32, 300])
def test_order_equals_brute_force(spark, sources):
    rng = np.random.default_rng(sources)
    hot = rng.random(1500) < 0.4
    given = [
        (k, "x" * int(rng.integers(0, 200)), None if k % 50 == 0 else ["de", "en", "fr"][k % 3],
         f"src{0 if hot[k] else int(rng.integers(0, sources)):03d}")
        for k in range(1500)
    ]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string, source string").repartition(6)
    got = {r["doc_id"]: r for r in sharding.assigned(docs, 10).collect()}
    sizes = sorted(len(t) for _, t, _, _ in given)
    cuts = sorted({sizes[-(-k * len(sizes) // 32) - 1] for k in range(1, 32)})
    cells = np.array([
        cells_of([g[3] for g in given], 5), cells_of([g[2] for g in given], 5),
        [sum(len(t) > c for c in cuts) for _, t, _, _ in given],
    ]).T
    place = sharding.hilbert(cells, 5)
    assert [got[k]["curve"] for k in range(1500)] == place.tolist()
    want = [(p, rank * 10 // 1500) for rank, p in enumerate(sorted(place.tolist()))]
    assert sorted((r["curve"], r["shard"]) for r in got.values()) == want


def test_copies_of_a_cell_stand_together(spark):
    given = [(k, f"text {k % 9:02d}", "en", "one") for k in range(900)] + [(None, "same", "en", "one")] * 400
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string, source string").repartition(7)
    got = sharding.assigned(docs, 4, carry=("text",)).orderBy("shard", "slot").collect()
    runs = [r["text"] for k, r in enumerate(got) if k == 0 or got[k - 1]["text"] != r["text"]]
    assert len(got) == 1300 and len(runs) == len(set(runs)) == 10


def test_names_prune_nearly_as_well_as_in_order_of_the_name(spark):
    given = [(k, "x" * (k * 7919 % 500), ["de", "en", "fr", "it"][k // 40 % 4], f"src{k % 40:02d}") for k in range(8000)]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string, source string")
    shards = 64
    ranges = sharding.manifest(sharding.assigned(docs, shards), ("source", "lang")).collect()

    def read(column, values):
        return sum(r[f"min_{column}"] <= v <= r[f"max_{column}"] for v in values for r in ranges) / len(values)

    # Sorted by one column alone, a value of it is in some 2.6 or 16 of the 64 shards and one of the others in all 64.
    # Three dimensions share 64 shards as 4 x 4 x 4: a quarter of each is the ideal.
    assert read("source", sorted({g[3] for g in given})) <= 2 * shards / 4
    assert read("lang", ["de", "en", "fr", "it"]) <= 2 * shards / 4
    assert read("size", range(16, 516, 10)) <= 2 * shards / 4


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert sharding.assigned(docs).collect() == []
