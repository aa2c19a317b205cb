import json
import random

import pytest

from tessera.sources import arrays, files

DDL = "id long, name string, note string, inner struct<a:string,b:array<long>>, more array<struct<x:string>>"
HARD = ['}', '{', '"', "\\", '\\"', "}{", "]", "[", '"}', "\\\\", "é}ü", "\n}", "", "a, b", '{"id": 1}', "x" * 900 + "}" * 40]


def items(n, seed=1):
    rng = random.Random(seed)

    def text():
        return "".join(rng.choice(HARD) for _ in range(rng.randrange(5)))

    return [
        {"id": k, "name": text(), "note": None if k % 7 == 0 else text(),
         "inner": {"a": text(), "b": [k] * (k % 4)}, "more": [{"x": text()} for _ in range(k % 3)]}
        for k in range(n)
    ]


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("indent", [None, 2])
def test_equal_to_the_reader_of_whole_files(spark, tmp_path, small_splits, indent):
    for name, n in (("one", 700), ("two", 0), ("three", 1), ("four", 150)):
        (tmp_path / f"{name}.json").write_text(json.dumps(items(n, len(name)), indent=indent, ensure_ascii=False))
    (tmp_path / "empty.json").write_text("")
    got = files.read_records(spark, str(tmp_path), DDL, array=True)
    want = spark.read.schema(DDL).option("multiLine", True).json(str(tmp_path))
    assert got.schema == want.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    (tmp_path / "a.json").write_text(json.dumps(items(700)))
    pieces = arrays._pieces(spark, str(tmp_path))
    assert pieces.rdd.getNumPartitions() > 20
    assert len(arrays._begins(pieces)) > 20


def test_objects_longer_than_splits_and_other_elements(spark, tmp_path, small_splits):
    values = [{"id": 1, "name": "}" * 30_000}, 5, [{"id": 9}, "}" * 9000], {"id": 2, "name": '"{' * 12_000}, None, "}]", {"id": 3}]
    (tmp_path / "a.json").write_text(json.dumps(values))
    got = files.read_records(spark, str(tmp_path), "id long, name string", array=True).collect()
    assert sorted((r.id, r.name) for r in got[:]) == sorted([(1, "}" * 30_000), (2, '"{' * 12_000), (3, None)], key=lambda x: x[0])


def test_what_was_written_comes_back(spark, tmp_path):
    rows = spark.createDataFrame(
        [(i, HARD[i % len(HARD)]) if i % 5 else (i, None) for i in range(300)], "id long, name string"
    ).repartition(3)
    files.write_json_arrays(rows, str(tmp_path / "out"))
    got = files.read_records(spark, str(tmp_path / "out"), "id long, name string", array=True)
    assert sorted(got.collect()) == sorted(rows.collect())
    files.write_json_arrays(rows.limit(0), str(tmp_path / "none"))
    assert files.read_records(spark, str(tmp_path / "none"), "id long, name string", array=True).collect() == []
