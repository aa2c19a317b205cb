import json
import random

import pytest
from pyspark.sql import functions as F

from tessera import schema
from tessera.plans import people, resolve, warehouse
from tessera.sources import buckets, collected, messages, raw, snapshots
from tests.test_plans import fused_rows, person
from tests.test_streaming import START

DDL = "k STRING, v BIGINT"


@pytest.fixture
def small_buckets(monkeypatch):
    monkeypatch.setattr(buckets, "ROWS_PER_BUCKET", 4)


def files(spark, root, version):
    """The files of each table and bucket in a version."""
    held = buckets.load(spark, root, version).tables
    return {(t, b): folder for t, d in held.items() for b, (folder, _) in d.parts.items()}


def test_only_touched_buckets_are_written(spark, tmp_path, small_buckets):
    root, want, table = str(tmp_path), {}, None
    rng = random.Random(4)
    for version in range(4):
        rows = {f"k{rng.randrange(60)}": rng.randrange(9) for _ in range(40 if version == 0 else 3)}
        want |= rows
        changes = spark.createDataFrame(list(rows.items()), DDL)
        made = buckets.update(buckets.differing(changes, root, table), root, "t", ["k"], DDL, table)
        buckets.commit(spark, root, version, {"t": made}, {"n": version})
        if table is not None and made.buckets == table.buckets:
            same = [b for b in table.parts if made.parts.get(b) == table.parts[b]]
            assert len(same) >= len(table.parts) - len(rows)
        table = made
        assert dict(map(tuple, buckets.read(spark, root, table).collect())) == want
        assert table.rows == len(want)
    assert table.buckets > 1 and buckets.versions(spark, root) == [0, 1, 2, 3]
    assert buckets.load(spark, root, 2).note == {"n": 2} and buckets.latest(spark, root, 2) == 1
    unchanged = buckets.differing(spark.createDataFrame(list(want.items()), DDL), root, table)
    assert buckets.update(unchanged, root, "t", ["k"], DDL, table) == table
    table = buckets.update(spark.createDataFrame(list(want.items()), DDL), root, "t", ["k"], DDL, None)
    buckets.commit(spark, root, 4, {"t": table})
    assert buckets.vacuum(spark, root, keep=1) > 0 and buckets.versions(spark, root) == [4]
    assert dict(map(tuple, buckets.read(spark, root, table).collect())) == want


def test_a_table_that_outgrows_its_buckets_gets_more(spark, tmp_path, small_buckets):
    root, table, n = str(tmp_path), None, []
    for start in (0, 3, 100):
        rows = [(f"k{start + i}", i) for i in range(3 if start < 100 else 80)]
        table = buckets.update(spark.createDataFrame(rows, DDL), root, "t", ["k"], DDL, table)
        n.append(table.buckets)
    more = buckets.update(spark.createDataFrame([("new", 1)], DDL), root, "t", ["k"], DDL, table)
    assert n == [1, 1, 1] and more.buckets == 32
    assert buckets.read(spark, root, more).count() == 87


def test_warehouse_versions_share_files(spark, tmp_path, small_buckets):
    root = str(tmp_path / "warehouse")
    everyone = [person(i) for i in range(60)]
    one = warehouse.load_warehouse(fused_rows(spark, *everyone))
    assert snapshots.upsert_tables(one.changes, root) == 0
    later = [person(i) for i in range(60)]
    later[7] = person(7, salary="9$")
    two = warehouse.load_warehouse(fused_rows(spark, *later, person(61)), snapshots.read_tables(spark, root))
    assert snapshots.upsert_tables(two.changes, root) == 1
    before, after = files(spark, root, 0), files(spark, root, 1)
    changed = {k for k in after if before.get(k) != after[k]}
    # One new person in each table, and one new salary.
    assert len([t for t, _ in changed if t == "bank_data"]) <= 2
    assert all(len([t for t, _ in changed if t == name]) <= 1 for name in schema.WAREHOUSE if name != "bank_data")
    assert len(before) > 20
    salaries = {r.passport_fk: r.salary for r in snapshots.read_tables(spark, root)["bank_data"].collect()}
    assert len(salaries) == 61 and salaries["P7"] == "9$"


FIELDS = {"passport": ["P1", "P2", "P3"], "name": ["a", "b"], "sex": [None, "F"], "email": ["x", "y", None]}


def random_messages(rng, n):
    rows = []
    for i in range(n):
        doc = {f: rng.choice(v) for f, v in FIELDS.items() if f in ("passport", "name") or rng.random() < 0.5}
        if rng.random() < 0.2:
            doc = {"x": rng.randrange(3)} if rng.random() < 0.5 else {"IPv4": f"1.1.1.{rng.randrange(3)}", "address": rng.choice("AB")}
        rows.append((i, START, json.dumps(doc)))
    return rows


def same_rows(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    key = lambda df: sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    assert key(a) == key(b)


@pytest.mark.parametrize("cuts", [[0, 5, 5, 40], [39, 40]])
def test_folded_collections_equal_a_merge_of_everything(spark, tmp_path, small_buckets, cuts):
    store = str(tmp_path / "store")
    rows = random_messages(random.Random(len(cuts)), 40)
    random.Random(1).shuffle(rows)  # batches may bring older messages later
    decoded = messages.storable(messages.decode(spark.createDataFrame(rows, messages.MESSAGE)))
    numbers = {r[0]: i for i, r in enumerate(rows)}
    place = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])[F.col("ord").cast("int")]
    assert collected.fold(spark, store) is None
    for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, 40], strict=False)):
        raw.write_batch(decoded.where((place >= a) & (place < b)), f"{store}/fragments", n)
        if n != 1:
            collected.fold(spark, store)
    assert collected.unfolded(spark, store) == []
    assert collected.fold(spark, store) == buckets.latest(spark, f"{store}/base")
    every = raw.read_fragments(spark, f"{store}/fragments")
    for kind in ("personal", "net", schema.UNKNOWN):
        same_rows(collected.collection(spark, store, kind), raw.merged(every, kind))
    assert collected.collection(spark, store, "bank").count() == 0


def test_fold_reads_new_batches_only_and_takes_a_retry(spark, tmp_path):
    store = str(tmp_path / "store")

    def put(batch, docs):
        rows = [(batch * 10 + i, START, json.dumps(d)) for i, d in enumerate(docs)]
        decoded = messages.storable(messages.decode(spark.createDataFrame(rows, messages.MESSAGE)))
        raw.write_batch(decoded, f"{store}/fragments", batch)

    put(0, [{"passport": "P", "name": "a", "email": "e"}])
    put(2, [{"passport": "P", "name": "c"}])
    assert collected.fold(spark, store) == 0
    note = buckets.load(spark, f"{store}/base", 0).note
    assert note == {"through": 0, "beyond": [2]}
    put(1, [{"passport": "P", "name": "b", "email": None}])
    (tmp_path / "store/fragments/batch_id=3").mkdir()  # still being written
    assert collected.unfolded(spark, store) == [1]
    # Not even the folders of folded batches are needed.
    held = raw.read_batches(spark, f"{store}/fragments", [1])
    assert {f.split("batch_id=")[1][0] for f in held.inputFiles()} == {"1"}
    assert collected.fold(spark, store) == 1
    put(1, [{"passport": "P", "name": "b", "email": None}])
    assert collected.unfolded(spark, store) == []
    row = collected.collection(spark, store, "personal").first()
    assert (row.ord, row.last_ord, row.name, row.email) == (0, 20, "c", None)


SCHEMA = "id long, passport string, email string, name string, present array<string>"


def random_records(rng, n):
    return [
        (i, rng.choice([None, "", f"p{rng.randrange(n)}"]), rng.choice([None, f"e{rng.randrange(n)}"]),
         rng.choice([None, f"n{rng.randrange(2 * n)}", f"e{rng.randrange(n)}"]), rng.sample(["passport", "email", "name"], 2))
        for i in range(n)
    ]


@pytest.mark.parametrize("mode,present,ends", [("key_value", None, (25, 50, 60)), ("value", "present", (30, 60))])
def test_growing_people_equal_a_full_grouping(spark, tmp_path, small_buckets, mode, present, ends):
    root, fields, keys = str(tmp_path), ["passport", "email", "name"], ["passport", "email", "name"]
    rows = random_records(random.Random(2), 60)
    random.Random(3).shuffle(rows)
    for version, (start, end) in enumerate(zip((0, *ends), ends, strict=False)):
        for _ in range(2 if version == 1 and present else 1):  # a batch is run twice
            people.advance(
                spark.createDataFrame(rows[start:end], SCHEMA), root, version, "id", fields, keys, mode, present
            )
        full = resolve.group_records(spark.createDataFrame(rows[:end], SCHEMA), "id", fields, keys, mode, present)
        same_rows(people.people(spark, root, fields), full)
    assert people.people(spark, root, fields, 0).count() > 0


def test_a_batch_reads_what_it_touches(spark, tmp_path, small_buckets, monkeypatch):
    root, fields = str(tmp_path), ["passport", "email"]
    ddl = "id long, passport string, email string"
    first = [(i, f"p{i}", f"e{i % 150}") for i in range(300)]
    people.advance(spark.createDataFrame(first, ddl), root, 0, "id", fields, fields)
    counted = []
    read = buckets.read

    def watched(spark, root, table, only=None):
        counted.append(sum(n for b, (_, n) in table.parts.items() if only is None or b in only))
        return read(spark, root, table, only)

    monkeypatch.setattr(buckets, "read", watched)
    later = [(1000, "p7", "new"), (1001, "p8", "e9"), (1002, "p999", "new")]
    people.advance(spark.createDataFrame(later, ddl), root, 1, "id", fields, fields)
    assert 0 < sum(counted) < 150 < 300 + 450
    monkeypatch.undo()
    full = resolve.group_records(spark.createDataFrame(first + later, ddl), "id", fields, fields)
    same_rows(people.people(spark, root, fields), full)


def test_a_batch_of_one_type_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(0, 80_000, 1, 1).select(
        F.col("id").alias("ord"), F.lit(None).cast("timestamp").alias("ingest_ts"),
        F.to_json(F.struct(F.sha2(F.col("id").cast("string"), 256).alias("x"))).alias("value"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "200k")
    try:
        raw.write_batch(messages.storable(messages.decode(rows)), str(tmp_path / "fragments"), 0)
    finally:
        spark.conf.unset(size)
    stored = raw.read_fragments(spark, str(tmp_path / "fragments"))
    assert stored.where("fragment_type = 'unknown'").count() == 80_000
    per_file = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) > 3 and max(per_file) < 40_000
