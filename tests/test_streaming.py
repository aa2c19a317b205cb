import json
from datetime import datetime, timedelta, timezone
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks import registry
from tessera.operators.metrics import panes
from tessera.sources import audit, buckets, files, messages, observations, raw
from tessera.streaming import dedup, ingest, jobs

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def put(spark, path, rows):
    """Append one file of messages ``(ord, hour, value)``."""
    df = spark.createDataFrame(
        [(o, START + timedelta(hours=h), v if isinstance(v, str) else json.dumps(v)) for o, h, v in rows],
        messages.MESSAGE,
    )
    df.coalesce(1).write.mode("append").parquet(path)


def drain(stream, tmp_path, spark):
    query = (
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(str(tmp_path / "out")), query


def test_ttl_dedup_over_batches_and_restart(spark, tmp_path):
    incoming = str(tmp_path / "in")
    put(spark, incoming, [(20, 20, "a"), (0, 0, "a"), (1, 0, "a"), (2, 1, "b")])
    put(spark, incoming, [(24, 24, "a")])
    stream = dedup.ttl_dedup_stream(
        messages.file_messages(spark, incoming, max_files_per_trigger=1),
        "value", "ingest_ts", "ord", buckets=2,
    )
    out, query = drain(stream, tmp_path, spark)
    assert len([p for p in query.recentProgress if p.numInputRows]) == 2
    assert sorted(r.ord for r in out.collect()) == [0, 2, 24]
    put(spark, incoming, [(50, 50, "a"), (30, 30, "a"), (51, 51, "a"), (25, 24.5, "b")])
    out, _ = drain(stream, tmp_path, spark)
    assert sorted(r.ord for r in out.collect()) == [0, 2, 24, 50]


def test_late_messages_are_kept_and_held_against_both_sides(spark, tmp_path):
    incoming = str(tmp_path / "in")
    for rows in ([(1, 100, "a"), (2, 100, "b")], [(3, 40, "a"), (4, 60, "a"), (5, 90, "a")],
                 [(6, 0, "c"), (7, 70, "a"), (8, 30, "b"), (9, 64, "a")]):
        put(spark, incoming, rows)
    stream = dedup.ttl_dedup_stream(
        messages.file_messages(spark, incoming, max_files_per_trigger=1), "value", "ingest_ts", "ord", buckets=1
    )
    out, _ = drain(stream, tmp_path, spark)
    assert sorted(r.ord for r in out.collect()) == [1, 2, 3, 6, 8, 9]


def test_state_is_swept(spark, tmp_path):
    incoming = str(tmp_path / "in")
    put(spark, incoming, [(0, 0, "a"), (1, 0, "b")])
    put(spark, incoming, [(2, 200, "c")])
    put(spark, incoming, [(3, 10, "a"), (4, 201, "c")])
    stream = dedup.ttl_dedup_stream(
        messages.file_messages(spark, incoming, max_files_per_trigger=1), "value", "ingest_ts", "ord",
        keep_seconds=100 * 3600, buckets=1,
    )
    out, _ = drain(stream, tmp_path, spark)
    assert sorted(r.ord for r in out.collect()) == [0, 1, 2, 3]


class Held:
    """A state variable that counts the calls to it."""

    def __init__(self):
        self.entries, self.calls = {}, 0

    def getValue(self, key):
        self.calls += 1
        return self.entries.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.entries[key] = value

    def get(self):
        return self.entries.get(())

    def update(self, value):
        self.entries[()] = value


def test_state_is_read_and_written_by_the_page(monkeypatch):
    monkeypatch.setattr(dedup, "PAGES", 8)
    held = Held()
    op = dedup.TtlDedup("key", "at", "ord", 10, 100, ["ord"])
    op.init(SimpleNamespace(getMapState=lambda *_: held, getValueState=lambda *_: Held()))
    keys = [*(f"k{n}" for n in range(5000)), None]
    for batch, fresh in ((0, 5001), (1, 0), (2, 5001)):
        rows = pd.DataFrame({
            "ord": range(len(keys)), "key": keys, "at": pd.to_datetime([batch * 6] * len(keys), unit="s"),
        })
        held.calls = 0
        out = list(op.handleInputRows((0,), iter([rows[n : n + 100] for n in range(0, len(rows), 100)]), None))
        assert sum(map(len, out)) == fresh
        assert held.calls <= 16


def test_chunks_are_sorted_a_few_times(monkeypatch):
    """However many chunks a batch comes in, each row is sorted as often as the held rows double."""
    sorted_rows = []
    sort = pd.DataFrame.sort_values
    monkeypatch.setattr(pd.DataFrame, "sort_values", lambda df, *a, **k: sorted_rows.append(len(df)) or sort(df, *a, **k))
    op = dedup.TtlDedup("key", "at", "ord", 10, 100, ["ord"])
    op.init(SimpleNamespace(getMapState=lambda *_: Held(), getValueState=lambda *_: Held()))
    n = 4000
    rows = pd.DataFrame({
        "ord": range(n), "key": [f"k{k}" for k in range(n)], "at": pd.to_datetime([0] * n, unit="s"),
    })
    out = list(op.handleInputRows((0,), iter([rows[k : k + 10] for k in range(0, n, 10)]), None))
    assert sum(map(len, out)) == n
    assert sum(sorted_rows) <= 4 * n


def test_fold_holds_times_apart():
    op = dedup.TtlDedup("key", "at", "ord", 10, 100, ["ord"])
    s = 1_000_000
    free, held = op._fold([50 * s], [5 * s, 12 * s, 15 * s, 41 * s, 60 * s, 161 * s])
    assert free == [True, False, True, False, True, True]
    assert held == [161 * s]


def test_nothing_is_lost_on_the_way(spark, tmp_path):
    incoming, store, check = (str(tmp_path / p) for p in ("in", "store", "check"))
    put(spark, incoming, [(k, 500 + k, {"passport": f"P{k}", "name": "n"}) for k in range(40)] + [(50, 600, "{")])
    put(spark, incoming, [(100 + k, k, {"passport": f"P{k}", "IBAN": "i"}) for k in range(40)])
    put(spark, incoming, [(200 + k, 300 + k, {"passport": f"P{k}", "name": "n"}) for k in range(40)] + [(250, 500.5, {"name": "n", "passport": "P0"})])
    source = messages.file_messages(spark, incoming, max_files_per_trigger=1)
    ingest.ingest(source, store, check, buckets=4).awaitTermination()
    ingest.quarantine(source, store, check).awaitTermination()
    stored = sorted(r.ord for r in raw.read_fragments(spark, f"{store}/fragments").collect())
    refused = [r.ord for r in spark.read.parquet(f"{store}/quarantine").collect()]
    assert refused == [50]
    assert stored == sorted([*range(40), *range(100, 140), *range(200, 240)])  # 250 is a repeat of 0


def test_ingest_merges_over_batches(spark, tmp_path):
    incoming, store, check = (str(tmp_path / p) for p in ("in", "store", "check"))
    one = {"passport": "P1", "name": "Ana", "sex": ["F"], "email": "a"}
    put(spark, incoming, [(1, 0, one), (2, 1, one), (3, 1, '{"bad'), (4, 1, {"IPv4": None})])
    put(spark, incoming, [(5, 2, {"name": "Ana", "passport": "P1", "sex": None}), (6, 2, {"x": 1}), (7, 2, {"x": 1.5})])
    source = messages.file_messages(spark, incoming, max_files_per_trigger=1)
    ingest.ingest(source, store, check, buckets=8).awaitTermination()
    ingest.quarantine(source, store, check).awaitTermination()
    ingest.audit_batches(source, store, check).awaitTermination()
    people = raw.collections(spark, f"{store}/fragments")["personal"].collect()
    assert [(r.ord, r.passport, r.name, r.sex, r.email) for r in people] == [(1, "P1", "Ana", None, "a")]
    fragments = raw.read_fragments(spark, f"{store}/fragments")
    assert sorted(r.ord for r in fragments.collect()) == [1, 5, 6, 7]
    assert raw.merged(fragments, "unknown").count() == 2
    refused = spark.read.parquet(f"{store}/quarantine").collect()
    assert sorted((r.ord, r.reason) for r in refused) == [(3, "not a JSON object"), (4, "no key")]
    log = audit.read(spark, f"{store}/log").collect()
    assert {r.day for r in log} == {"2024-01-01"}
    assert "batch 0: 2 personal messages" in {r.message for r in log}
    assert sum(r.level == "ERROR" for r in log) == 2
    totals = {}
    for r in observations.read(spark, f"{store}/metrics").collect():
        totals[r.metric] = totals.get(r.metric, 0) + r.value
    assert totals == {"received personal": 3, "received unknown": 2, "stored personal": 2, "stored unknown": 2,
                      "not a JSON object": 1, "no key": 1}


def test_one_pass_survives_a_cut_between_outputs(spark, tmp_path, monkeypatch):
    incoming, store, check = (str(tmp_path / p) for p in ("in", "store", "check"))
    one = {"passport": "P1", "name": "Ana", "sex": ["F"], "email": "a"}
    put(spark, incoming, [(1, 0, one), (2, 1, one), (3, 1, '{"bad'), (4, 1, {"IPv4": None})])
    put(spark, incoming, [(5, 2, {"name": "Ana", "passport": "P1", "sex": None}), (6, 2, {"x": 1}), (7, 2, {"x": 1.5}),
                          (8, 3, one), (9, 3, one)])
    no_time = spark.createDataFrame([(10, None, json.dumps(one))], messages.MESSAGE)
    no_time.coalesce(1).write.mode("append").parquet(incoming)
    append, cut = audit.append, []

    def once(log, path, batch):
        if batch.endswith("-1") and not cut:
            cut.append(batch)
            raise RuntimeError("cut off")
        append(log, path, batch)

    monkeypatch.setattr(audit, "append", once)
    source = messages.file_messages(spark, incoming, max_files_per_trigger=1)
    with pytest.raises(Exception, match="cut off"):
        ingest.ingest_all(source, store, check, buckets=4).awaitTermination()
    assert ingest.committed(spark, store) == [0] and (tmp_path / "store/fragments/batch_id=1").exists()
    assert {r.ord for r in ingest.read_quarantine(spark, store).collect()} == {3, 4}
    query = ingest.ingest_all(source, store, check, buckets=4)
    query.awaitTermination()
    assert cut and ingest.committed(spark, store) == [0, 1, 2]
    # Whatever is written from it, a batch reads its messages once.
    assert sum(p.numInputRows for p in query.recentProgress) == 6
    fragments = raw.read_fragments(spark, f"{store}/fragments")
    assert sorted(r.ord for r in fragments.collect()) == [1, 5, 6, 7]
    refused = {r.ord: r.reason for r in ingest.read_quarantine(spark, store).collect()}
    assert refused == {3: "not a JSON object", 4: "no key", 10: "no time"}
    totals, took = {}, set()
    for r in observations.read(spark, f"{store}/metrics").collect():
        totals[r.metric] = totals.get(r.metric, 0) + r.value
    took = {m for m in totals if m.endswith(" seconds")}
    assert took == {"send seconds", "raw insert seconds"}
    assert {m: n for m, n in totals.items() if m not in took} == {
        "received personal": 5, "received unknown": 2, "stored personal": 2, "stored unknown": 2,
        "not a JSON object": 1, "no key": 1, "no time": 1,
    }
    assert "batch 1: 2 personal messages, repeat" in {r.message for r in audit.read(spark, f"{store}/log").collect()}
    assert not list((tmp_path / "store/arrived").glob("batch_id=*"))


def test_a_retried_batch_replaces_itself(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = [(1, START, '{"passport":"P","name":"a"}'), (2, START, '{"x":1}')]
    batch = messages.storable(messages.decode(spark.createDataFrame(rows, messages.MESSAGE)))
    raw.write_batch(batch, store, 0)
    raw.write_batch(batch, store, 0)
    assert raw.read_fragments(spark, store).count() == 2


def test_raw_scan_reads_one_type_and_few_columns(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = [(1, START, '{"passport":"P","name":"a"}'), (2, START, '{"x":1}')]
    raw.write_batch(messages.storable(messages.decode(spark.createDataFrame(rows, messages.MESSAGE))), store, 0)
    bank = raw.collections(spark, store)["bank"]
    plan = bank._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "fragment_type" in plan.split("PartitionFilters")[1]
    assert "company:string" not in plan and bank.count() == 0


def test_snapshots_are_numbered_and_cumulative(spark, tmp_path):
    incoming, store, out = (str(tmp_path / p) for p in ("in", "store", "out"))
    put(spark, incoming, [(1, 0, {"passport": "P1", "name": "Mr. ANA"}), (2, 0, {"fullname": "X", "city": "C"})])
    put(spark, incoming, [(3, 1, {"passport": "P1", "IBAN": "I"})])
    source = messages.storable(messages.decode(messages.file_messages(spark, incoming, max_files_per_trigger=1)))
    jobs.snapshots(source, store, out, str(tmp_path / "check")).awaitTermination()
    first = spark.read.json(f"{out}/json/batch=0").collect()
    assert sorted((r.passport or "", r.name or "") for r in first) == [("", ""), ("P1", "Ana")]
    header = ["bank_IBAN", "bank_passport", "location_city", "location_fullname", "personal_name",
              "personal_passport", "professional_fullname"]
    rows = files.read_csv(spark, f"{out}/csv/batch=1", header).collect()
    assert sorted(r.bank_IBAN or "" for r in rows) == ["", "I"]
    jobs.snapshot_people(raw.read_fragments(spark, store), out, "final")
    assert spark.read.json(f"{out}/json/batch=final").count() == 2


def test_rolling_mean_stream(spark, tmp_path):
    incoming = str(tmp_path / "in")
    put(spark, incoming, [(3, 4, "9"), (2, 5 / 3600, "4")])
    put(spark, incoming, [(1, 0, "2")])
    stream = messages.file_messages(spark, incoming, max_files_per_trigger=1).select(
        "ingest_ts", F.lit("send").alias("metric"), F.col("value").cast("double").alias("value")
    )
    path = str(tmp_path / "panes")
    jobs.rolling_mean_stream(stream, "ingest_ts", "metric", "value", path, str(tmp_path / "check")).awaitTermination()
    rows = sorted((r.window_end.hour, r.window_end.minute * 60 + r.window_end.second, r["mean"])
                  for r in jobs.rolling_means(spark, path).collect())
    assert rows == [(0, s, 3.0) for s in (10, 20, 30, 40, 50, 60)] + [(4, s, 9.0) for s in (10, 20, 30, 40, 50, 60)]


def test_folded_panes_give_the_same_means(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "ROWS_PER_BUCKET", 20)
    path = str(tmp_path / "panes")
    start = int(START.timestamp())
    rows = [(start + 97 * i, f"m{i % 2}", float(i)) for i in range(300)]

    def put_panes(batch):
        df = spark.createDataFrame([r for i, r in enumerate(rows) if i % 4 == batch], "at long, metric string, value double")
        summed = panes(df.withColumn("ts", F.timestamp_seconds("at")), "ts", "metric", "value")
        summed.write.mode("overwrite").parquet(f"{path}/batch_id={batch}")

    def means(**options):
        found = jobs.rolling_means(spark, path, **options).collect()
        return {(r.metric, r.window_end): (r.total, r.observations) for r in found}

    for batch in range(4):
        put_panes(batch)
    before = means()
    assert jobs.fold_panes(spark, path) == 0 and means() == before
    put_panes(1)  # written again after it was folded
    assert jobs.fold_panes(spark, path) == 0 and means() == before
    since = datetime.fromtimestamp(rows[280][0])
    until = since + timedelta(minutes=20)
    assert means(since=since) == {k: v for k, v in before.items() if k[1] >= since}
    recent = means(since=since, until=until)
    assert recent == {k: v for k, v in before.items() if since <= k[1] <= until} and recent
    read = len(jobs.rolling_means(spark, path, since, until).inputFiles())
    assert 0 < read < len(jobs.rolling_means(spark, path).inputFiles())


def test_recurring_job_sees_each_batch(spark, tmp_path):
    incoming, seen = str(tmp_path / "in"), []
    put(spark, incoming, [(1, 0, "x"), (2, 0, "y")])
    jobs.recurring(
        messages.file_messages(spark, incoming), lambda df, n: seen.append((n, df.count())),
        str(tmp_path / "check"), {"availableNow": True},
    ).awaitTermination()
    assert seen == [(0, 2)]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.kafka_messages(spark, "broker:9092", "people")


def test_arrival_orders_by_time_partition_and_offset(spark):
    rows = [(2, 0, 5), (1, 900, 1), (1, 3, 4097), (1, 3, 4098), (1, 0, 1 << 40)]
    df = spark.createDataFrame(rows, "s long, p int, o long").withColumn("t", F.timestamp_seconds("s"))
    ordered = df.withColumn("ord", messages.arrival(F.col("t"), F.col("p"), F.col("o"))).orderBy("ord")
    assert [r.s * 10**6 + r.p for r in ordered.collect()] == [10**6, 10**6 + 3, 10**6 + 3, 10**6 + 900, 2 * 10**6]
    assert ordered.select("ord").distinct().count() == 5


def test_json_array_source(spark, tmp_path):
    path = tmp_path / "incomplete.json"
    path.write_text(json.dumps([{"email": "a", "name": "José"}, {"email": "b"}], indent=2), encoding="utf-8")
    rows = files.read_records(spark, str(path), "email string, name string", array=True).collect()
    assert [tuple(r) for r in rows] == [("a", "José"), ("b", None)]


def test_csv_keeps_text_as_it_is(spark, tmp_path):
    people = spark.createDataFrame(
        [('a "quoted", \nline ', None, " x"), (None, None, "y\\")], "name string, email string, city string"
    )
    header = files.write_csv(people, str(tmp_path / "csv"))
    assert header == ["location_city", "personal_name"]
    rows = files.read_csv(spark, str(tmp_path / "csv"), header).collect()
    assert sorted(map(tuple, rows)) == [(" x", 'a "quoted", \nline '), ("y\\", None)]


def test_a_third_is_one_batch_of_many_files(spark, tmp_path):
    df = spark.range(600_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    seen, tasks = [], []
    for path in registry._in_thirds(spark, df, "thirds", F.col("id") % 3, "id"):
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", registry.ALL_FILES).parquet(path)
        stream.writeStream.foreachBatch(
            lambda rows, n: seen.append((n, rows.count(), rows.agg(F.min(F.col("id") % 3), F.max(F.col("id") % 3)).first()))
        ).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
        tasks.append(len(spark.read.parquet(path).inputFiles()))
    assert [(n, rows, *thirds) for n, rows, thirds in seen] == [(n, 200_000, n, n) for n in range(3)]
    assert tasks[0] > 1 and tasks[2] > 3
