"""The registered queries: each operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.oracles import STORED_PERSONS
from checks.views import spark_view, table
from tessera import schema, scratch
from tessera.functions import udfs
from tessera.functions.cleaning import clean
from tessera.operators import metrics
from tessera.operators.dedup import ttl_dedup
from tessera.plans import fuse, names, people, resolve, serve, warehouse
from tessera.session import STATE_STORE
from tessera.sources import audit, collected, files, messages, observations, raw, snapshots
from tessera.streaming import ingest, jobs
from tessera.streaming.dedup import ttl_dedup_stream

STRONG_KEYS = ["passport", "email", "fullname", "telfnumber", "address"]
FIELDS = raw.FIELDS

# A test has few shuffle partitions, and so few buckets.
LOCAL_BUCKETS = 64

# As many files per batch as there are.
ALL_FILES = 1 << 30

Query = Callable[[SparkSession, str], DataFrame]


def _fragments(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: clean(spark_view(spark, sf_dir, f"fx_{t}")) for t in schema.FRAGMENT_FIELDS}


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fragments as records of one shape, with ids in order of arrival."""
    whole = None
    for place, df in enumerate(_fragments(spark, sf_dir).values()):
        df = df.withColumn("record_id", F.col("ord") * 5 + place).drop("ord")
        whole = df if whole is None else whole.unionByName(df, allowMissingColumns=True)
    return whole


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.decode(spark_view(spark, sf_dir, "fx_messages"))


def _fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuse.fuse_persons(**_fragments(spark, sf_dir))


def _incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuse.incomplete_persons(**_fragments(spark, sf_dir))


def _everyone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuse.all_persons(**_fragments(spark, sf_dir))


def _load(spark: SparkSession, sf_dir: str) -> warehouse.Load:
    return warehouse.load_warehouse(_fused(spark, sf_dir))


def _table(name: str) -> Query:
    return lambda spark, sf_dir: _load(spark, sf_dir).tables[name]


def _cleaned(name: str) -> Query:
    return lambda spark, sf_dir: clean(spark_view(spark, sf_dir, f"fx_{name}"))


def _merged(name: str) -> Query:
    return lambda spark, sf_dir: raw.merged(messages.storable(_decoded(spark, sf_dir)), name)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _in_thirds(spark: SparkSession, df: DataFrame, label: str, part: Column, order: str) -> Iterator[str]:
    """Append ``df`` to a folder in three parts, by the value (0, 1, 2) of ``part``, each in files of even size. The folder
    is given after each, for a stream to go on with: a part is one batch, however many files it has."""
    path = scratch.new_path(spark, label)
    for n in range(3):
        df.where(part == n).repartition(F.col(order)).write.mode("append").parquet(path)
        yield path


def _message_streams(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """The same stream three times: of events, then with orders, then with customers."""
    every = spark_view(spark, sf_dir, "fx_messages")
    for incoming in _in_thirds(spark, every, "messages", F.expr(_SOURCE), "ord"):
        yield messages.file_messages(spark, incoming, max_files_per_trigger=ALL_FILES)


# Messages by their source: events, orders, customers.
_SOURCE = "CASE WHEN ord >= 2000000000 THEN 0 WHEN ord >= 1000000000 THEN 1 ELSE 2 END"


def _event_streams(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """The same stream three times, each with a third more of the events; every third covers the whole time."""
    events = _events(spark, sf_dir)
    for path in _in_thirds(spark, events, "events", F.col("event_id") % 3, "event_id"):
        yield spark.readStream.schema(events.schema).option("maxFilesPerTrigger", ALL_FILES).parquet(path)


def _drain(spark: SparkSession, streams: Iterable[DataFrame], label: str) -> DataFrame:
    """Run a stream each time that there is more of it, and read back what it wrote."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    path, checkpoint = scratch.new_path(spark, label), scratch.new_path(spark, f"{label}-checkpoint")
    for stream in streams:
        (
            stream.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start().awaitTermination()
        )
    return spark.read.schema(stream.schema).parquet(path)


def _accepted_events(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id", "user_id", "event_type",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("accepted_at"),
    )


def _window_rows(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("event_type").alias("metric"),
        F.date_format("window_end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
        F.col("total").cast("double").alias("total"), "observations",
        F.round("mean", 6).alias("mean"),
    )


def route_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir).select("ord", "fragment_type", "reason")


def fingerprint_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = _decoded(spark, sf_dir).where(F.col("fingerprint").isNotNull())
    return decoded.groupBy("fingerprint").agg(
        F.min("ord").alias("first_ord"), F.count(F.lit(1)).alias("messages")
    ).drop("fingerprint")


def flatten_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(spark, sf_dir)
    flat = resolve.flatten(records)
    return records.select("record_id", *[
        F.col(schema.column(f)).alias(prefix + f)
        for prefix, fields in schema.FLAT_GROUPS.items() for f in fields
    ]).select("record_id", *[f"`{c}`" for c in flat.columns])


def name_in_fullname(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _fragments(spark, sf_dir)
    found = fuse.first_locations(parts["personal"], parts["location"])
    people = parts["personal"].select(
        "ord", fuse.fold(F.col("name")).alias("a"), fuse.fold(F.col("last_name")).alias("b")
    )
    return people.join(found, ["a", "b"]).select("ord", "location_ord")


def grown_name_in_fullname(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``name_in_fullname``, from an index that takes in persons and locations in two batches, in opposite
    orders, so that old and new names meet old and new texts."""
    parts = {t: scratch.materialise(df, t) for t, df in _fragments(spark, sf_dir).items() if t in ("personal", "location")}
    state = scratch.new_path(spark, "names")
    for n in range(2):
        names.advance(
            fuse.name_pairs(parts["personal"].where(F.col("ord") % 2 == n)),
            fuse.name_texts(parts["location"].where(F.pmod(F.xxhash64("ord"), F.lit(2)) == 1 - n)),
            state, n, "location_ord",
        )
    people = parts["personal"].select(
        "ord", fuse.fold(F.col("name")).alias("a"), fuse.fold(F.col("last_name")).alias("b")
    )
    return people.join(names.firsts(spark, state, "location_ord"), ["a", "b"]).select("ord", "location_ord")


def completeness_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuse.completeness_totals(_everyone(spark, sf_dir))


def ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the running ingest observed over three batches, in total per metric."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    store, checkpoint = scratch.new_path(spark, "store"), scratch.new_path(spark, "checkpoint")
    for source in _message_streams(spark, sf_dir):
        ingest.ingest(source, store, checkpoint, buckets=LOCAL_BUCKETS).awaitTermination()
        ingest.audit_batches(source, store, checkpoint).awaitTermination()
    seen = observations.read(spark, f"{store}/metrics")
    return seen.groupBy("metric").agg(F.sum("value").alias("total"))


def ingest_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``ingest_metrics``, from the query that reads the source once."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    store, checkpoint = scratch.new_path(spark, "store"), scratch.new_path(spark, "checkpoint")
    for source in _message_streams(spark, sf_dir):
        ingest.ingest_all(source, store, checkpoint, buckets=LOCAL_BUCKETS).awaitTermination()
    seen = observations.read(spark, f"{store}/metrics").where(~F.col("metric").endswith(" seconds"))
    return seen.groupBy("metric").agg(F.sum("value").alias("total"))


def upsert_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "customer").createOrReplaceTempView("source_customer")
    stored = spark.sql(f"WITH customer AS (SELECT * FROM source_customer) {STORED_PERSONS}")
    load = warehouse.load_warehouse(_fused(spark, sf_dir), {"persons": stored})
    return load.tables["persons"]


def broken_rows_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load refuses of persons with too long, empty and wrong values."""
    fused = _fused(spark, sf_dir)
    fault = F.col("ord") % 50
    wrong = {
        "last_name": (1, F.repeat(F.lit("x"), 101)), "email": (2, F.lit("")), "IPv4": (3, F.lit("10.0.0.256")),
        "IBAN": (4, F.repeat(F.lit("9"), 35)), "address": (5, F.repeat(F.lit("y"), 256)), "company": (6, F.lit("")),
    }
    broken = fused.withColumns({c: F.when(fault == n, value).otherwise(F.col(c)) for c, (n, value) in wrong.items()})
    return warehouse.load_warehouse(broken).rejected


def persons_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.pruned_json(serve.persons_by(_load(spark, sf_dir).tables))


def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scalar functions in plain SQL, over persons and their places."""
    udfs.register(spark)
    for name in ("personal", "location"):
        spark_view(spark, sf_dir, f"fx_{name}").createOrReplaceTempView(f"sql_{name}")
    return spark.sql("""SELECT p.ord, clean_name(p.name) AS name, clean_phone(p.telfnumber) AS telfnumber,
          clean_address(l.address) AS address, names_in_fullname(clean_name(p.name), p.last_name, l.fullname) AS named,
          address_match(l.address, upper(l.address) || ' ') AS same_address
        FROM sql_personal p JOIN sql_location l ON p.ord = l.ord""")


def any_key_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    persons = _load(spark, sf_dir).tables["persons"]
    return resolve.any_key_matches(_incomplete(spark, sf_dir), "ord", persons, "passport")


def any_key_matched_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    persons = _load(spark, sf_dir).tables["persons"]
    return resolve.any_key_matches(persons, "passport", _incomplete(spark, sf_dir), "ord")


def any_key_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.any_key_links(_incomplete(spark, sf_dir), "ord")


def components_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    incomplete = scratch.materialise(_incomplete(spark, sf_dir), "incomplete")
    return resolve.cluster_report(resolve.clusters(incomplete, "ord"))


def group_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.group_records(_records(spark, sf_dir), "record_id", FIELDS, STRONG_KEYS)


def group_records_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.group_records(
        _records(spark, sf_dir), "record_id", FIELDS, link_mode="value"
    )


def lookup_passport(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.passport_by_name_or_address(_everyone(spark, sf_dir), "ord")


def lookup_location_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    locations = _load(spark, sf_dir).tables["locations"]
    return resolve.location_id_by_address_city(_everyone(spark, sf_dir), "ord", locations)


def lookup_person_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = _fragments(spark, sf_dir)["personal"]
    return resolve.person_by_priority(_records(spark, sf_dir), "record_id", people, "ord")


def ttl_dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accepted_events(
        ttl_dedup(_events(spark, sf_dir), ["user_id", "event_type"], "ts", "event_id")
    )


def stream_ttl_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("key")
    # The files reach back over all of a month, so accepted times are kept for longer than that.
    accepted = (
        ttl_dedup_stream(
            events.select("event_id", "ts", "user_id", "event_type", key), "key", "ts", "event_id",
            keep_seconds=60 * 86_400, buckets=LOCAL_BUCKETS,
        )
        for events in _event_streams(spark, sf_dir)
    )
    return _accepted_events(_drain(spark, accepted, "accepted-events"))


def stream_raw_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five collections after a stream of three batches: events, then orders, then customers."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    store, checkpoint = scratch.new_path(spark, "store"), scratch.new_path(spark, "checkpoint")
    for source in _message_streams(spark, sf_dir):
        ingest.ingest(source, store, checkpoint, buckets=LOCAL_BUCKETS).awaitTermination()
    return _all_of(raw.collections(spark, f"{store}/fragments"), "fragment_type")


def ttl_dedup_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all events without a user: null is one very hot key."""
    user = F.when(F.col("event_id") % 3 > 0, F.col("user_id"))
    events = _events(spark, sf_dir).withColumn("user_id", user)
    return _accepted_events(ttl_dedup(events, ["user_id", "event_type"], "ts", "event_id"))


def ttl_dedup_split_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``ttl_dedup_null_keys``, with every key of more than a hundred moments split by time."""
    user = F.when(F.col("event_id") % 3 > 0, F.col("user_id"))
    events = _events(spark, sf_dir).withColumn("user_id", user)
    found = ttl_dedup(events, ["user_id", "event_type"], "ts", "event_id", hot_moments=100)
    return _accepted_events(found)


def folded_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All collections after three batches: events, then orders, then customers, each folded into the base."""
    store = scratch.new_path(spark, "store")
    fragments = scratch.materialise(messages.storable(_decoded(spark, sf_dir)), "fragments")
    for n in range(3):
        raw.write_batch(fragments.where(F.expr(_SOURCE) == n), f"{store}/fragments", n)
        collected.fold(spark, store)
    return _all_of({
        kind: collected.collection(spark, store, kind).drop("fingerprint")
        for kind in [*schema.FRAGMENT_FIELDS, schema.UNKNOWN]
    }, "fragment_type")


def _all_of(tables: dict[str, DataFrame], name: str) -> DataFrame:
    whole = None
    for kind, df in tables.items():
        df = df.withColumn(name, F.lit(kind))
        whole = df if whole is None else whole.unionByName(df, allowMissingColumns=True)
    return whole


def group_records_all_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By all identifying keys, so that given names make very large groups."""
    return resolve.group_records(_records(spark, sf_dir), "record_id", FIELDS)


def _grown(keys: list[str], link_mode: str = "key_value") -> Query:
    """The people after three batches of records, in an order that links old groups late."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        records = scratch.materialise(_records(spark, sf_dir), "records")
        state = scratch.new_path(spark, "people")
        for n, third in enumerate((2, 0, 1)):
            people.advance(
                records.where(F.col("record_id") % 3 == third), state, n, "record_id", FIELDS, keys, link_mode
            )
        return people.people(spark, state, FIELDS)

    return run


def stored_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables after two loads into one warehouse: the first half of the persons with old values, then all."""
    fused = scratch.materialise(_fused(spark, sf_dir), "fused")
    half = fused.agg(F.expr("(min(ord) + max(ord)) div 2")).first()[0] or 0
    old = fused.where(F.col("ord") <= half).withColumns(
        {"telfnumber": F.lit(None).cast("string"), "salary": F.lit("0$"), "job": F.lit("Old")}
    )
    root = scratch.new_path(spark, "warehouse")
    for part in (old, fused):
        load = warehouse.load_warehouse(part, snapshots.read_tables(spark, root), stored=True)
        snapshots.upsert_tables(load.changes, root)
    return _all_of(snapshots.read_tables(spark, root), "stored_in")


def unknown_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(schema.UNKNOWN)(spark, sf_dir).select("ord", "value")


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.quarantined(_decoded(spark, sf_dir)).drop("ingest_ts")


def rolling_mean_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_rows(metrics.rolling_mean(_events(spark, sf_dir), "ts", "event_type", "value"))


def stream_rolling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = scratch.new_path(spark, "panes"), scratch.new_path(spark, "panes-checkpoint")
    for events in _event_streams(spark, sf_dir):
        jobs.rolling_mean_stream(events, "ts", "event_type", "value", path, checkpoint).awaitTermination()
    return _window_rows(jobs.rolling_means(spark, path).withColumnRenamed("metric", "event_type"))


def duration_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.histogram(_events(spark, sf_dir), "event_type", "value")


def mean_message_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = metrics.mean_message_size(spark_view(spark, sf_dir, "fx_messages"), "value")
    return sizes.withColumn("mean_bytes", F.round("mean_bytes", 6))


def step_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summed = metrics.summary(_events(spark, sf_dir), "event_type", "value")
    return summed.withColumn("total", F.col("total").cast("double"))


def step_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = _decoded(spark, sf_dir).withColumn("step", F.coalesce("fragment_type", F.lit("none")))
    return metrics.step_counters(steps, "step", F.col("reason").isNotNull())


def last_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.col("event_type") != "error"
    return metrics.last_status(_events(spark, sf_dir), ok, "ts", "event_id", "user_id")


def roundtrip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    incomplete = _incomplete(spark, sf_dir)
    path = scratch.new_path(spark, "incomplete-json")
    files.write_json(incomplete, path)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in incomplete.schema)
    return files.read_records(spark, path, ddl)


def roundtrip_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    incomplete = _incomplete(spark, sf_dir)
    path = scratch.new_path(spark, "incomplete-json-array")
    files.write_json_arrays(incomplete, path)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in incomplete.schema)
    return files.read_records(spark, path, ddl, array=True)


def roundtrip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.new_path(spark, "people-csv")
    header = files.write_csv(group_records(spark, sf_dir), path)
    return files.read_csv(spark, path, header)


def roundtrip_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.new_path(spark, "raw")
    raw.write_batch(messages.storable(_decoded(spark, sf_dir)), path, 0)
    stored = raw.read_fragments(spark, path)
    return stored.groupBy("fragment_type").agg(F.count(F.lit(1)).alias("fragments"))


def roundtrip_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch.new_path(spark, "warehouse")
    snapshots.write_tables(_load(spark, sf_dir).tables, root)
    return snapshots.read_tables(spark, root)["persons"]


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.new_path(spark, "audit")
    log = audit.entries(
        _events(spark, sf_dir), "ts",
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO"),
        F.lit("step"),
        F.concat("event_type", F.lit(" by "), F.col("user_id").cast("string")),
    )
    audit.append(log, path, "0")
    return audit.read(spark, path)


def queries() -> dict[str, Query]:
    return {
        "fuse_persons": _fused,
        "clean_personal": _cleaned("personal"),
        "clean_location": _cleaned("location"),
        "clean_professional": _cleaned("professional"),
        "route_fragments": route_fragments,
        "fingerprint_groups": fingerprint_groups,
        "flatten_prefix": flatten_prefix,
        "name_in_fullname": name_in_fullname,
        "incomplete_persons": _incomplete,
        "completeness_totals": completeness_totals,
        "dim_locations": _table("locations"),
        "persons_load": _table("persons"),
        "persons_rejected": lambda spark, sf_dir: _load(spark, sf_dir).rejected,
        "bank_load": _table("bank_data"),
        "network_load": _table("network_data"),
        "professional_load": _table("professional_data"),
        "broken_rows_rejected": broken_rows_rejected,
        "upsert_persons": upsert_persons,
        "facet_cities": lambda s, d: serve.facet(_load(s, d).tables["locations"], "city"),
        "facet_jobs": lambda s, d: serve.facet(_load(s, d).tables["professional_data"], "job_title"),
        "persons_by_city_job": lambda s, d: serve.persons_by(_load(s, d).tables, "NATION_1", "MACH"),
        "persons_by_city_all": lambda s, d: serve.persons_by(_load(s, d).tables, "NATION_2", "all"),
        "persons_json": persons_json,
        "any_key_matches": any_key_matches,
        "any_key_matched_persons": any_key_matched_persons,
        "any_key_links": any_key_links,
        "components_incomplete": components_incomplete,
        "group_records": group_records,
        "group_records_all_keys": group_records_all_keys,
        "grown_name_in_fullname": grown_name_in_fullname,
        "grown_people": _grown(schema.IDENTIFYING_KEYS),
        "grown_people_by_value": _grown(schema.IDENTIFYING_KEYS, "value"),
        "folded_collections": folded_collections,
        "stored_warehouse": stored_warehouse,
        "group_records_by_value": group_records_by_value,
        "lookup_passport": lookup_passport,
        "lookup_location_id": lookup_location_id,
        "lookup_person_priority": lookup_person_priority,
        "ttl_dedup_events": ttl_dedup_events,
        "ttl_dedup_null_keys": ttl_dedup_null_keys,
        "ttl_dedup_split_keys": ttl_dedup_split_keys,
        "stream_ttl_dedup": stream_ttl_dedup,
        "raw_upsert_merge": _merged("personal"),
        "raw_upsert_bank": _merged("bank"),
        "raw_upsert_professional": _merged("professional"),
        "raw_upsert_location": _merged("location"),
        "raw_upsert_net": _merged("net"),
        "unknown_dedup": unknown_dedup,
        "quarantine": quarantine,
        "sql_functions": sql_functions,
        "stream_raw_upsert": stream_raw_upsert,
        "rolling_mean_1m": rolling_mean_1m,
        "stream_rolling_mean": stream_rolling_mean,
        "duration_histogram": duration_histogram,
        "mean_message_size": mean_message_size,
        "step_summary": step_summary,
        "step_counters": step_counters,
        "last_status": last_status,
        "roundtrip_json": roundtrip_json,
        "roundtrip_json_array": roundtrip_json_array,
        "roundtrip_csv": roundtrip_csv,
        "roundtrip_raw": roundtrip_raw,
        "roundtrip_warehouse": roundtrip_warehouse,
        "audit_log": audit_log,
        "ingest_metrics": ingest_metrics,
        "ingest_one_pass": ingest_one_pass,
    }
