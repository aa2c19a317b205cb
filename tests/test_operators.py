import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import constraints, dedup, keyed, merge, metrics
from tessera.operators.components import components, value_links
from tessera.operators.containment import first_containing
from tessera.operators.dedup import ttl_dedup
from tessera.operators.melt import melt


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), (None, 0)], "k string, ord long")
    first = keyed.first_per_key(df, ["k"], [F.asc("ord")])
    assert sorted(tuple(r) for r in first.collect()) == [("a", 1), ("b", 2)]
    assert keyed.first_per_key(df, ["k"], [F.asc("ord")], n=2).count() == 3


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = keyed.first_per_key(df, ["k"], [F.asc("id")])._jdf.queryExecution().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


@pytest.mark.parametrize("top", [1000, 1 << 62])
def test_numbered(spark, top):
    orders = random.Random(1).sample(range(-50, top), 200)
    df = spark.createDataFrame([(o,) for o in orders], "ord long")
    rows = keyed.numbered(df, "ord", "id", start=10).collect()
    assert [r.id for r in sorted(rows, key=lambda r: r.ord)] == list(range(11, 211))


@pytest.mark.parametrize("prefix_rows", [0, 3, 1000])
def test_first_containing_equals_search(spark, prefix_rows):
    rng = random.Random(prefix_rows)

    def word(longest):
        return "".join(rng.choice("abñ ") for _ in range(rng.randint(0, longest)))

    texts = [(word(25), i) for i in range(120)] + [("aaaa", 500), ("aaaa", 400)]
    pairs = [(word(4), word(9)) for _ in range(150)] + [("", ""), ("aaaa", "aa"), ("zz", "a")]
    wanted = {
        (a, b): min((i for t, i in texts if t and a in t and b in t), default=None)
        for a, b in pairs
    }
    found = first_containing(
        spark.createDataFrame(pairs, "a string, b string"),
        spark.createDataFrame(texts, "text string, ord long"),
        "ord", prefix_rows,
    )
    found = {(r.a, r.b): r.ord for r in found.collect()}
    assert {p: found.get(p) for p in wanted} == wanted


def brute_components(n, edges):
    label = list(range(n))
    for _ in range(n):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.mark.parametrize("shape", ["random", "chain", "hub", "none"])
def test_components(spark, shape):
    n = 60
    rng = random.Random(3)
    edges = {
        "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(40)],
        "chain": [(i, i + 1) for i in rng.sample(range(n - 1), n - 5)],
        "hub": [(30, i) for i in range(n)],
        "none": [],
    }[shape]
    pairs = [(max(e), min(e)) for e in edges if e[0] != e[1]]
    found = components(
        spark.range(n).withColumnRenamed("id", "node"), "node",
        spark.createDataFrame(pairs, "child long, parent long"),
    )
    assert {r.node: r.component for r in found.collect()} == dict(enumerate(brute_components(n, edges)))


def test_value_links_are_linear(spark):
    df = spark.createDataFrame([(i, "same") for i in range(50)], "id long, name string")
    links = value_links(melt(df, "id", ["name"]), "id", ["key", "value"])
    assert sorted((r.child, r.parent) for r in links.collect()) == [(i, 0) for i in range(1, 50)]


def fold(rows, ttl):
    taken, last = [], {}
    for key, at, order in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in last or at - last[key] >= ttl:
            taken.append(order)
            last[key] = at
    return sorted(taken)


def hours(spark, rows):
    df = spark.createDataFrame(rows, "k string, hour double, ord long")
    return df.withColumn("ts", F.timestamp_micros((F.col("hour") * 3_600_000_000).cast("long")))


def test_ttl_dedup_equals_fold(spark):
    rng = random.Random(5)
    rows = [("hot", rng.randrange(600), i) for i in range(150)]
    rows += [(f"k{i % 20}", rng.randrange(300), 1000 + i) for i in range(100)]
    rows += [("gap", h, 5000 + h) for h in (0, 20, 24, 30, 50, 500)]
    rows = [(k, float(h), i) for k, h, i in rows]
    rows += [(None, float(rng.randrange(900)), 9000 + i) for i in range(200)]
    given = hours(spark, rows + [("k1", None, 9999)])
    for hot in (10**6, 100, 0):
        got = ttl_dedup(given, ["k"], "ts", "ord", hot_moments=hot)
        assert sorted(r.ord for r in got.collect()) == fold(rows, 24)
    assert [(r.ord, r.reason) for r in dedup.untimed(given, "ts").collect()] == [(9999, "no time")]


def test_hot_key_is_split_by_time(spark):
    rng = random.Random(6)
    rows = [(None, float(rng.randrange(-2400, 2400)), i) for i in range(3000)]
    moments = hours(spark, rows).select(
        F.lit("null").alias("__key"), F.unix_micros("ts").alias("__at"), F.col("ord").alias("__order")
    ).dropDuplicates(["__at"])
    following = dedup._following(moments, 24 * 3_600_000_000)
    times = sorted({int(h) for _, h, _ in rows})
    wanted = {h: min((x for x in times if x >= h + 24), default=None) for h in times}
    hour = 3_600_000_000
    assert {r["__at"] // hour: None if r.next is None else r.next // hour for r in following.collect()} == wanted
    # What brings rows of a key together does so per slice; only the table of slices is dealt by the key alone.
    plan = dedup._following(moments, 24 * hour)._jdf.queryExecution().executedPlan().toString()
    alone = [x for x in plan.splitlines() if "hashpartitioning(__key" in x and "slice" not in x]
    assert len(alone) == 1 and plan.count("hashpartitioning(__key") > 2


def test_ttl_dedup_example(spark):
    rows = [("k", float(h), h) for h in (0, 20, 24, 30, 50)]
    got = ttl_dedup(hours(spark, rows), ["k"], "ts", "ord")
    assert sorted(r.ord for r in got.collect()) == [0, 24, 50]


def test_merge_fields_null_and_absent(spark):
    rows = [
        ("P1", "M", "a", 1, ["passport", "sex", "email"]),
        ("P1", None, None, 2, ["passport", "sex"]),
        ("P2", "F", None, 3, ["passport", "sex"]),
    ]
    df = spark.createDataFrame(
        rows, "passport string, sex string, email string, ord long, present array<string>"
    )
    has = {f: F.array_contains("present", f) for f in ("passport", "sex", "email")}
    got = merge.merge_fields(df, ["passport"], ["passport", "sex", "email"], "ord", has)
    assert sorted(tuple(r) for r in got.collect()) == [
        ("P1", 1, 2, None, "a"), ("P2", 3, 3, "F", None),
    ]
    again = merge.merge_fields(df.union(df), ["passport"], ["passport", "sex", "email"], "ord", has)
    assert sorted(got.collect()) == sorted(again.collect())


def test_upsert_rows_replaces_with_nulls(spark):
    old = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string")
    new = spark.createDataFrame([("a", "1", 1), ("a", None, 2), ("c", "z", 3)], "k string, v string, ord long")
    new = merge.last_rows(new, ["k"], "ord").drop("ord")
    assert sorted(merge.upsert_rows(old, new, ["k"]).collect()) == [
        ("a", None), ("b", "y"), ("c", "z"),
    ]


def test_unique_rejected_rows_hold_nothing(spark):
    rows = [(1, "p1", "e", ["bad"]), (2, "p2", "e", []), (3, "p3", "e", []), (4, "p4", "f", [])]
    df = spark.createDataFrame(rows, "ord long, owner string, email string, violated array<string>")
    old = spark.createDataFrame([("p9", "f")], "owner string, email string")
    got = constraints.check_unique(df, "email", "owner", "ord", old)
    assert {r.ord: r.violated for r in got.collect()} == {
        1: ["bad"], 2: [], 3: ["duplicate email"], 4: ["duplicate email"],
    }


def test_histogram_and_summary(spark):
    df = spark.createDataFrame([("a", 0.005), ("a", 0.2), ("a", 99.0), ("b", 1.0)], "m string, v double")
    buckets = {(r.m, r.le): r.bucket for r in metrics.histogram(df, "m", "v").collect()}
    assert buckets["a", "0.005"] == 1 and buckets["a", "0.25"] == 2 and buckets["a", "10.0"] == 2
    assert buckets["a", "+Inf"] == 3 and buckets["b", "1.0"] == 1 and len(buckets) == 30
    totals = {r.m: (r.observations, float(r.total)) for r in metrics.summary(df, "m", "v").collect()}
    assert totals == {"a": (3, 99.205), "b": (1, 1.0)}


def test_observed_counts_on_the_way(spark):
    from pyspark.sql import Observation

    watch = Observation("step")
    df = spark.range(10).observe(watch, F.count(F.lit(1)).alias("total"))
    metrics.observed(df, "named", F.col("id") > 7).write.format("noop").mode("overwrite").save()
    assert watch.get == {"total": 10}
