import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.cleaning import clean
from tessera.plans import fuse, resolve, serve, warehouse
from tessera.sources import snapshots

PERSONAL = "ord long, passport string, name string, last_name string, sex string, telfnumber string, email string"
LOCATION = "ord long, fullname string, city string, address string"
PROFESSIONAL = (
    "ord long, fullname string, company string, company_address string,"
    " company_telfnumber string, company_email string, job string"
)
BANK = "ord long, passport string, IBAN string, salary string"
NET = "ord long, address string, IPv4 string"


def random_fragments(seed, n=60):
    """Fragments with few distinct values, so that every join has misses, ties and hot keys."""
    rng = random.Random(seed)
    names, lasts = ["Ana", "An", "José", "", None], ["Li", "Lima", " ", "García", ""]

    def pick(values):
        return rng.choice(values)

    fulls = [f"{a} {b}{c}" for a in ("Ana", "JOSÉ", "Anabel") for b in ("Li", "Lima", "García") for c in ("", "x")]
    places = ["1 Calle", "1 CALLE ", "2 via", "", None, "3"]
    return {
        "personal": [
            (i, f"P{i}", pick(names), pick(lasts), "F", str(i), f"e{i % 40}") for i in range(n)
        ],
        "location": [(i, pick(fulls + [None, ""]), "C", pick(places)) for i in range(n)],
        "professional": [
            (i, pick(fulls + [None]), f"c{i}", None, None, None, "job") for i in range(n // 4)
        ],
        "bank": [(i, f"P{rng.randrange(n)}" if i % 9 else None, f"I{i}", "1$") for i in range(n)],
        "net": [(i, pick(places), f"10.0.0.{i}") for i in range(n // 6)],
    }


DDL = dict(personal=PERSONAL, location=LOCATION, professional=PROFESSIONAL, bank=BANK, net=NET)


def frames(spark, rows):
    return {t: spark.createDataFrame(rows[t], DDL[t]) for t in DDL}


def first(rows, test):
    return next((r for r in rows if test(r)), None)


def searched(rows):
    """What a search through the lists in order finds: per person the fragments or None."""
    found = {}
    for p in rows["personal"]:
        name, last = (p[2] or ""), (p[3] or "")
        loc = first(
            rows["location"],
            lambda r: name and last and r[1] and name.lower().strip() in r[1].lower()
            and last.lower().strip() in r[1].lower(),
        )
        pro = loc and first(rows["professional"], lambda r: r[1] == loc[1])
        bnk = first(rows["bank"], lambda r: r[1] == p[1])
        net = loc and first(
            rows["net"],
            lambda r: r[1] and loc[3]
            and r[1].lower().replace(" ", "") == loc[3].lower().replace(" ", ""),
        )
        found[p[0]] = (loc, pro, bnk, net)
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_fuse_equals_search(spark, seed):
    rows = random_fragments(seed)
    wanted = searched(rows)
    parts = frames(spark, rows)
    fused = {r.ord: r for r in fuse.fuse_persons(**parts).collect()}
    assert set(fused) == {o for o, f in wanted.items() if all(f)}
    assert fused
    for o, r in fused.items():
        loc, pro, bnk, net = wanted[o]
        assert (r.fullname, r.city, r.address) == (loc[1], loc[2], net[1])
        assert (r.company, r.IBAN, r.IPv4) == (pro[2], bnk[2], net[2])
    incomplete = {r.ord: r.missing for r in fuse.incomplete_persons(**parts).collect()}
    assert incomplete == {
        o: ",".join(k for k, x in zip(fuse.FRAGMENTS, f) if not x)
        for o, f in wanted.items() if not all(f)
    }


def fused_rows(spark, *changes):
    base = dict(
        ord=0, passport="P", name="Ana", last_name="Li", sex="F", telfnumber="1", email="e",
        fullname="Ana Li", city="C", address="A", company="co", company_address=None,
        company_telfnumber=None, company_email=None, job="J", IBAN="I", salary="1$", IPv4="10.0.0.1",
    )
    ddl = ", ".join(f"{c} {'long' if c == 'ord' else 'string'}" for c in fuse.FUSED)
    rows = [tuple({**base, **c}[k] for k in fuse.FUSED) for c in changes]
    return spark.createDataFrame(rows, ddl)


def person(i, **changes):
    return dict(
        ord=i, passport=f"P{i}", email=f"e{i}", IBAN=f"I{i}", IPv4=f"10.0.0.{i}"
    ) | changes


def rejected(load):
    return sorted((r.target, r.passport, r.violated) for r in load.rejected.collect())


def test_load_rejects_and_cascades(spark):
    load = warehouse.load_warehouse(
        fused_rows(
            spark,
            person(1),
            person(2, email="e1"),
            person(3, name=""),
            person(4, IBAN="I1", sex="x" * 11),
            person(5, IBAN="I2", IPv4="10.0.0.999"),
            person(6, IBAN="I2", city="c" * 101),
            person(7, address="", company=None),
        )
    )
    tables = {t: df.collect() for t, df in load.tables.items()}
    assert [r.passport for r in sorted(tables["persons"])] == ["P1", "P5", "P6", "P7"]
    assert [tuple(r) for r in tables["locations"]] == [(1, "A", "C")]
    places = {r.passport: r.location_id_fk for r in tables["persons"]}
    assert places == {"P1": 1, "P5": 1, "P6": None, "P7": None}
    assert sorted((r.bank_id, r.passport_fk, r.iban) for r in tables["bank_data"]) == [
        (1, "P1", "I1"), (2, "P5", "I2"), (3, "P7", "I7"),
    ]
    assert sorted(r.passport_fk for r in tables["network_data"]) == ["P1", "P6", "P7"]
    assert sorted(r.passport_fk for r in tables["professional_data"]) == ["P1", "P5", "P6"]
    children = ("bank_data", "network_data", "professional_data")
    assert rejected(load) == sorted(
        [("persons", "P2", "duplicate email"), ("persons", "P3", "missing first_name"),
         ("persons", "P4", "long sex"), ("locations", "P6", "long city")]
        + [(t, p, "unknown person") for t in children for p in ("P2", "P3", "P4")]
        + [("network_data", "P5", "invalid ip_address"), ("bank_data", "P6", "duplicate iban"),
           ("professional_data", "P7", "missing company_name")]
    )


def test_second_load_keeps_ids_and_holders(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    one = warehouse.load_warehouse(fused_rows(spark, person(1), person(2, address="B")))
    assert snapshots.read_tables(spark, root) == {}
    assert snapshots.write_tables(one.tables, root) == 0
    two = warehouse.load_warehouse(
        fused_rows(
            spark,
            person(1, telfnumber=None, address="N"),
            person(3, email="e2"),
            person(4, IBAN="I2"),
            person(2, ord=9, address="B", salary="2$"),
        ),
        snapshots.read_tables(spark, root),
    )
    assert snapshots.write_tables(two.tables, root) == 1
    tables = {t: sorted(map(tuple, df.collect())) for t, df in snapshots.read_tables(spark, root).items()}
    assert tables["locations"] == [(1, "A", "C"), (2, "B", "C"), (3, "N", "C")]
    assert [(r[0], r[4], r[6]) for r in tables["persons"]] == [("P1", None, 3), ("P2", "1", 2), ("P4", "1", 1)]
    assert tables["bank_data"] == [(1, "P1", "I1", "1$"), (2, "P2", "I2", "2$")]
    assert [r[:2] for r in tables["network_data"]] == [(1, "P1"), (2, "P2"), (3, "P4")]
    assert ("persons", "P3", "duplicate email") in rejected(two)
    assert ("bank_data", "P4", "duplicate iban") in rejected(two)


def test_uncommitted_version_is_ignored(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    load = warehouse.load_warehouse(fused_rows(spark, person(1)))
    snapshots.write_tables(load.tables, root)
    load.tables["persons"].write.parquet(f"{root}/version=1/persons")
    assert snapshots.latest_version(spark, root) == 0


def test_serve_drops_identifiers_and_filters(spark):
    load = warehouse.load_warehouse(
        fused_rows(
            spark,
            person(1, city="Madrid", job="Engineer"),
            person(2, city="Madrid Sur", job="engineer"),
            person(3, city="Roma", job="Eng", company=None),
        )
    )
    assert serve.persons_by(load.tables).columns == serve.PERSON_VIEW
    assert serve.persons_by(load.tables, "ALL", "all").count() == 3
    assert serve.persons_by(load.tables, "Madrid", "all").count() == 2
    assert [r.iban for r in serve.persons_by(load.tables, "Mad", "Eng").collect()] == ["I1"]
    assert serve.persons_by(load.tables, "all", "Eng").count() == 1
    assert [r[0] for r in serve.facet(load.tables["locations"], "city").collect()] == [
        "Madrid", "Madrid Sur", "Roma",
    ]
    rows = [json.loads(r.json) for r in serve.pruned_json(serve.persons_by(load.tables, "Roma")).collect()]
    assert set(rows[0]) == {
        "sex", "address", "city", "bank_id", "iban", "salary", "network_id", "ip_address",
    }


def test_pruned_json_drops_empty_objects(spark):
    df = spark.createDataFrame(
        [((None, (None,)), 1, None), (("x", (None,)), None, "z")],
        "o struct<a: string, p: struct<b: string>>, n int, s string",
    )
    assert [json.loads(r.json) for r in serve.pruned_json(df).collect()] == [
        {"n": 1}, {"o": {"a": "x"}, "s": "z"},
    ]


RECORD = "record_id long, " + ", ".join(
    f"{f} string" for f in ("passport", "email", "name", "last_name", "address", "fullname", "job")
)
FIELDS = ["passport", "email", "name", "last_name", "address", "fullname", "job"]


def records(spark, *rows):
    return spark.createDataFrame(
        [(i, *[r.get(f) for f in FIELDS]) for i, r in enumerate(rows)], RECORD
    )


def merged(spark, *rows, **options):
    got = resolve.group_records(records(spark, *rows), "record_id", FIELDS, **options).collect()
    return sorted(
        [{f: r[f] for f in FIELDS if r[f] is not None} for r in got], key=lambda r: sorted(r.items())
    )


def test_group_new_record(spark):
    assert len(merged(spark, {"passport": "P123", "name": "Nuevo Usuario"})) == 1


def test_group_merge_by_email(spark):
    rows = [{"email": "test@example.com", "name": "Inicial"}, {"email": "test@example.com", "passport": "ABC"}]
    assert merged(spark, *rows) == [{"email": "test@example.com", "name": "Inicial", "passport": "ABC"}]


def test_group_bridge(spark):
    rows = [
        {"passport": "P1", "name": "Persona A"},
        {"email": "a@b.com", "address": "Calle Falsa"},
        {"passport": "P1", "email": "a@b.com", "job": "Engineer"},
    ]
    assert merged(spark, *rows) == [
        {"passport": "P1", "name": "Persona A", "email": "a@b.com", "address": "Calle Falsa", "job": "Engineer"}
    ]


def test_link_modes(spark):
    rows = [{"name": "Ana"}, {"last_name": "Ana"}, {"name": ""}, {"last_name": ""}]
    assert len(merged(spark, *rows)) == 4
    assert len(merged(spark, *rows, link_mode="value")) == 3


def test_clusters_report(spark):
    df = records(spark, {"email": "x"}, {"email": "x", "address": "y"}, {"address": "y"}, {"name": "d"})
    report = resolve.cluster_report(resolve.clusters(df, "record_id"))
    assert sorted((r.record_id, r.component, r.records) for r in report.collect()) == [
        (0, 0, 3), (1, 0, 3), (2, 0, 3),
    ]


def test_any_key_matches_count_hot_values(spark):
    mine = records(spark, *[{"last_name": "Li", "email": f"e{i}"} for i in range(5)])
    theirs = records(spark, {"last_name": "Li"}, {"last_name": "Li", "email": "e3"}, {"name": "Li"})
    got = resolve.any_key_matches(mine, "record_id", theirs, "record_id")
    assert sorted((r.record_id, r.key, r.matches, r.first_match) for r in got.collect()) == [
        (0, "last_name", 2, 0), (1, "last_name", 2, 0), (2, "last_name", 2, 0),
        (3, "email", 1, 1), (3, "last_name", 2, 0), (4, "last_name", 2, 0),
    ]


def test_passport_lookup_skips_itself(spark):
    df = records(
        spark,
        {"fullname": "A", "passport": "P0"}, {"fullname": "A", "address": "X", "passport": ""},
        {"fullname": "A", "passport": "P2"}, {"address": "X", "passport": "P3"}, {"fullname": "B", "passport": "P4"},
    )
    got = resolve.passport_by_name_or_address(df, "record_id")
    assert {r.record_id: r.passport for r in got.collect()} == {0: "P2", 1: "P0", 2: "P0", 3: None, 4: None}


def test_person_by_priority(spark):
    people = records(spark, {"email": "e"}, {"name": "Ana"}, {"last_name": "Ana"})
    asked = records(spark, {"name": "Ana", "email": "e"}, {"name": "Ana"}, {"name": "Eva"})
    got = resolve.person_by_priority(asked, "record_id", people, "record_id")
    assert sorted((r.record_id, r.person, r.found_by) for r in got.collect()) == [
        (0, 0, "email"), (1, 2, "name"),
    ]


def test_location_lookup(spark):
    places = spark.createDataFrame([(7, "A", "C")], "location_id long, address string, city string")
    asked = spark.createDataFrame([(1, "A", "C"), (2, "A", ""), (3, None, "C")], "id long, address string, city string")
    got = resolve.location_id_by_address_city(asked, "id", places)
    assert {r.id: r.location_id for r in got.collect()} == {1: 7, 2: None, 3: None}


def test_hot_keys_are_split(spark):
    """Two thirds of the persons share names, and so a location: their join runs in many tasks."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(0, 30_000, 1, 8).withColumnRenamed("id", "ord")
        last = F.when(F.col("ord") % 3 > 0, "Hot").otherwise(F.concat(F.lit("Ln"), "ord"))
        personal = ids.select(
            "ord", F.concat(F.lit("P"), "ord").alias("passport"), F.lit("Ana").alias("name"),
            last.alias("last_name"), F.lit("F").alias("sex"), F.lit("1").alias("telfnumber"),
            F.sha2(F.col("ord").cast("string"), 256).alias("email"),
        )
        location = ids.where("ord < 40").select(
            "ord", F.concat(F.lit("Ana "), last).alias("fullname"), F.lit("C").alias("city"),
            F.lit("A").alias("address"),
        )
        professional = location.select(
            "ord", "fullname",
            *[F.lit("x").alias(c) for c in
              ("company", "company_address", "company_telfnumber", "company_email", "job")],
        )
        bank = personal.select("ord", "passport", F.lit("I").alias("IBAN"), F.lit("1").alias("salary"))
        net = location.select("ord", "address", F.lit("10.0.0.1").alias("IPv4")).limit(5)
        fused = fuse.fuse_persons(clean(personal), location, professional, bank, net)
        rows = fused.toPandas()
        assert len(rows) == 20_000 + 14
        plan = fused._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.split("\n") if "SortMergeJoin" in line]
        assert sum("skew=true" in line for line in joins) >= 2, plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
