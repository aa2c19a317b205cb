import json

from tessera import schema
from tessera.plans import etl, serve
from tessera.sources import audit, messages, observations, raw, snapshots
from tests.test_streaming import START


def fragments(i, **changes):
    """The five messages of a person."""
    p = dict(
        name=f"Sra. NAME{i}.", last_name=f"Last{i}", passport=f"P{i}", email=f"e{i}", city="Roma, IT",
        telfnumber="+1 (2)", address=f"{i} Via, x", IBAN=f"I{i}", IPv4=f"10.0.0.{i}", job="J", company="Co",
        salary="1$",
    ) | changes
    p["fullname"] = f"Name{i} {p['last_name']}"
    p["sex"], p["company address"] = ["F"], "a, b"
    p["company_telfnumber"], p["company_email"] = "1", "c@d"
    parts = [{f: p[f] for f in fields} for fields in schema.FRAGMENT_FIELDS.values()]
    parts[4]["address"] = f" {i} VIA,X"
    return parts


def store_batch(spark, store, batch, docs):
    rows = [(batch * 1000 + n, START, json.dumps(d)) for n, d in enumerate(docs)]
    df = messages.decode(spark.createDataFrame(rows, messages.MESSAGE))
    raw.write_batch(messages.storable(df), f"{store}/fragments", batch)


def test_store_to_warehouse_and_back(spark, tmp_path):
    store, root = str(tmp_path / "store"), str(tmp_path / "warehouse")
    whole = [d for i in (1, 2) for d in fragments(i)]
    lost = fragments(3, email="e1")[:2] + fragments(4, last_name="Last3")[:1]
    store_batch(spark, store, 0, whole + lost + [{"strange": 1}])
    assert etl.load(spark, store, root) == 0
    tables = snapshots.read_tables(spark, root)
    persons = {r.passport: r for r in tables["persons"].collect()}
    assert set(persons) == {"P1", "P2"}
    assert (persons["P1"].first_name, persons["P1"].phone_number, persons["P1"].sex) == ("Name1", "+12", "F")
    assert {r.address for r in tables["locations"].collect()} == {" 1 VIAX", " 2 VIAX"}
    assert serve.persons_by(tables, "Roma IT", "all").count() == 2
    assert {r.missing for r in etl.read_incomplete(spark, root).collect()} == {
        "professional,bank,net", "location,professional,bank,net",
    }

    found = etl.analyse(spark, root)
    assert [(r.key, r.first_match) for r in found.matches.collect()] == [("email", "P1")]
    assert sorted((r.records, r.component) for r in found.clusters.collect()) == [(2, 10), (2, 10)]

    store_batch(spark, store, 1, fragments(3, email="e1")[2:] + [{"passport": "P1", "name": "NEW", "sex": None}]
                + [{"fullname": "Name1 Last1", "city": "New Last1"}])
    assert etl.load(spark, store, root) == 1
    tables = snapshots.read_tables(spark, root)
    persons = {r.passport: r for r in tables["persons"].collect()}
    assert set(persons) == {"P1", "P2"}
    refused = spark.read.parquet(f"{root}/rejected/version=1").collect()
    assert ("persons", "P3", "duplicate email") in {(r.target, r.passport, r.violated) for r in refused}
    took = observations.durations(spark, f"{root}/metrics").collect()
    assert [r.metric for r in took] == ["warehouse insert seconds"] * 2 and all(r.value > 0 for r in took)
    log = {r.message for r in audit.read(spark, f"{root}/log").collect()}
    assert "version 0: 2 rows, persons" in log
    assert "version 1: 1 rows, persons: duplicate email" in log


def test_filters_reach_the_files(spark, tmp_path):
    store, root = str(tmp_path / "store"), str(tmp_path / "warehouse")
    store_batch(spark, store, 0, fragments(1))
    etl.load(spark, store, root)
    answer = serve.persons_by(snapshots.read_tables(spark, root), "Rom", "J")
    plan = answer._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(city,Rom)" in plan and "StringStartsWith(job_title,J)" in plan
    assert "first_name" not in plan and "phone_number" not in plan.replace("company_phone_number", "")
    assert answer.count() == 1
