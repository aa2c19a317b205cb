import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import pii

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def right(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == 1:
        return all(int(p) <= 255 for p in text.split("."))
    if kind == 2:
        doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def brute(text):
    return sorted(
        (m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if right(k, m[0])
    )


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(
    ["a", "é", "@", ".", "-", " ", "+", "1", "23", "255", "256", "0", "(", ")", "4111 1111 1111 1111", "4111111111111111",
     "a.b@c.de", "+1 (017) 555-7713", "10.0.0.1", "\n", "_", "x9", "00000000001"]), max_size=14).map("".join))
def test_base_spans_match_the_patterns(text):
    assert [tuple(s) for s in pii.base_spans(text)] == brute(text)


def test_long_texts_stay_linear():
    for text in ["1" * 60000, "+1 " * 30000, "a@" * 40000, "9-" * 50000, "token=" * 20000, "(1) " * 30000]:
        assert pii.spans(text, pii.trained([]))[0] == [pii.Span(*s) for s in brute(text)]


def test_long_runs_of_digits_beside_points_stay_linear():
    long = "1" * 400_000
    assert pii.base_spans(long + " 1.2.3") == []
    assert pii.base_spans("1.2.3." + long) == []
    assert pii.base_spans((long + ".") * 3) == []
    assert [(s.start, s.end) for s in pii.base_spans(long + " 10.0.0.1")] == [(400_001, 400_009)]
    assert [tuple(s) for s in pii.base_spans("1.2.3.4.5.6.7.8.999.1.1.1.1")] == brute("1.2.3.4.5.6.7.8.999.1.1.1.1")


def test_labelers_are_weighed_and_candidates_added(spark):
    rows = []
    for k in range(60):
        rows.append((k, f"call tel +1 (017) 555-{k:04d} or mail u{k}@mail.example.com now"))
        rows.append((1000 + k, f'here token = "{hashlib.sha1(str(k).encode()).hexdigest()}" and more'))
        rows.append((2000 + k, f"his card {4000000000000000 + k * 7919} is known"))
        rows.append((3000 + k, f"version 11-22-3{k:03d} of page 12-13-{k:04d} holds"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.detected(docs).collect()}
    for k, text in rows:
        base = brute(text)
        assert got[k]["base_sha256"] == hashlib.sha256(pii.listed([pii.Span(*s) for s in base]).encode()).hexdigest()
        assert [got[k][f"n_{n}"] for n in pii.BASE_KINDS] == [sum(s[1] == i for s in base) for i in range(4)]
        assert all(x in got[k]["spans"].split(",") for x in pii.listed([pii.Span(*s) for s in base]).split(",") if x)
    assert all("secret" in got[1000 + k]["spans"] for k in range(60))
    assert not any(got[3000 + k]["spans"] for k in range(60))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a@b.cd"), (4, "x " * 50000 + "10.1.2.3"), (4, "x " * 50000 + "10.1.2.3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("clash")).withColumn("n_ip", F.lit(1))
    got = sorted(((r["doc_id"], r["n_email"], r["n_ip"], r["spans"]) for r in pii.detected(docs).collect()), key=str)
    ip = "ip:100000:100008"
    assert got == sorted([(1, 0, 0, ""), (2, 0, 0, ""), (None, 1, 0, "email:0:6"), (4, 0, 1, ip), (4, 0, 1, ip)], key=str)
    masked = pii.masked(docs)
    assert masked.columns == docs.columns
    assert sorted((r["text"] or "")[-8:] for r in masked.collect()) == sorted(["", "", "<EMAIL>", "x x <IP>", "x x <IP>"])
    assert pii.detected(docs.limit(0)).collect() == []
    assert pii.mask("ab cd", [pii.Span(0, 0, 2), pii.Span(1, 2, 4)]) == "<EMAIL>d"


def test_long_secrets_are_masked_whole(spark):
    long = "".join(hashlib.sha256(str(k).encode()).hexdigest() for k in range(60))
    rows = [(k, f"here token = {hashlib.sha1(str(k).encode()).hexdigest()} and more") for k in range(60)]
    docs = spark.createDataFrame([*rows, (99, f"here token = {long} and more")], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.detected(docs).collect()}
    assert got[99] == f"secret:13:{13 + len(long)}"
    assert pii.masked(docs).where("doc_id = 99").first()["text"] == "here token = <SECRET> and more"
