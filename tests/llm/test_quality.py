import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)}
    n = len(w)
    found = {
        "n_words": n, "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "n_stop_words": sum(x in quality.STOP_WORDS for x in w), "n_lines": len(lines),
    }
    base = n < 50 or 100 * len(covered) > 50 * n
    good = all(
        (r.low is None or found[r.part] * 100 >= found.get(r.whole, 1) * r.low)
        and (r.high is None or found[r.part] * 100 <= found.get(r.whole, 1) * r.high)
        for r in quality.RULES
    )
    return found | {"base_failed": base, "kept": not base and good}


PROSE = " ".join(f"the word{i} and of thing{i % 7}x{i}" for i in range(30))
TEXTS = [
    None, "", " \n\t ", "one", "a b a b a b a b", "été \U0001f600 a\x0bb\x0cc\rd", PROSE, PROSE + " " + PROSE, PROSE + " #" * 40,
    "\n".join(["the same line of words"] * 30), PROSE.replace(" ", "\n"), "x " * 3000, PROSE.upper(), "lorem " + PROSE * 40,
    " ".join(["the"] * 60), "a b c a b c d a b c",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i else None, t, i) for i, t in enumerate(TEXTS)] + [(6, PROSE, 6)]
    return spark.createDataFrame(rows, "doc_id long, text string, n int").withColumn("kept", F.lit("clash"))


def test_counts_and_verdicts(docs):
    for row in quality.judged(docs).collect():
        want = brute(TEXTS[row["n"]])
        assert {k: row[k] for k in want} == want, row["n"]
        assert row["kept"] == (not row["base_failed"] and not row["broken"])


def test_passing_keeps_rows_as_they_are(docs):
    got = quality.passing(docs)
    assert got.columns == docs.columns
    want = [i for i, t in enumerate(TEXTS) if brute(t)["kept"]]
    assert sorted(r["n"] for r in got.collect()) == sorted([*want, 6]) and 6 in want
    assert {r["kept"] for r in got.collect()} == {"clash"}


def test_empty_table(docs):
    assert quality.judged(docs.limit(0)).collect() == [] == quality.passing(docs.limit(0)).collect()


def test_no_python_in_the_plan(docs):
    plan = quality.judged(docs.select("doc_id", "text").where("doc_id > 0"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "PythonUDF"))


def test_long_clean_documents_are_kept(spark):
    text = "\n".join(f"the word{i} and of thing{i}" for i in range(21_000))
    long = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [tuple(r) for r in quality.judged(long).select("n_words", "broken", "kept").collect()] == [(105_000, [], True)]
    assert quality.passing(long).count() == 1
