import corpus_pipeline as P
from pyspark.sql import functions as F

from tessera.llm import decontaminate, pii, quality, sentencepiece, simhash
from tests.llm.test_quality import brute as judged
from tests.llm.test_simhash import brute_components, brute_fingerprint

PROSE = "the fox{0} of that house{0} and lazydog{0}"


def rows():
    body = [" ".join(PROSE.format(f"{k}x{i}") for i in range(16)) for k in range(12)]
    item = "A benchmark question about the number of apples that Bob keeps after giving five of them away."
    found = [(k, t) for k, t in enumerate(body)]
    found += [(100, body[0]), (101, body[1].upper().lower() + " "), (102, body[2] + " " + item), (103, None), (104, ""),
              (105, "short"), (106, body[3].replace(" ", "#")), (107, body[4] + " mail me at ann@mail.example.com now"),
              (None, body[5]), (108, body[6] + " " + body[7]), (108, body[6] + " " + body[7])]
    return found, [(1, item), (2, None)]


def brute(docs, items):
    docs = [(d, t) for d, t in docs if judged(t)["kept"]]
    root = brute_components([brute_fingerprint(t) for _, t in docs], 4)
    least = {}
    for (d, t), r in zip(docs, root, strict=True):
        least[r] = min(least.get(r, (d is None, d, t)), (d is None, d, t), key=lambda x: x[:1] + (x[1] or 0,))
    docs = [(d, t) for _, d, t in least.values()]
    index = decontaminate.Index([(t or "").encode() for _, t in items])
    docs = [(d, t) for d, t in docs if not list(decontaminate.scanned(index, [t.encode()]))]
    encoder = sentencepiece.Encoder(sentencepiece.vocabulary())
    return [(d, encoder.encode(pii.mask(t, pii.base_spans(t)))) for d, t in docs]


def test_each_stage_and_the_whole(spark, tmp_path):
    docs, items = rows()
    frame = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in docs],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    frame.withColumn("fp", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = P.run(spark, str(tmp_path)).collect()
    want = brute(docs, items)
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=str) == sorted(want, key=str)
    assert 8 <= len(want) < len(docs)
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)
    now = frame
    for _, stage in P.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == frame.columns
    assert all(r["n_chars"] == len(r["text"]) for r in now.collect())
    nothing = frame.limit(0)
    for _, stage in P.STAGES:
        nothing = stage(spark, nothing, str(tmp_path))
    assert nothing.collect() == []
    assert [len(P.STAGES), quality.RULES[0].name, simhash.SEED] == [5, "length", 42]
