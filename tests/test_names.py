import random

import pytest

from tessera.operators.containment import first_containing
from tessera.plans import names
from tessera.sources import buckets

PAIRS, TEXTS = "a string, b string", "text string, ord long"


def take(spark, root, version, pairs, texts):
    names.advance(spark.createDataFrame(pairs, PAIRS), spark.createDataFrame(texts, TEXTS), root, version, "ord")


def answers(spark, root):
    return {(r.a, r.b): r.ord for r in names.firsts(spark, root, "ord").collect()}


def test_batches_equal_a_search_over_all(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "ROWS_PER_BUCKET", 100)
    rng = random.Random(5)

    def word(least, longest):
        return "".join(rng.choice("abñ ") for _ in range(rng.randint(least, longest)))

    pairs = [(word(1, 4), word(1, 6)) for _ in range(60)] + [(None, "a"), ("a", None)]
    texts = [(word(0, 15), 100 + i) for i in range(45)] + [(None, 1)]
    # The last batch has an empty word, a text of the first with a lower order, and rows that came before.
    deals = [(pairs[:25], texts[:20]), (pairs[25:], []), ([("", "ab"), ("", ""), *pairs[:3]], [*texts[20:], (texts[0][0], 2)])]
    root, asked, held = str(tmp_path), [], []
    for version, (more, new) in enumerate(deals):
        for _ in range(2 if version == 1 else 1):  # a batch is run twice
            take(spark, root, version, more, new)
        asked, held = asked + more, held + new
        want = {}
        for a, b in asked:
            found = [n for t, n in held if t and a is not None and b is not None and a in t and b in t]
            if found:
                want[a, b] = min(found)
        assert answers(spark, root) == want
    both = first_containing(spark.createDataFrame(asked, PAIRS), spark.createDataFrame(held, TEXTS), "ord")
    assert {(r.a, r.b): r.ord for r in both.collect()} == want


def test_old_texts_are_not_searched_for_old_names(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    take(spark, root, 0, [("ann", "lee"), ("bob", "ray")], [(f"ann {k} lee", 10 + k) for k in range(50)] + [("dan fox", 9)])
    searched = []
    words_in = names.words_in

    def watched(words, texts, order, prefix_rows):
        searched.append((sorted(r.word for r in words.collect()), sorted(r.text for r in texts.collect())))
        return words_in(words, texts, order, prefix_rows)

    monkeypatch.setattr(names, "words_in", watched)
    # Known words in a new pair: the index answers. A new text meets the words that begin like one of its places.
    take(spark, root, 1, [("lee", "ann"), ("ann", "lee")], [("bob ray", 3)])
    assert searched == [(["bob", "ray"], ["bob ray"])]
    searched.clear()
    # A new name meets the texts that have its first characters.
    take(spark, root, 2, [("dan", "fox")], [])
    assert searched == [(["dan", "fox"], ["dan fox"])]
    assert answers(spark, root) == {("ann", "lee"): 10, ("lee", "ann"): 10, ("bob", "ray"): 3, ("dan", "fox"): 9}


@pytest.mark.parametrize("pairs,texts", [([], []), ([], [("ab", 1)])])
def test_empty_batches(spark, tmp_path, pairs, texts):
    take(spark, str(tmp_path), 0, pairs, texts)
    assert answers(spark, str(tmp_path)) == {}
    take(spark, str(tmp_path), 1, [("a", "b")], [("b a", 4)])
    assert buckets.versions(spark, str(tmp_path)) == [0, 1]
    assert answers(spark, str(tmp_path)) == {("a", "b"): 1 if texts else 4}
