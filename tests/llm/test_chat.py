import hashlib
import random
import re
from itertools import groupby, product

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import chat

T = chat.Template()
KNOWN = {r[0]: r[1:] for r in T.roles}
SCHEMA = "conv_id long, turn long, role string, text string"


def brute_escape(text):
    for head, rest in product({m[0] for m in T.marks}, {m[1:] for m in T.marks}):
        text = re.sub(re.escape(head) + r"(\\*)" + re.escape(rest), lambda m: m[0][0] + "\\" + m[0][1:], text)
    return text


def brute(rows):
    """Of each conversation its text, the places that are learned, and the texts they hold."""
    found = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(
            ((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv),
            key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()),
        )
        text, learned = "", []
        for role, block in groupby(turns, key=lambda t: t[1]):
            name = T.other[0] + brute_escape(role) + T.other[1]
            opening, closing = KNOWN.get(role, (name, T.other[2]))
            for i, (_, _, said) in enumerate(block):
                text += T.between if i else opening
                if role in T.learned:
                    learned += range(len(text), len(text) + len(brute_escape(said)))
                text += brute_escape(said)
            text += closing
        found[conv] = text, learned, turns
    return found


def held(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    wanted = brute(rows)
    made = {r["conv_id"]: r for r in chat.read_back(chat.formatted(df)).collect()}
    digests = {r["conv_id"]: r for r in chat.digests(df).collect()}
    assert set(made) == set(digests) == set(wanted)
    for conv, (text, learned, turns) in wanted.items():
        row, digest = made[conv], digests[conv]
        assert row["formatted"] == text
        flags = [m["learned"] for m in row["mask"] for _ in range(m["chars"])]
        assert len(flags) == len(text) and [i for i, x in enumerate(flags) if x] == learned
        assert [tuple(t) for t in row["turns"]] == [t[1:] for t in turns]
        said = [t[2] for t in turns if t[1] in T.learned]
        assert row["learned"] == said
        lines = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        assert digest["n_turns"] == len(turns)
        assert digest["turns_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert digest["loss_chars"] == len("".join(said))
        assert digest["loss_sha256"] == hashlib.sha256("".join(said).encode()).hexdigest()
        assert digest["formatted_chars"] == len(text)


def test_random_conversations(spark):
    rng = random.Random(3)
    bits = [*T.marks, "<", "[", "\\", "\\\\", "s>", "INST]", "/s>", " ", "\n", "é", "😀", "word", "$1", "]"]
    roles = ["user", "assistant", "assistant", "system", "tool", "[TEXT]", "", None]
    rows = [
        (conv, turn, rng.choice(roles), rng.choice([None, "", *["".join(rng.choices(bits, k=rng.randint(1, 9)))] * 5]))
        for conv in range(60) for turn in range(rng.randint(1, 9))
    ]
    held(spark, rows)


def test_odd_rows(spark):
    marks = "</s>[INST] ok [/INST]"
    rows = [
        (-1, 0, "user", marks), (-1, 1, "assistant", marks),
        (None, 0, "assistant", "no id"), (None, None, "user", "no turn"),
        (1, 2, "user", "tie b"), (1, 2, "user", "tie a"), (1, 2, "assistant", "tie"), (1, 2, "assistant", "tie"),
        (2, 0, "assistant", "long " * 400_000), (2, 1, "assistant", "x<\\\\s>" * 1000),
        (3, 0, None, None),
    ] + [(4, i, "assistant", f"{i}") for i in range(3000)]
    held(spark, rows)


def test_empty_and_clashing_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert chat.digests(none).count() == 0
    clash = spark.createDataFrame([(1, 0, "user", "hi")], SCHEMA)
    for name in ("one", "turns", "blocks", "parts", "formatted", "mask", "learned", "chars", "mark"):
        clash = clash.withColumn(name, F.lit(7))
    assert chat.digests(clash).first()["n_turns"] == 1


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi")], SCHEMA)
    plan = chat.digests(df)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@given(st.text(alphabet="<[\\/s>INST]a", max_size=30))
def test_escape_can_be_undone_and_hides_marks(text):
    head, rest = T.inner
    made = re.sub(rf"{head}(\\*){rest}", r"\1\\\2\3", text)
    assert not any(m in made for m in T.marks)
    assert re.sub(rf"{head}\\(\\*){rest}", r"\1\2\3", made) == text


def test_templates_are_checked():
    with pytest.raises(ValueError):
        chat.Template(between="[A[B]")
