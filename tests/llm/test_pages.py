import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import pages


def page(rng, k, layout):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."

    title, body = prose(4), [prose(rng.randint(8, 40)) for _ in range(rng.randint(2, 5))]
    nav = "<nav><ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in words[:5]) + "</ul></nav>"
    extra = f'<aside>{prose(5)}</aside><div class="cookie-notice">{prose(6)}</div><form><p>{prose(3)}</p><input></form>'
    comments = f'<div class="comments"><p>{prose(30)}</p><p>{prose(30)}</p></div>'
    paragraphs = "".join(f"<p>{p.replace(' ', rng.choice([' ', '  ', chr(10)]))}</p>" for p in body)
    if layout == 0:
        inner = f"<article><h1>{title}</h1>{paragraphs}</article>{extra}{comments}"
    elif layout == 1:
        inner = f'<div id="wrap{k}"><div class="content{k % 3}"><h1>{title}</h1>{paragraphs}</div>{comments}</div>{extra}'
    else:  # unclosed elements, a page cut off
        inner = f"<article><h1>{title}</h1>" + "".join(f"<p>{p}" for p in body)
        return f"<html><body>{nav}<div class=ad>{prose(5)}</div>{inner}", "\n".join([title, *body])
    footer = f"<footer>&copy; host &middot; {prose(6)}</footer>"
    return (
        f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var a='</p><p>x</p>';</script></head>"
        f"<body>{nav}<!-- <p>no</p> -->{inner}{footer}</body></html>", "\n".join([title, *body]),
    )


def test_whole_corpus(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for k in range(120):
        html, text = page(rng, k, k % 3)
        rows.append((k, f"https://WWW.host{k % 3}.example:8080/a/{k}?x=1", html))
        want[k] = text
    # A page of an odd make on a known host, one without the host's path, and one without any text.
    rows += [(500, "http://www.host0.example/", "<html><body><div class=main><p>Only this one here.</p></div></body></html>"),
             (501, "http://www.host0.example/", "<html><body><nav><a href=1>x</a></nav></body></html>")]
    want |= {500: "Only this one here.", 501: ""}
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("text", F.lit("x"))
    got = {r["page_id"]: r for r in pages.texts(frame).collect()}
    assert {k: r["text"] for k, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    won = {r["host"]: r["paths"] for r in pages.votes(frame).collect()}
    assert won["www.host1.example"][0] == "/html/body/div/div.content"


@pytest.mark.parametrize("html,text", [
    ("", ""), ("plain words", "plain words"), ("a < b & c &lt;p&gt; &am", "a < b & c <p> &am"),
    ("<p>one<p>two<b>bold</b>&nbsp;x<br>y", "one\ntwobold x y"), ("<div>a<div>b</div>c</div>", "a\nb\nc"),
    ("<article><header><p>By me</p><h1>T</h1></header><p>x</p></article><header>no</header>", "T\nx"),
    ("<article><p>x</p><div style='display: none'>no</div><p hidden>no</p></article>", "x"),
    ('<div class="header-layout"><article><p>kept</p></article></div>', "kept"), ("<p>x</p><script>if (a<b) {}", "x"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ('<p title="a>b">x</p></div></p>y', "x\ny"), ("<p>a</P ><P>b", "a\nb"),
])
def test_markup(html, text):
    assert pages.main_text(html, []) == text


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "http://a.example/", "<p>x</p>"), (2, "no host", "<p>" + "word " * 50000 + "</p>"),
            (3, "http://a.example/", "<p>x</p>"), (3, "http://a.example/", "<p>x</p>"), (4, "http://a.example", "<" * 20000),
            (5, "http://a.example", "<div>" * 3000 + "deep"), (6, "", "<a href='" * 3000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r["page_id"], r["url"]): r["text"] for r in pages.texts(frame).collect()}
    assert len(got) == 7 and got[(1, None)] == "" and got[(None, "http://a.example/")] == "x" == got[(3, "http://a.example/")]
    assert len(got[(2, "no host")]) == 249999 and got[(5, "http://a.example")] == "deep"
    assert pages.texts(frame.limit(0)).collect() == []


@pytest.mark.parametrize("outer,inner", [("article", "div"), ("div", "div"), ("main", "article"), ("div", "article")])
def test_title_and_lead_beside_the_body_stay(spark, outer, inner):
    nav, body = '<nav><a href="/">Home</a></nav>', "word " * 200 + "end."
    whole = f'<body>{nav}<{outer}><h1>Title</h1><p>lead</p><{inner} class="entry"><p>{body}</p></{inner}></{outer}></body>'
    bare = f'<body>{nav}<{outer}><{inner} class="entry"><p>{body}</p></{inner}></{outer}></body>'
    parts = f'<body>{nav}' + f'<div class="part"><p>{body}</p></div>' * 2 + '</body>'
    rows = [(1, "http://a.example/1", whole), (2, "http://b.example/2", whole), (7, "http://c.example/7", parts)]
    rows += [(k, f"http://b.example/{k}", bare) for k in (3, 4, 5, 6)]
    got = {r["page_id"]: r["text"] for r in pages.texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    kept = f"Title\nlead\n{body}"
    assert got == {1: kept, 2: kept, **dict.fromkeys((3, 4, 5, 6), body), 7: f"{body}\n{body}"}
