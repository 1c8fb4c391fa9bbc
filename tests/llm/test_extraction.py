import random

from pyspark.sql import functions as F

from answerloom.llm.crf import train
from answerloom.llm.extraction import extract_pages, labelled_page, main_text, train_extractor
from answerloom.llm.pages import features, leaf_blocks

PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy &amp; save now.</div>
<article><h1>Title {0}</h1><p><b>First&nbsp;part,
 of {0} &lt;tag&gt;.<br><p>Second part of {0}.</p><p>Yes.</p></article>
<section class="comments"><p>I liked it, said a reader.</p></section><footer>&copy; someone</footer></body></html>"""


def pages(n=60):
    return [PAGE.format(f"number {i} " + "and more words " * (i % 9)) for i in range(n)]


def expected(i):
    own = " ".join((f"number {i} " + "and more words " * (i % 9)).split())
    return f"Title {own}\nFirst part, of {own} <tag>.\nSecond part of {own} .\nYes.".replace(" .\nYes", " .\nYes")


def test_extraction_and_edges(spark, clashing):
    rows = [(i, f"u{i}", p) for i, p in enumerate(pages())]
    rows += [(100, None, None), (101, "e", ""), (102, "t", "just text, no markup"), (103, "c", pages()[1]),
             (104, "cut", pages()[2][:400]), (None, "x", "<p>" + "word " * 60_000), (105, "<", "<<<>>><p <b")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns(
        {c: F.lit(c) for c in [*clashing, "text"]}
    )
    out = extract_pages(df)
    assert out.columns[-1] == "_text" and out.count() == len(rows)
    got = {r["page_id"]: r["_text"] for r in out.collect()}
    for i in range(60):
        assert got[i].replace(" .", ".") == expected(i).replace(" .", "."), i
    assert got[100] == got[101] == "" and got[103] == got[1]
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert extract_pages(empty).collect() == []


def test_held_out_boilerplate():
    model = train_extractor(pages(40))
    rng = random.Random(9)
    wrong = total = 0
    for page in pages(200)[100:]:
        blocks = leaf_blocks(labelled_page(page, rng), True)
        found = model.viterbi(features(blocks))
        wrong += sum(a != (b.label or 0) for a, b in zip(found, blocks, strict=True))
        total += len(blocks)
    assert wrong <= 0.03 * total
    assert main_text("", model) == ""


def test_viterbi_is_the_best_path():
    rng = random.Random(2)
    names = [f"f{i}" for i in range(6)]
    data = [[rng.sample(names, 2) for _ in range(rng.randint(1, 6))] for _ in range(30)]
    marks = [[int("f0" in x) for x in s] for s in data]
    model = train(data, marks, epochs=5)

    def score(s, y):
        e = sum(model.weights.get(f, (0, 0))[k] for x, k in zip(s, y) for f in x)
        return e + sum(model.steps[a][b] for a, b in zip(y, y[1:]))

    for s in data:
        paths = [[b >> i & 1 for i in range(len(s))] for b in range(2 ** len(s))]
        assert abs(score(s, model.viterbi(s)) - max(score(s, y) for y in paths)) < 1e-9
    hits = sum(model.viterbi(s) == y for s, y in zip(data, marks))
    assert hits >= 28


def test_attributes_and_broken_heads():
    """Attributes of the page's own never stop the parser; text after an unclosed head is text."""
    cell = leaf_blocks("<table><td data-label=\"Price\">12</td><td data-crf-label='x'>a</td></table>")
    assert [(b.text, b.label) for b in cell] == [("12", None), ("a", None)]
    for page in ("<head><title>t</title><p>whole text", "<head><title>t<p>whole text", "<title>t</title><div>whole text</div>"):
        assert [b.text for b in leaf_blocks(page)] == ["whole text"]
    assert leaf_blocks("<p>so <math><mi>x</mi></math> is</p>")[0].text == "so x is"


def test_depth_costs_nothing():
    import time

    page = "<div><p>text" * 20_000
    start = time.perf_counter()
    assert len(leaf_blocks(page)) == 20_000
    assert time.perf_counter() - start < 5
