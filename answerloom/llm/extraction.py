"""Main text of web pages by a CRF over leaf blocks."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm.crf import Crf, train
from answerloom.llm.frames import fresh
from answerloom.llm.pages import MARK, features, leaf_blocks

#: Pages that the model is trained on, at most.
TRAINING_PAGES = 96
_SEED = 42
_PLAIN = (
    "<html><body><nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
    "<article><h1>A walk along the river</h1><p>The water was low, and the path that led down to it was dry.</p>"
    "<p>We met two people on the bridge. They had been there since the morning, they said.</p>"
    "<ul><li>bread and cheese, enough for four</li><li>a map of the valley</li></ul></article>"
    "<footer>&copy; example</footer></body></html>"
)
_ARTICLE = re.compile(r"<article\b[^>]*>(.*?)</article\s*>", re.S | re.I)


def _part(rng: random.Random, words: list[str], low: int, high: int) -> str:
    n = rng.randint(low, high)
    start = rng.randrange(max(1, len(words) - n))
    return " ".join(words[start : start + n]) or "text"


def labelled_page(page: str, rng: random.Random) -> str | None:
    """A page whose elements carry ``MARK``: 1 main text, 0 anything else.

    The article of a real page is the main text.  It gets a container as sites use
    them, and around and inside it boilerplate of every kind, made of the page's own
    words so that only structure and form tell the two apart.
    """
    page = page.replace(MARK, "")
    found = _ARTICLE.search(page)
    if not found:
        return None
    body = found.group(1)
    words = re.sub(r"<[^>]*>|[<>]", " ", page).split()[:4000]
    say = lambda a, b: _part(rng, words, a, b)
    link = lambda: f"<a href='/{rng.randrange(99)}'>{say(1, 3)}</a>"
    links = lambda n: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(n)) + "</ul>"
    no = "data-crf-label='0'"
    before = [
        f"<nav {no}>{links(rng.randint(2, 7))}</nav>",
        f"<div class='menu' {no}>{links(rng.randint(2, 7))}</div>",
        f"<header {no}><h1>{say(1, 4)}</h1><p>{say(3, 9)}</p></header>",
        f"<div class='site-header' {no}><div>{say(1, 5)}</div></div>",
        f"<div class='cookie-notice' {no}><p>{say(8, 25)}</p><button>{say(1, 2)}</button></div>",
        f"<div class='ad' {no}>{say(3, 14)}</div>",
        f"<form {no}><label>{say(1, 2)}</label><button>{say(1, 2)}</button></form>",
    ]
    inside = [
        f"<aside class='related' {no}><h3>{say(1, 3)}</h3>{links(rng.randint(2, 4))}</aside>",
        f"<div class='advert' {no}><p>{say(4, 20)}</p></div>",
        f"<div class='share' {no}>{link()} {link()}</div>",
        f"<form class='newsletter' {no}><p>{say(4, 12)}</p><button>{say(1, 2)}</button></form>",
    ]
    after = [
        f"<section id='comments' class='comments' {no}><h2>{say(1, 2)}</h2>"
        + "".join(
            f"<div class='comment'><p>{say(5, 40)}.</p></div>" for _ in range(rng.randint(1, 4))
        )
        + "</section>",
        f"<aside class='sidebar' {no}><h3>{say(1, 3)}</h3><p>{say(6, 30)}.</p></aside>",
        f"<div class='widget' {no}>{links(rng.randint(2, 5))}</div>",
        f"<div class='popup' {no}><p>{say(6, 20)}.</p></div>",
        f"<footer {no}>&copy; {say(4, 14)}.</footer>",
        f"<div class='footer' {no}><p>{say(4, 14)}</p></div>",
    ]
    pick = lambda xs: rng.sample(xs, rng.randint(0, len(xs) - 1))
    cut = body.rfind("<p", 0, rng.randrange(len(body) + 1))
    some = "".join(rng.sample(inside, rng.randint(0, 1)))
    if cut > 0:
        body = body[:cut] + some + body[cut:]
    head, tail = rng.choice(
        [
            ("<article data-crf-label='1'>", "</article>"),
            ("<main data-crf-label='1'><article>", "</article></main>"),
            ("<div class='content' data-crf-label='1'>", "</div>"),
            ("<main data-crf-label='1'>", "</main>"),
            ("<div class='post-content' data-crf-label='1'>", "</div>"),
            ("<article data-crf-label='1'>", "</article>"),
        ]
    )
    return (
        f"<html><body {no}>" + "".join(pick(before)) + head + body + tail + "".join(pick(after)) + "</body></html>"
    )


def train_extractor(pages: list[str], copies: int = 2) -> Crf:
    """A model from real pages (and one written here), each labelled in ``copies`` variants.

    Pages without an article element teach nothing and are skipped.
    """
    rng = random.Random(_SEED)
    sequences, labels = [], []
    for page in [*sorted(pages), *[_PLAIN] * 12]:
        for _ in range(copies):
            marked = labelled_page(page, rng)
            if marked is not None:
                blocks = leaf_blocks(marked, True)
                sequences.append(features(blocks))
                labels.append([b.label or 0 for b in blocks])
    order = list(range(len(sequences)))
    rng.shuffle(order)
    return train([sequences[i] for i in order], [labels[i] for i in order])


def main_text(page: str, model: Crf) -> str:
    """Blocks that the model takes for main text, one a line."""
    blocks = leaf_blocks(page)
    chosen = model.viterbi(features(blocks))
    return "\n".join(b.text for b, y in zip(blocks, chosen, strict=True) if y)


def extract_pages(
    pages: DataFrame,
    page_id: str = "page_id",
    body: str = "html",
    training_pages: int = TRAINING_PAGES,
) -> DataFrame:
    """``pages`` with the main text of the whole page as last column, ``text``.

    The model is trained on at most ``training_pages`` pages with an article element, picked by a hash of
    id and content; every page is then parsed and decoded whole.  Null and empty pages, and pages
    without main text, give an empty text.  Equal pages give equal texts.  A name that is taken
    gets a leading underscore.
    """
    (text,) = fresh(pages, "text")
    whole = F.col(body).cast("string")
    hashed = pages.where(whole.contains("<article")).select(
        F.xxhash64(F.lit(_SEED), page_id, F.md5(whole.cast("binary"))).alias("h"), whole.alias("page")
    )
    # hashes are compared first, so that only the pages picked travel
    picked = [r["h"] for r in hashed.select("h").orderBy("h").limit(training_pages).collect()]
    sample = hashed.where(F.col("h").isin(picked)).groupBy("h").agg(F.first("page").alias("page"))
    model = train_extractor([r["page"] for r in sample.orderBy("h").collect()])

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(x or "", model) for x in batch], dtype=object)

    return pages.withColumn(text, extract(whole))
