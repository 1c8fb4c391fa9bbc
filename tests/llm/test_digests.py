"""Exact duplicates against a dictionary of texts."""

import hashlib
import random

from answerloom.llm.digests import exact_dedup

BLANK = str.maketrans("", "", " \t\n\x0b\x0c\r")


def expected(rows):
    groups = {}
    for at, (i, text) in enumerate(rows):
        body = text or ""
        groups.setdefault(body.translate(BLANK), []).append((-len(body), i is None, i or 0, at))
    out = []
    for bare, members in groups.items():
        best = min(members)
        digest = hashlib.sha256(bare.encode()).hexdigest()
        for m in members:
            out.append((rows[m[3]][0], rows[best[3]][0], len(members), m == best, digest))
    return sorted(out, key=repr)


def check(spark, rows, parts):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    got = sorted((tuple(r) for r in exact_dedup(df).collect()), key=repr)
    assert got == expected(rows)


def test_random_texts(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a b", "ab", " a\tb\n", "c", "", " ", None, "é x", "éx", f"own {i}"])) for i in range(3000)]
    check(spark, rows, 24)


def test_one_text_fills_most_of_the_table(spark):
    rows = [(i, "same  text" if i % 3 else f"t {i}") for i in range(4000)] + [(None, "same text ")]
    check(spark, rows, 40)


def test_edge_cases(spark):
    long = "word " * 200_000
    rows = [(5, "x"), (5, "x"), (None, "x"), (None, None), (None, ""), (-1, long), (2, long + " "), (3, " "), (4, "")]
    check(spark, rows, 3)
    assert exact_dedup(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_other_columns_do_not_clash(spark):
    names = ["part", "digest", "size", "lack", "void", "id", "row", "copies", "keep", "keep_id", "kept"]
    rows = [(i, "t", *["v"] * len(names)) for i in range(3)]
    got = exact_dedup(spark.createDataFrame(rows, ["doc_id", "text", *names])).collect()
    assert [(r["keep_id"], r["group_size"]) for r in got] == [(0, 3)] * 3
