"""Collocations against counting all phrases in plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from answerloom.llm import collocations as module
from answerloom.llm.collocations import collocations, words_and_breaks, xxhash_longs
from pyspark.sql import functions as F

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, least, top):
    count = {}
    for lang, text in rows:
        c = count.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, 5):
                c.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, c in count.items():
        n = sum(v for g, v in c.items() if len(g) == 1)
        often = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        ranked = []
        for g, a in often.items():
            if any(len(h) > len(g) and 100 * b >= 80 * a and any(h[i : i + len(g)] == g for i in range(len(h))) for h, b in often.items()):
                continue
            cuts = [(2000000 * a // (c[g[:k]] + c[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            phrase = " ".join(g)
            ranked.append((-score, -a, phrase.encode(), phrase, c[g[:k]], c[g[k:]]))
        for i, (s, a, _, phrase, left, right) in enumerate(sorted(ranked)[:top]):
            out.append((lang, i + 1, phrase, -a, left, right, n, -s))
    return sorted(out)


def check(spark, rows, least, top=2000):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = sorted(tuple(r) for r in collocations(df, least=least, top=top).collect())
    assert got == expected(rows, least, top)
    return got


def texts(rng, n, words, size):
    common = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    for _ in range(n):
        run = rng.choices(common, weights, k=rng.randint(0, size))
        yield "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "!"]) for w in run)


def test_random_texts(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["en", "de", None]), t) for t in texts(rng, 120, 25, 40)]
    rows += [("en", "New York City Hall NEW YORK city hall")] * 9 + [("fr", "l'été à l'été à l'été")] * 8
    assert len(check(spark, rows, 4)) > 50


def test_dense_and_sparse_tiles(spark):
    """More words than ranks, and enough pairs to fill the first tiles."""
    rng = random.Random(4)
    rows = [("en", t) for t in texts(rng, 60, 3000, 1200)]
    check(spark, rows, 3)


def test_top_with_ties(spark):
    rows = [("en", f"a{i} b{i}.") for i in range(30) for _ in range(5)] + [("de", "x y z x y z")] * 6
    assert len(check(spark, rows, 5, top=7)) == 7 + 4


def test_edge_cases(spark):
    rows = [(None, None), ("und", ""), ("en", " .,; "), ("en", "one"), ("en", "a" * 50_000 + " b"), ("", "p q p q p q")] * 3
    got = check(spark, rows, 3)
    assert {r[0] for r in got} == {"en", ""}
    assert collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
    names = ["words", "word", "n", "a", "w1", "ids", "rank", "phrase", "key"]
    df = spark.createDataFrame([("en", "x y", *["v"] * len(names))] * 3, ["lang", "text", *names])
    assert [r["phrase"] for r in collocations(df, least=2).collect()] == ["x y"]


@pytest.mark.parametrize("width", [1, 2, 3])
def test_hash_is_that_of_the_engine(spark, width):
    rng = np.random.default_rng(0)
    values = rng.integers(-(2**63), 2**63 - 1, size=(50, width))
    names = [f"c{i}" for i in range(width)]
    df = spark.createDataFrame([tuple(map(int, v)) for v in values], ", ".join(f"{c} bigint" for c in names))
    want = {tuple(r)[:-1]: r["h"] for r in df.withColumn("h", F.xxhash64(*names)).collect()}
    got = xxhash_longs([np.ascontiguousarray(values[:, i]) for i in range(width)]).view(np.int64)
    assert [want[tuple(map(int, v))] for v in values] == got.tolist()


def test_pieces(spark):
    df = spark.createDataFrame([("Ab C.d,,É\tx\x0by",)], "t string")
    got = df.select(words_and_breaks(F.col("t")).alias("w")).first()["w"]
    assert got == ["ab", "c", "\n", "d", "\n", "É", "x", "\n", "y"]


def test_partial_counts_of_rare_phrases_are_not_shuffled(spark, monkeypatch):
    """Of phrases of four words whose parts are frequent only those of cells that reach the threshold become rows."""
    rng = random.Random(9)
    rows = [("en", t) for t in texts(rng, 150, 12, 60)]
    made = spark.sparkContext.accumulator(0)
    count = module._count

    def counted(width, *rest):
        run = count(width, *rest)

        def more(batches):
            for batch in run(batches):
                made.add(batch.num_rows if width == module.LONGEST else 0)
                yield batch

        return more

    monkeypatch.setattr(module, "_count", counted)
    check(spark, rows, 5)
    few, made.value = made.value, 0
    # many phrases in a cell let rare ones pass, and lose none
    monkeypatch.setattr(module, "CELLS", 64)
    monkeypatch.setattr(module, "_CELL_PART", 16)
    check(spark, rows, 5)
    assert 0 < 2 * few < made.value


def test_thresholds_beyond_a_byte(spark):
    check(spark, [("en", "a b c d e")] * 310 + [("en", "a b c d f")] * 290, 300)


def test_copies_of_a_table_do_not_go_through_the_driver(spark, tmp_path, capsys):
    """The planner takes the copies of a small file's rows for small, and would broadcast each of these joins."""
    ids = ["w1", "w2", "w3", "w4"]
    levels = []
    for width in range(1, 5):
        path = str(tmp_path / f"level-{width}")
        spark.range(200).selectExpr(*[f"id * {i + 1} as {c}" for i, c in enumerate(ids[:width])], "id as a").write.parquet(path)
        levels.append(spark.read.parquet(path))
    path = str(tmp_path / "vocabulary")
    spark.range(200).selectExpr("'x' as lang", "id as w1").write.parquet(path)
    capsys.readouterr()
    module._scored(levels, spark.read.parquet(path)).explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
