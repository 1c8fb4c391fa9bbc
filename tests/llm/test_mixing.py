import random

from pyspark.sql import functions as F

from answerloom.llm.mixing import balance, mix, mix_plan, reshare, word_count


def test_reshare():
    assert reshare([100, 100, 100], [3, 1, 2], 1.5, 2.0) == [200.0, 250 / 3, 500 / 3]
    assert reshare([0, 10], [3, 1], 1.5, 2.0) == [0.0, 15.0]
    assert reshare([], [], 1.5, 2.0) == []
    targets = reshare([1, 1000, 5, 7], [3, 1, 2, 3], 1.5, 2.0)
    assert abs(sum(targets) - 1.5 * 1013) < 1e-9 and all(t <= 2 * s for t, s in zip(targets, [1, 1000, 5, 7]))


def test_balance_keeps_totals_and_expectations():
    rng = random.Random(1)
    sizes = [rng.randint(1, 500) for _ in range(300)]
    share = 0.37
    hits = [0] * len(sizes)
    for seed in range(200):
        p = balance(sizes, [share] * len(sizes), random.Random(seed), True)
        assert set(p) <= {0.0, 1.0}
        assert abs(sum(a * b for a, b in zip(p, sizes)) - share * sum(sizes)) <= 20
        assert abs(sum(p) - share * len(sizes)) <= 6
        hits = [h + x for h, x in zip(hits, p)]
    assert all(0.2 < h / 200 < 0.55 for h in hits)
    left = balance(sizes, [share] * len(sizes), rng, False)
    assert sum(0 < x < 1 for x in left) <= 2


def test_plan_and_mix(make_docs, clashing):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(1, 60), "big" if i % 3 == 0 else f"s{i % 4}") for i in range(30_000)]
    df = make_docs(rows)
    plan = mix_plan(df, word_count("text"))
    sums = plan.groupBy("source", "target", "source_size").agg(F.sum(F.col("size") * F.col("copies")).alias("t")).collect()
    assert len(sums) == 5
    for r in sums:
        assert abs(r["t"] - r["target"]) <= 0.001 * r["target"] + 5
    assert plan.agg(F.max("copies")).first()[0] <= 2
    again = mix_plan(df.repartition(5), word_count("text"))
    assert plan.exceptAll(again).count() == 0
    mixed = mix(df.limit(500).withColumns({c: F.lit(c) for c in clashing}), word_count("text"))
    assert mixed.where("key <> 'key' or copies <> 'copies'").count() == 0


def test_edge_cases(make_docs):
    rows = [(1, None, None), (2, "", "a"), (3, "a b", "a"), (3, "a b", "a"), (3, "c", "b"), (None, "x y z", None),
            (4, "u " * 40_000, "c"), (5, "\x0b\x0c q", "c")]
    df = make_docs(rows)
    plan = mix_plan(df, word_count("text"))
    got = plan.collect()
    assert sorted(r["size"] for r in got) == [0, 0, 1, 1, 2, 2, 3, 40_000]
    assert all(0 <= r["copies"] <= 2 for r in got)
    mixed = mix(df, word_count("text"))
    assert mixed.columns == df.columns
    assert mixed.count() == sum(r["copies"] for r in got)
    assert mix_plan(make_docs([]), word_count("text")).collect() == []
    assert mix(make_docs([]), word_count("text")).collect() == []
