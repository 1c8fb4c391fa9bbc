import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from answerloom.operators import sampling


def table(spark, sizes):
    rows = [(f"{s}{i}", s if s != "none" else None) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "ID string, subset string").repartition(5)


def expected(rows, target, seed=42):
    """Largest-remainder quotas, then the first rows by seeded hash."""
    groups = defaultdict(list)
    for i, s in rows:
        groups[s or ""].append(i)
    n = len(rows)
    share = {s: divmod(len(g) * target, n) for s, g in groups.items()}
    left = target - sum(b for b, _ in share.values())
    extra = sorted(share, key=lambda s: (-share[s][1], s))[:left]
    picked = set()
    for s, g in groups.items():
        order = sorted(g, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))
        picked.update(order[: share[s][0] + (s in extra)])
    return picked


# one subset holds most rows; one bucket digit makes crowded boundary buckets
@pytest.mark.parametrize("digits", [1, 4])
@pytest.mark.parametrize("fraction", [0.05, 0.333, 0.9])
def test_split_is_exact_disjoint_and_complete(spark, monkeypatch, digits, fraction):
    monkeypatch.setattr(sampling, "DIGITS", digits)
    df = table(spark, {"hot": 700, "a": 40, "b": 3, "none": 21})
    rows = [tuple(r) for r in df.collect()]
    train, holdout = sampling.stratified_split(df, fraction)
    t, h = [{r["ID"] for r in x.collect()} for x in (train, holdout)]
    assert not t & h and len(t) + len(h) == len(rows)
    assert h == expected(rows, math.ceil(fraction * len(rows)))
    again = sampling.stratified_split(df.repartition(2), fraction)[1]
    assert {r["ID"] for r in again.collect()} == h


def test_split_without_subset_and_strict(spark):
    df = table(spark, {"a": 10, "b": 1})
    assert sampling.stratified_split(df.drop("subset"), 0.5)[1].count() == 6
    with pytest.raises(ValueError):
        sampling.stratified_split(df, 0.5, strict=True)
    with pytest.raises(ValueError):
        sampling.stratified_split(table(spark, {"a": 10, "b": 10}), 0.01, strict=True)


def test_cap_and_sample(spark):
    df = table(spark, {"hot": 300, "a": 30})
    rows = [tuple(r) for r in df.collect()]
    assert {r["ID"] for r in sampling.stratified_cap(df, 33).collect()} == expected(rows, 33)
    assert sampling.stratified_cap(df, 1500).count() == 330
    assert sampling.sample_n(df, 7).count() == 7
    assert sampling.sample_n(df, None).count() == 330
    assert sampling.sample_n(df, 999).count() == 330


def test_oversample_and_shuffle(spark):
    df = table(spark, {"Swa_Ken": 20, "Eng_Uga": 30})
    more = sampling.oversample_subsets(df)
    assert Counter(r["subset"] for r in more.collect()) == {"Swa_Ken": 40, "Eng_Uga": 30}
    out = sampling.shuffle_rows(more).collect()
    assert sorted(r["position"] for r in out) == list(range(1, 71))
    order = sorted(out, key=lambda r: r["position"])
    keys = [hashlib.md5(f"42:{r['ID']}:{r['copy_no']}".encode()).hexdigest() for r in order]
    assert keys == sorted(keys)
    assert df.where(F.col("ID").isNull()).count() == 0
