"""Histogram shards against a plain sort."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from answerloom.llm.sharding import histogram_shards, text_keys, text_size


def brute(rows, shards):
    """Sorted (doc_id, shard, slot) by digest, id; sizes in UTF-8 bytes plus 8."""
    size = lambda t: len((t or "").encode()) + 8
    digest = lambda t: hashlib.md5((t or "").encode()).hexdigest()[:14]
    keyed = sorted((digest(t), i is not None, i or 0, size(t)) for i, t in rows)
    total, before, out, slots = sum(k[3] for k in keyed), 0, [], {}
    for n, k in enumerate(keyed):
        if n == 0 or keyed[n - 1][:3] != k[:3]:
            first = before
        shard = first * shards // total
        slots[shard] = slots.get(shard, -1) + 1
        out.append((k[2] if k[1] else None, shard, slots[shard]))
        before += k[3]
    return sorted(out, key=repr)


def shards_of(df, n, **options):
    out = histogram_shards(df, text_keys("text", "doc_id"), text_size("text"), n, **options)
    shard, slot = out.columns[-2:]
    return sorted(((r["doc_id"], r[shard], r[slot]) for r in out.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"probes": 3}, {"piece_bytes": 500}])
def test_against_a_sort(make_docs, options):
    rng = random.Random(3)
    rows = [(i, "x" * rng.randint(0, 300)) for i in range(300)]
    rows += [(1000 + i, "one text that a third of all rows share") for i in range(150)]
    assert shards_of(make_docs(rows), 7, **options) == brute(rows, 7)


def test_edge_cases(make_docs, clashing):
    rows = [(1, None), (2, ""), (3, "é" * 50_000), (None, "a"), (None, None), (5, "b"), (5, "b"), (-7, "c")]
    df = make_docs(rows).withColumns({c: F.lit(c) for c in clashing})
    assert shards_of(df, 3) == brute(rows, 3)
    out = histogram_shards(df, text_keys("text", "doc_id"), text_size("text"), 3)
    assert out.columns == [*df.columns, "_shard", "_slot"]
    assert out.where("shard = 'shard' and _piece = '_piece'").count() == len(rows)
    assert shards_of(make_docs([]), 3) == []
    assert shards_of(make_docs([(1, "a")]), 3) == brute([(1, "a")], 3)


def test_tolerance_bounds_the_error(make_docs):
    rows = [(i, "y" * (i % 97)) for i in range(2000)]
    df = make_docs(rows)
    out = histogram_shards(df, text_keys("text", "doc_id"), text_size("text"), 5, tolerance=2000)
    sizes = [r["n"] for r in out.groupBy("shard").agg(F.sum(text_size("text")).alias("n")).collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 2 * 2000 + 2 * 105
