"""Token-overlap and longest-common-subsequence F1 on whitespace tokens."""

from __future__ import annotations

from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from answerloom.functions.arrays import let, total, value_counts
from answerloom.functions.text import tokenize_ws


def f1(common: Column, n_pred: Column, n_ref: Column) -> Column:
    """Harmonic mean of ``common/n_pred`` and ``common/n_ref``; 0 without overlap."""
    p = common / n_pred
    r = common / n_ref
    return F.when(common > 0, (F.lit(2.0) * p * r) / (p + r)).otherwise(F.lit(0.0))


def overlap(pred: Column, ref: Column) -> Column:
    """Clipped token overlap of two token arrays (multiset intersection size)."""
    both = F.map_zip_with(
        value_counts(pred),
        value_counts(ref),
        lambda _k, a, b: F.least(F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))),
    )
    return total(F.map_values(both), F.lit(0)).cast("long")


def rouge1_f1(pred: Column, ref: Column) -> Column:
    """ROUGE-1 F1 of two texts; null counts as empty. Never leaves the JVM."""
    return let(
        F.struct(tokenize_ws(pred).alias("p"), tokenize_ws(ref).alias("r")),
        # the overlap is used several times in the formula
        lambda t: let(overlap(t["p"], t["r"]), lambda n: f1(n, F.size(t["p"]), F.size(t["r"]))),
    )


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two token arrays."""
    return common_tokens(a, b)["lcs"]


def common_tokens(a: Column, b: Column) -> Column:
    """Struct of ``overlap`` (as the function of that name) and ``lcs`` (longest common
    subsequence) of two token arrays, whose words are numbered once for both.

    The nested function travels to the executors by value, so they do not need
    this package installed.
    """

    def length(x: list[int], y: list[int]) -> int:
        # Bit-parallel row update (Crochemore et al. 2001): zero bits of ``row``
        # mark the columns at which the length grows.
        where: dict[int, int] = {}
        for i, token in enumerate(y):
            where[token] = where.get(token, 0) | (1 << i)
        full = (1 << len(y)) - 1
        row = full
        for token in x:
            if token not in where:
                continue
            hit = row & where[token]
            if hit:
                row = ((row + hit) | (row - hit)) & full
        return len(y) - row.bit_count()

    def numbered(lists: list[pa.Array]) -> list[list[list[int]]]:
        words = pa.concat_arrays([x.flatten() for x in lists]).dictionary_encode().indices.to_numpy()
        sizes = [n.as_py() or 0 for x in lists for n in x.value_lengths()]
        ends = list(accumulate(sizes))
        rows = [words[end - size : end].tolist() for size, end in zip(sizes, ends)]
        return [rows[: len(lists[0])], rows[len(lists[0]) :]]

    def shared(x: list[int], y: list[int]) -> int:
        return (Counter(x) & Counter(y)).total()

    def counts(xs: pa.Array, ys: pa.Array) -> pa.Array:
        # few rows at a time become Python objects, whatever the size of a batch
        both: list[int] = []
        longest: list[int] = []
        for at in range(0, len(xs), few):
            x, y = numbered([xs.slice(at, few), ys.slice(at, few)])
            both += map(shared, x, y)
            longest += map(length, x, y)
        return pa.StructArray.from_arrays([pa.array(both, pa.int64()), pa.array(longest, pa.int64())], ["overlap", "lcs"])

    few = 64
    return F.arrow_udf(counts, "overlap long, lcs long")(a, b)


def rougeL_f1(pred_tokens: Column, ref_tokens: Column, lcs: Column) -> Column:
    return f1(lcs, F.size(pred_tokens), F.size(ref_tokens))
