"""Array helpers built from higher-order functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` by name."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def records(names: Sequence[str], *rows: Sequence[Column]) -> Column:
    """Array of equally named structs, for ``inline``: one output row per entry."""
    return F.array(
        *[F.struct(*[c.alias(n) for n, c in zip(names, row, strict=True)]) for row in rows]
    )


def value_counts(items: Column) -> Column:
    """Map of distinct array element -> number of occurrences (null for null).

    Sorts inside the row and measures the runs, so counting a text costs
    O(n log n) and no shuffle.
    """

    def runs(g: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(g) - 1),
            lambda i: ~F.get(g, i).eqNullSafe(F.get(g, i - 1)),
        )
        return let(
            starts,
            lambda s: F.map_from_arrays(
                F.transform(s, lambda i: F.get(g, i)),
                F.transform(
                    s, lambda i, k: F.coalesce(F.get(s, k + 1), F.size(g)) - i
                ),
            ),
        )

    empty = F.map_from_arrays(
        F.array().cast("array<string>"), F.array().cast("array<int>")
    )
    return let(
        F.sort_array(items), lambda g: F.when(F.size(g) > 0, runs(g)).otherwise(empty)
    )


def total(values: Column, zero: Column) -> Column:
    """Sum of an array; ``zero`` fixes the accumulator type."""
    return F.aggregate(values, zero, lambda acc, x: acc + x)
