"""Exact cut points of a weighted order, found by histograms of a few probes.

Rows are ordered by a list of long columns.  Each round counts rows and weight of
every bin between probe keys; only bins in which a target falls are divided again,
so later rounds touch few rows.  The driver sees histograms only: at most
``probes`` bins for each target that is still open.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.llm.frames import small_table

_SPEC = "cell bigint, level int, lo bigint, step bigint"
_MAP = "cell bigint, bin bigint, piece bigint, child bigint, level int, lo bigint, step bigint"


@dataclass
class Cuts:
    """Where the targets fall: ``firsts[i]`` rows stand before piece ``i``."""

    keys: list[str]
    rounds: list[list[tuple]]
    start: tuple | None
    firsts: dict[int, int]
    total: int
    rows: int

    def place(self, df: DataFrame, piece: str) -> DataFrame:
        """Add ``piece``, the number of targets at or below the weight before a row.

        ``df`` has the key columns.  Only broadcast look-ups, no exchange.
        """
        if self.start is None:
            return df.withColumn(piece, F.lit(min(self.firsts)).cast("bigint"))
        spark = df.sparkSession
        cell, level, lo, step = self.start
        own = {
            "_cell": F.lit(cell).cast("bigint"),
            "_level": F.lit(level),
            "_lo": F.lit(lo).cast("bigint"),
            "_step": F.lit(step).cast("bigint"),
            piece: F.lit(None).cast("bigint"),
        }
        out = df.withColumns(own)
        for rows in self.rounds:
            found = small_table(spark, rows, _MAP).toDF(
                "_cell", "_bin", "_piece2", "_child", "_level2", "_lo2", "_step2"
            )
            out = (
                out.withColumn("_bin", _bin(self.keys, "_level", "_lo", "_step"))
                .join(found, ["_cell", "_bin"], "left")
                .withColumns(
                    {
                        piece: F.coalesce(F.col(piece), F.col("_piece2")),
                        "_cell": F.col("_child"),
                        "_level": F.col("_level2"),
                        "_lo": F.col("_lo2"),
                        "_step": F.col("_step2"),
                    }
                )
                .drop("_bin", "_piece2", "_child", "_level2", "_lo2", "_step2")
            )
        return out.drop("_cell", "_level", "_lo", "_step")


def _bin(keys: list[str], level: str, lo: str, step: str) -> Column:
    value = F.coalesce(*[F.when(F.col(level) == i, F.col(k)) for i, k in enumerate(keys)])
    return F.floor((value - F.col(lo)) / F.col(step)).cast("bigint")


def _divide(cell: int, low: list[int], high: list[int], probes: int) -> tuple | None:
    """(cell, level, lo, step) by the first key that still differs, None if none does."""
    for level, (a, b) in enumerate(zip(low, high, strict=True)):
        if a < b:
            return cell, level, a, max(1, -(-(b - a + 1) // probes))
    return None


def find_cuts(
    keyed: DataFrame,
    keys: list[str],
    weight: str,
    make_targets,
    probes: int = 256,
    first_probes: int = 4096,
    tolerance: int = 0,
) -> Cuts:
    """Cut the order of ``keyed`` by ``keys`` where the weight reaches each target.

    ``make_targets(total, rows)`` gives ascending integers.  With ``tolerance`` 0 a
    cut is exact: a row is in piece ``i`` if ``i`` targets are at or below the weight
    of all rows with smaller keys.  Otherwise a cut may lie that much too late.  Rows
    with equal keys stay in one piece.  Keys are longs of at most 2**52 in magnitude
    without nulls.
    """
    ends = [f(k).alias(f"{n}{i}") for i, k in enumerate(keys) for n, f in (("a", F.min), ("b", F.max))]
    sums = [F.count(F.lit(1)).alias("n"), F.sum(weight).alias("w")]
    top = keyed.agg(*sums, *ends).first()
    total, rows = int(top["w"] or 0), int(top["n"])
    targets = make_targets(total, rows)
    firsts = {0: 0}
    each = range(len(keys))
    start = None
    if rows:
        start = _divide(0, [top[f"a{i}"] for i in each], [top[f"b{i}"] for i in each], first_probes)
    if start is None or not targets or targets[0] >= total:  # no cut between two rows
        return Cuts(keys, [], None, {bisect_right(targets, 0): 0}, total, rows)

    rounds, number = [], 0
    active, before = [start], {0: (0, 0)}
    state = keyed.withColumn("cell", F.lit(0).cast("bigint"))
    while active:
        spec = small_table(keyed.sparkSession, active, _SPEC)
        binned = state.join(spec, "cell").withColumn("bin", _bin(keys, "level", "lo", "step"))
        found = binned.groupBy("cell", "bin").agg(*sums, *ends).collect()
        by_cell: dict[int, list] = {}
        for r in found:
            by_cell.setdefault(r["cell"], []).append(r)
        table, following, passed = [], [], []
        for cell, *_ in active:
            weight_before, rows_before = before[cell]
            for r in sorted(by_cell.get(cell, []), key=lambda r: r["bin"]):
                piece = bisect_right(targets, weight_before + tolerance)
                end = weight_before + int(r["w"]) - tolerance
                child = None
                if piece < len(targets) and targets[piece] < end:
                    child = _divide(
                        number + 1, [r[f"a{i}"] for i in each], [r[f"b{i}"] for i in each], probes
                    )
                if child:
                    number += 1
                    following.append(child)
                    passed.append((cell, r["bin"], number))
                    before[number] = (weight_before, rows_before)
                    table.append((cell, r["bin"], None, *child))
                else:
                    table.append((cell, r["bin"], piece, None, None, None, None))
                    firsts[piece] = min(firsts.get(piece, rows_before), rows_before)
                weight_before += int(r["w"])
                rows_before += r["n"]
        rounds.append(table)
        active = following
        if active:
            onward = small_table(keyed.sparkSession, passed, "cell bigint, bin bigint, child bigint")
            state = (
                binned.join(onward, ["cell", "bin"])
                .drop("cell", "bin", "level", "lo", "step")
                .withColumnRenamed("child", "cell")
            )
    return Cuts(keys, rounds, start, firsts, total, rows)
