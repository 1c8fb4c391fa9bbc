"""Mixing sources to target weights by balanced (cube method) sampling.

Every document of a source has the expected number of copies ``target / size of the
source``.  Its whole part is taken for certain; the fraction is an inclusion
probability.  The flight phase moves these probabilities within the null-space of two
constraints, words and documents, until each is 0 or 1; what two constraints cannot
settle goes on to the next level, and only the last few are drawn (landing).
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from answerloom.llm.frames import small_table, whole_row
from answerloom.sources.staging import stage

#: Rows that one task balances together.
BLOCK_ROWS = 8192
#: Rows that the landing of a source decides together, beside what the flight leaves.
LANDING_ROWS = 24
_EPS = 1e-9


def word_count(text: str) -> Column:
    r"""Number of ``[^\x20\x09-\x0D]+`` in the text (null: 0)."""
    found = F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(found, F.lit(0)).cast("bigint")


def reshare(sizes: Sequence[int], weights: Sequence[float], share: float, cap: float) -> list[float]:
    """Targets by weight that sum to ``share`` of all sizes, none above ``cap`` sizes.

    What a capped source cannot take is shared again by weight among the others until
    none is above.  If all are capped, the rest is left over.
    """
    targets = [0.0] * len(sizes)
    rest = share * sum(sizes)
    free = [i for i in range(len(sizes)) if weights[i] > 0]
    while free:
        total = sum(weights[i] for i in free)
        over = [i for i in free if rest * weights[i] / total > cap * sizes[i]]
        if not over:
            for i in free:
                targets[i] = rest * weights[i] / total
            break
        for i in over:
            targets[i] = cap * sizes[i]
        rest -= sum(targets[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return targets


def _land(units: list[int], sizes: Sequence[int], p: list[float], rng: random.Random) -> None:
    """Decide the last units: draw each, then change one or two at a time while that
    brings words, and then documents, closer to what was expected of them."""
    words = sum(p[i] * sizes[i] for i in units)
    count = sum(p[i] for i in units)
    for i in units:
        p[i] = float(rng.random() < p[i])
    words -= sum(p[i] * sizes[i] for i in units)  # what is missing
    count -= sum(p[i] for i in units)
    sets = [(i,) for i in units] + [(i, j) for k, i in enumerate(units) for j in units[:k]]

    def after(change: tuple[int, ...]) -> tuple[float, float]:
        by = [(1 - 2 * p[i], sizes[i]) for i in change]
        return words - sum(u * s for u, s in by), count - sum(u for u, _ in by)

    while sets:
        best = min(sets, key=lambda c: [abs(x) for x in after(c)])
        got = after(best)
        if [abs(x) for x in got] >= [abs(words), abs(count)]:
            break
        words, count = got
        for i in best:
            p[i] = 1 - p[i]


def balance(sizes: Sequence[int], shares: Sequence[float], rng: random.Random, land: bool) -> list[float]:
    """Probabilities after the flight, all 0 or 1 but for at most two; all with ``land``.

    Three undecided units at a time move along the null vector of (words, documents);
    a random direction, weighted so that each expectation stays, takes one to 0 or 1.
    Before a landing ``LANDING_ROWS`` units of all sizes are held back; they and what the
    flight leaves are then decided together, close to their expected words.
    """
    p = [float(x) for x in shares]
    active: list[int] = []
    kept: list[int] = []
    if land:
        kept = [i for i in range(len(p)) if 0.0 < p[i] < 1.0]
        kept = kept[:: max(1, -(-len(kept) // LANDING_ROWS))]
    held = set(kept)
    queue = iter([i for i in range(len(p)) if i not in held])

    def settle(units: list[int], vector: Sequence[float]) -> None:
        up = down = float("inf")
        for i, u in zip(units, vector, strict=True):
            if u > 0:
                up, down = min(up, (1 - p[i]) / u), min(down, p[i] / u)
            elif u < 0:
                up, down = min(up, -p[i] / u), min(down, -(1 - p[i]) / u)
        step = up if rng.random() * (up + down) < down else -down
        for i, u in zip(units, vector, strict=True):
            p[i] += step * u
            if p[i] < _EPS:
                p[i] = 0.0
            elif p[i] > 1 - _EPS:
                p[i] = 1.0

    def undecided(units: list[int]) -> list[int]:
        return [i for i in units if 0.0 < p[i] < 1.0]

    while True:
        active = undecided(active)
        for i in queue:
            if 0.0 < p[i] < 1.0:
                active.append(i)
                if len(active) == 3:
                    break
        if len(active) < 3:
            break
        a, b, c = (float(sizes[i]) for i in active)
        vector = (b - c, c - a, a - b)
        settle(active, vector if any(vector) else (1.0, -1.0, 0.0))
    if land:
        _land(undecided(active) + kept, sizes, p, rng)
    return p


def _flight(level: int, seed: int, land: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # large documents first, so that what is left over is small
        rows = rows.sort_values(["size", "order", "key", "copy_no"], ascending=[False, True, True, True])
        first = rows.iloc[0]
        text = f"{seed}:{level}:{first['rank']}:{first['block']}"
        rng = random.Random(hashlib.sha256(text.encode()).digest())
        rows["share"] = balance(rows["size"].tolist(), rows["share"].tolist(), rng, land)
        return rows

    return run


def mix_plan(
    docs: DataFrame,
    size: Column,
    cycle: Sequence[float] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 42,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """How often the mix takes each row: one row for each row of ``docs``.

    Sources in code point order, null last, have the weights of ``cycle`` in turn.  They
    share ``share`` of all sizes; no target is above ``cap`` times its source.  Columns:
    doc_id, source, key (the id as text), copy_no (1 for the first row of an id, 2 for
    the next), size, source_size, target, copies.  A source of size 0 has the target 0.  Rows
    of size 0 are balanced like others.  Reruns on the same rows agree; rows that agree
    in id, source, size and text may change places.  The driver holds one total for each source.
    """
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit("\u0000"))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        key.alias("key"),
        F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")).alias("digest"),
        size.alias("size"),
    )
    rows = stage(rows, "mix-rows")
    spark = docs.sparkSession
    totals = sorted(
        rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect(),
        key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8")),
    )
    sizes = [int(r["size"]) for r in totals]
    weights = [cycle[i % len(cycle)] for i in range(len(totals))]
    targets = reshare(sizes, weights, share, cap)
    table = small_table(
        spark,
        [
            (r["source"], i, s, t, t / s if s else 0.0, r["n"])
            for i, (r, s, t) in enumerate(zip(totals, sizes, targets, strict=True))
        ],
        "source string, rank int, source_size bigint, target double, expected double, n bigint",
    ).withColumnRenamed("source", "_source")
    number = Window.partitionBy("key").orderBy("source", "size", "digest")
    units = (
        rows.withColumn("copy_no", F.row_number().over(number))
        .join(table, rows["source"].eqNullSafe(F.col("_source")))
        .withColumns(
            {
                "sure": F.floor("expected").cast("int"),
                "share": F.col("expected") - F.floor("expected"),
                "order": F.xxhash64("key", "copy_no", F.lit(seed)),
            }
        )
        .drop("_source", "digest", "expected")
    )
    counts = [r["n"] for r in totals]
    schema = (
        "doc_id {0}, source string, key string, size bigint, copy_no int, rank int, "
        "source_size bigint, target double, n bigint, sure int, share double, order bigint, block int"
    ).format(docs.schema[doc_id].dataType.simpleString())
    settled, level = [], 0
    while True:
        blocks = [max(1, -(-c // BLOCK_ROWS)) for c in counts]
        land = max(blocks, default=1) == 1
        count = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.lit(1))
        dealt = units.withColumn("block", F.pmod(F.xxhash64("order", F.lit(level)), count).cast("int"))
        flown = dealt.groupBy("rank", "block").applyInPandas(_flight(level, seed, land), schema)
        if land:
            settled.append(flown)
            break
        flown = stage(flown, f"mix-level{level}")
        settled.append(flown.where((F.col("share") == 0) | (F.col("share") == 1)))
        counts = [2 * b for b in blocks]  # at most two of a block go on
        units = (
            flown.where((F.col("share") > 0) & (F.col("share") < 1))
            .withColumn("n", 2 * F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.lit(1)))
            .drop("block")
        )
        level += 1
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    copies = (F.col("sure") + F.round("share").cast("int")).alias("copies")
    return out.select("doc_id", "source", "key", "copy_no", "size", "source_size", "target", copies)


def mix(docs: DataFrame, size: Column, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, repeated as often as it takes them.

    Options and cases as in :func:`mix_plan`.  All columns stay as they are.
    """
    doc_id, source, text = (options.get(k, k) for k in ("doc_id", "source", "text"))
    plan = mix_plan(docs, size, **options)
    taken = plan.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("copy_no", "copies"))).alias("taken")
    )
    packed = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("\u0000")).alias("key"),
        F.col(source).cast("string").alias("source"),
        size.alias("size"),
        F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")).alias("digest"),
        whole_row(docs).alias("row"),
    )
    number = Window.partitionBy("key").orderBy("source", "size", "digest")
    times = F.element_at("taken", F.col("copy_no"))["copies"]
    return (
        packed.withColumn("copy_no", F.row_number().over(number))
        .join(taken, "key")
        .withColumn("times", times)
        .where("times > 0")
        .select("row", F.explode(F.array_repeat(F.lit(1), F.col("times"))).alias("one"))
        .select("row.*")
    )
