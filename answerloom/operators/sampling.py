"""Seeded splitting, sampling and shuffling as pure functions of (seed, ID).

Rows are ordered by ``md5(seed:ID)``, so membership does not depend on the
partitioning. A subset may hold any share of the table: no operator here sorts a
whole subset (or table) in one task. The k-th smallest hash is found from a
histogram over the leading hash digits, and only the bucket at the boundary,
about one row in 65,536, is ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from answerloom.names import ID, LOW_RESOURCE, SUBSET
from answerloom.sources.staging import stage

DIGITS = 4  # leading hex digits that form a histogram bucket
_S, _H, _B = "__stratum", "__hash", "__bucket"


def hash_key(seed: int, *parts: Column) -> Column:
    """Hex md5 of ``seed:part[:part...]``."""
    pieces: list[Column] = [F.lit(str(seed))]
    for part in parts:
        pieces += [F.lit(":"), part.cast("string")]
    return F.md5(F.concat(*pieces))


def _stratum(df: DataFrame, column: str | None) -> Column:
    if column is None or column not in df.columns:
        return F.lit("")
    return F.coalesce(F.col(column), F.lit(""))


def stratum_quotas(counts: DataFrame, target: Column) -> DataFrame:
    """Share ``target(total)`` among strata in proportion to their counts.

    ``counts`` has (stratum, n). Whole shares first, then one row each to the
    largest remainders, ties by stratum. Works on one row per stratum.
    """
    everything = Window.partitionBy(F.lit(1))
    n = F.col("n").cast("decimal(19,0)")
    ranked = Window.partitionBy(F.lit(1)).orderBy(F.desc("rest"), F.col(_S))
    return (
        counts.withColumn("rows", F.sum("n").over(everything))
        .withColumn("want", target)
        .withColumn("share", n * F.col("want").cast("decimal(19,0)"))
        .withColumn("base", F.expr("cast(share div rows as bigint)"))
        .withColumn("rest", F.expr("cast(share % rows as bigint)"))
        .withColumn("short", F.col("want") - F.sum("base").over(everything))
        .withColumn("rank", F.row_number().over(ranked))
        .select(
            _S,
            "n",
            (F.col("base") + (F.col("rank") <= F.col("short")).cast("long")).alias(
                "quota"
            ),
        )
    )


def _cutoffs(keys: DataFrame, quotas: DataFrame) -> DataFrame:
    """Per stratum the (hash, ID) of its quota-th row in hash order."""
    keys = keys.withColumn(_B, F.substring(_H, 1, DIGITS))
    running = Window.partitionBy(_S).orderBy(_B)
    edges = (
        keys.groupBy(_S, _B)
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(running))
        .join(quotas.select(_S, "quota"), _S)
        .where(
            (F.col("upto") >= F.col("quota"))
            & (F.col("upto") - F.col("n") < F.col("quota"))
        )
        .select(_S, _B, (F.col("quota") - F.col("upto") + F.col("n")).alias("need"))
    )
    order = Window.partitionBy(_S).orderBy(_H, ID)
    return (
        keys.join(stage(edges, "edges"), [_S, _B])
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") == F.col("need"))
        .select(_S, F.col(_H).alias("cut_hash"), F.col(ID).alias("cut_id"))
    )


def _mark(
    df: DataFrame, target: Column, seed: int, by: str | None, strict: bool
) -> DataFrame:
    """Add boolean ``picked``: among the first quota rows of its stratum."""
    keyed = df.withColumns({_S: _stratum(df, by), _H: hash_key(seed, F.col(ID))})
    keys = keyed.select(ID, _S, _H)
    counts = keys.groupBy(_S).agg(F.count("*").alias("n"))
    quotas = stage(stratum_quotas(counts, target), "quotas")
    if strict:
        _check_strata(quotas)
    cuts = stage(_cutoffs(keys, quotas), "cutoffs")
    picked = (F.col(_H) < F.col("cut_hash")) | (
        (F.col(_H) == F.col("cut_hash")) & (F.col(ID) <= F.col("cut_id"))
    )
    return keyed.join(cuts, _S, "left").select(
        *df.columns, F.coalesce(picked, F.lit(False)).alias("picked")
    )


def _check_strata(quotas: DataFrame) -> None:
    row = quotas.agg(
        F.count("*").alias("strata"),
        F.min("n").alias("least"),
        F.sum("quota").alias("picked"),
        F.sum(F.col("n") - F.col("quota")).alias("kept"),
    ).first()
    if row["strata"] and row["least"] < 2:
        raise ValueError("a stratum has fewer than two rows")
    if row["strata"] and min(row["picked"], row["kept"]) < row["strata"]:
        raise ValueError("a side has fewer rows than there are strata")


def stratified_labels(
    df: DataFrame,
    fraction: float,
    seed: int = 42,
    by: str | None = SUBSET,
    strict: bool = False,
) -> DataFrame:
    """Add ``part`` ('holdout' / 'train') with ``ceil(fraction*n)`` holdout rows."""
    target = F.ceil(F.lit(float(fraction)) * F.col("rows")).cast("long")
    part = F.when(F.col("picked"), F.lit("holdout")).otherwise(F.lit("train"))
    return (
        _mark(df, target, seed, by, strict).withColumn("part", part).drop("picked")
    )


def stratified_split(
    df: DataFrame,
    fraction: float,
    seed: int = 42,
    by: str | None = SUBSET,
    strict: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(train, holdout), stratified on ``by``; unstratified without the column."""
    marked = stratified_labels(df, fraction, seed, by, strict)
    train = marked.where(F.col("part") == "train").drop("part")
    return train, marked.where(F.col("part") == "holdout").drop("part")


def stratified_cap(
    df: DataFrame, max_rows: int, seed: int = 42, by: str | None = SUBSET
) -> DataFrame:
    """At most ``max_rows`` rows, stratified; the whole table when it is smaller."""
    if max_rows <= 0:
        return df
    target = F.least(F.lit(int(max_rows)).cast("long"), F.col("rows"))
    return _mark(df, target, seed, by, False).where("picked").drop("picked")


def sample_n(df: DataFrame, n: int | None, seed: int = 42) -> DataFrame:
    """``min(n, rows)`` rows without replacement; everything when ``n`` is null."""
    if not n:
        return df
    return stratified_cap(df, n, seed, by=None)


def oversample_subsets(
    df: DataFrame, subsets: Sequence[str] = LOW_RESOURCE, weight: int = 2
) -> DataFrame:
    """Every row once, rows of ``subsets`` ``weight`` times, told apart by ``copy_no``."""
    if weight < 1:
        raise ValueError("weight must be at least 1")
    copies = F.when(F.col(SUBSET).isin(*subsets), F.lit(int(weight))).otherwise(1)
    return df.withColumn("copy_no", F.explode(F.sequence(F.lit(1), copies)))


def shuffle_rows(df: DataFrame, seed: int = 42) -> DataFrame:
    """Seeded full permutation as a 1-based ``position`` (null-free bigint).

    Ranks inside hash buckets are shifted by the rows of all earlier buckets, so
    the global rank never needs one global sort task.
    """
    parts = [F.col(ID)] + ([F.col("copy_no")] if "copy_no" in df.columns else [])
    keyed = df.withColumn(_H, hash_key(seed, *parts))
    keyed = keyed.withColumn(_B, F.substring(_H, 1, DIGITS))
    earlier = Window.partitionBy(F.lit(1)).orderBy(_B)
    offsets = (
        keyed.groupBy(_B)
        .agg(F.count("*").alias("n"))
        .select(_B, (F.sum("n").over(earlier) - F.col("n")).alias("before"))
    )
    order = Window.partitionBy(_B).orderBy(_H, *parts)
    return (
        keyed.join(stage(offsets, "offsets"), _B)
        .withColumn("position", F.row_number().over(order) + F.col("before"))
        .select(*df.columns, "position")
    )
