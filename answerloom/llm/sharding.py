"""Shards of near equal size by histogram sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from answerloom.llm.frames import fresh, small_table, text_of, whole_row
from answerloom.llm.splitters import find_cuts
from answerloom.sources.staging import stage


def text_keys(text: str, doc_id: str) -> list[Column]:
    """Order by text digest, then id: copies stand together, yet can be cut apart.

    Each key is a part of at most 32 bits.  A null id comes first.
    """
    digest = F.md5(text_of(text).cast("binary"))
    part = lambda a: F.conv(F.substring(digest, a, 7), 16, 10).cast("bigint")
    ident = F.col(doc_id).cast("bigint")
    return [
        part(1),
        part(8),
        F.coalesce(F.shiftright(ident, 32), F.lit(-(2**33))),
        F.coalesce(ident.bitwiseAND(F.lit(2**32 - 1)), F.lit(-1)),
    ]


def text_size(text: str) -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return (F.octet_length(text_of(text)) + 8).cast("bigint")


def histogram_shards(
    docs: DataFrame,
    keys: list[Column],
    size: Column,
    shards: int,
    tolerance: int = 0,
    probes: int = 256,
    piece_bytes: int = 1 << 30,
) -> DataFrame:
    """All rows and columns of ``docs`` plus ``shard`` (int) and ``slot`` (long).

    The rows are sorted by ``keys`` (longs, no nulls); shard ``i`` takes the rows whose
    preceding bytes lie between ``i`` and ``i + 1`` parts of the total, so a shard is off
    by one row's size at most (plus ``tolerance`` bytes).  ``slot`` counts from 0 in
    each shard without gaps.  The boundaries come from exact byte histograms
    (:func:`find_cuts`); then the rows move once.  A shard is sorted in pieces of
    about ``piece_bytes``, so no task sorts a whole shard.  Rows with equal keys stay in
    one shard, in any order.  Empty tables give no rows.  Columns of ``docs`` named
    shard or slot are kept and the new ones get a leading underscore.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    spark = docs.sparkSession
    names = [f"_key{i}" for i in range(len(keys))]
    keyed = docs.select(*[k.alias(n) for k, n in zip(keys, names, strict=True)], size.alias("_size"))
    keyed = stage(keyed, "shard-keys")
    per_shard = 1

    def targets(total: int, rows: int) -> list[int]:
        nonlocal per_shard
        per_shard = max(1, -(-total // (shards * piece_bytes)))
        parts = shards * per_shard
        return [-(-j * total // parts) for j in range(1, parts)]

    cuts = find_cuts(keyed, names, "_size", targets, probes, max(4096, 8 * shards), tolerance)
    shard, slot = fresh(docs, "shard", "slot")
    first_in_shard: dict[int, int] = {}
    for piece, first in cuts.firsts.items():
        s = piece // per_shard
        first_in_shard[s] = min(first_in_shard.get(s, first), first)
    firsts = [(p, f - first_in_shard[p // per_shard]) for p, f in sorted(cuts.firsts.items())]
    offset = small_table(spark, firsts, "_piece bigint, _offset bigint")
    packed = docs.select(
        *[k.alias(n) for k, n in zip(keys, names, strict=True)], whole_row(docs).alias("_row")
    )
    order = Window.partitionBy("_piece").orderBy(*names)
    return (
        cuts.place(packed, "_piece")
        .withColumn("_number", F.row_number().over(order))
        .join(offset, "_piece")
        .select(
            "_row.*",
            F.floor(F.col("_piece") / per_shard).cast("int").alias(shard),
            (F.col("_offset") + F.col("_number") - 1).cast("bigint").alias(slot),
        )
    )
