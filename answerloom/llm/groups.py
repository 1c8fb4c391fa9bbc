"""Connected groups of verified candidates, without all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.sources.staging import stage

#: Bits of the filter that keeps rows without a partner out of a shuffle (4 MB).
_FILTER_BITS = 1 << 25
#: Nodes of a bucket that others are tested against before pairs are formed.
PIVOTS = 3
#: Rounding of distances.
_SLACK = 1e-9


def only_possible(
    df: DataFrame, key: str, keys: DataFrame, surely_not: bool = False
) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be in column ``key`` of ``keys``, or all other rows.

    A bitmap of fixed size over hashes goes to every task; rows that cannot have a partner
    leave before a shuffle.  Others may pass by chance, so an exact join must follow.
    """
    spot = F.pmod(F.xxhash64(F.col(key), F.lit(5)), F.lit(_FILTER_BITS)) + 1
    bits = (
        keys.select(spot.alias("x"))
        .groupBy(F.bitmap_bucket_number("x").alias("_part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("_bits"))
    )
    place = F.bitmap_bit_position("_x").cast("int")
    byte = F.conv(
        F.hex(F.substring(F.col("_bits"), F.shiftright(place, 3) + 1, F.lit(1))), 16, 10
    ).cast("int")
    hit = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(place, F.lit(8)))), F.lit(2)) == 1
    # at most 1,024 rows of 4 KB
    marked = (
        df.withColumn("_x", spot)
        .withColumn("_part", F.bitmap_bucket_number("_x"))
        .join(F.broadcast(bits), "_part", "left" if surely_not else "inner")
    )
    chosen = ~F.coalesce(hit, F.lit(False)) if surely_not else hit
    return marked.where(chosen).drop("_x", "_part", "_bits")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node that is connected to each linked node.

    Large-star and small-star steps in turn until nothing changes; each step only
    takes minima and joins, so no group meets in one task.
    """
    edges = stage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(),
        "links",
    )
    mark = _fingerprint(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v")))
        edges = stage(small.where("u <> v").distinct(), "small-star")
        now = _fingerprint(edges)
        if now == mark:
            break
        mark = now
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(tops)


def _fingerprint(edges: DataFrame) -> tuple:
    got = edges.agg(
        F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(2**40)))
    ).first()
    return tuple(got)


def connect(
    members: DataFrame,
    measure: Callable[[DataFrame], DataFrame],
    reach: float | None = None,
    weigh: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(node, label) of nodes that share a verified link, directly or through others.

    ``members`` has (bucket, node), every node of a bucket being a candidate of the others.
    ``measure`` keeps the rows of (a, b) that are links; with ``reach`` it returns all of them
    with their distance ``far``, a metric, and those within ``reach`` are links.  ``weigh`` gives
    (node, total, own, spots) for a table of nodes: the weight of all parts of a node, of those that no
    other of these nodes has, and of the others by cell of a hash of the part (an array of one length
    for all nodes); ``far`` is then one less the weighted Jaccard similarity.

    First every node is tested against the smallest node of its buckets, so a bucket of many
    copies costs a pair for each, not for each two.  Where a bucket still holds several groups,
    nodes outside the group of a pivot are tested against it, for PIVOTS pivots a bucket.  What
    is left then are pairs of one bucket in different groups, neither of them a pivot.  All of them
    are tested, less those that surely are no links: their distances to the smallest node of the
    bucket differ by more than ``reach`` (triangle inequality), or what both may have in common,
    cell by cell the smaller weight of the parts that are not their own, is too little for the
    similarity.  The join compares these weights, so such pairs are never rows.
    """

    def tested(pairs: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """All measured pairs, and the links among them."""
        found = stage(measure(stage(pairs, f"{name}-pairs")), f"{name}-links")
        return found, (found if reach is None else found.where(F.col("far") <= reach)).select("a", "b")

    shared = stage(
        members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("rep")).where("n > 1").drop("n"),
        "buckets",
    )
    crowd = stage(
        only_possible(members, "bucket", shared).join(shared, "bucket"), "bucket-members"
    )
    pairs = crowd.where("node <> rep").select(F.col("node").alias("a"), F.col("rep").alias("b")).distinct()
    found, links = tested(pairs, "first")
    labels = stage(components(links), "first-labels")
    mixed = _mixed(crowd, labels)
    least = None if weigh is None else 1.0 - reach
    if weigh is not None:
        sums = stage(weigh(mixed.select("node").distinct()), "node-weights")
        # the others have too much of their own to be like any node
        sums = sums.where(F.col("total") - F.col("own") >= (least - _SLACK) * F.col("total"))
        crowd = stage(crowd.join(mixed.select("bucket").distinct(), "bucket").join(sums, "node"), "weighed")
        mixed = _mixed(crowd, labels)
    chosen = _smallest(mixed.select("bucket", F.xxhash64("node", F.lit(7)).alias("h"), F.col("node").alias("pivot"), "label"))
    chosen = stage(chosen, "pivots")
    pairs = (
        mixed.join(chosen.withColumnRenamed("label", "theirs"), "bucket")
        .where("label <> theirs")
        .select(F.greatest("node", "pivot").alias("a"), F.least("node", "pivot").alias("b"))
        .distinct()
    )
    _, more = tested(pairs, "second")
    links = links.unionByName(more)
    labels = stage(components(links), "second-labels")
    # nodes that have been measured against the whole bucket are done with
    done = chosen.select("bucket", F.col("pivot").alias("node"), F.lit(True).alias("done"))
    mixed = _mixed(crowd, labels).join(done, ["bucket", "node"], "left").where("done is null and node <> rep")
    if reach is None:
        near = mixed.withColumn("far", F.lit(0.0)).withColumn("cell", F.lit(0))
    else:
        far = found.select(F.col("a").alias("node"), F.col("b").alias("rep"), "far")
        near = mixed.join(far, ["node", "rep"]).withColumn("cell", F.floor(F.col("far") / reach).cast("int"))
    known = ["node", "label", "far", *(["total", "own", "spots"] if weigh else [])]
    near = stage(near.select("bucket", "cell", "top", *known), "mixed-buckets")
    cells = F.array(*([F.lit(0)] if reach is None else [F.col("cell") + k for k in (-1, 0, 1)]))
    small = near.where("label <> top").select(
        "bucket", F.explode(cells).alias("cell"), *[F.col(c).alias(f"{c}_x") for c in known], "top"
    )
    # two nodes outside the largest group meet from both sides; one of them is enough
    twice = (F.col("label") != F.col("top")) & (F.col("node_x") > F.col("node"))
    possible = F.abs(F.col("far_x") - F.col("far")) <= (reach or 0.0) + _SLACK
    if weigh is not None:
        # common >= least * (sum of totals - common), first by the smaller rest alone
        needed = (least - _SLACK) / (1 + least) * (F.col("total_x") + F.col("total"))
        possible &= F.least(F.col("total_x") - F.col("own_x"), F.col("total") - F.col("own")) >= needed
        shared_weight = F.aggregate(
            F.zip_with("spots_x", "spots", lambda x, y: F.least(x, y)), F.lit(0.0), lambda n, w: n + w
        )
        possible &= shared_weight >= needed
    rest = (
        small.drop("top")
        .join(near, ["bucket", "cell"])
        .where((F.col("label_x") != F.col("label")) & ~twice & possible)
        .select(F.greatest("node_x", "node").alias("a"), F.least("node_x", "node").alias("b"))
        .distinct()
    )
    _, more = tested(rest, "third")
    if more.isEmpty():
        return labels
    return components(links.unionByName(more))


def _mixed(crowd: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that hold several groups, with their ``label`` and the bucket's
    largest group ``top``."""
    known = crowd.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    sizes = known.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    tops = (
        sizes.groupBy("bucket")
        .agg(F.max(F.struct("n", "label")).alias("top"), F.count(F.lit(1)).alias("groups"))
        .where("groups > 1")
        .select("bucket", F.col("top.label").alias("top"))
    )
    return stage(known.join(tops, "bucket"), "several-groups")


def _smallest(members: DataFrame) -> DataFrame:
    """(bucket, pivot, label): the PIVOTS smallest of each bucket by hash, so that buckets of the same nodes
    share them.  One aggregation each; no bucket is sorted or gathered."""
    out, rest = None, members
    for _ in range(PIVOTS):
        low = rest.groupBy("bucket").agg(F.min(F.struct("h", "pivot", "label")).alias("low"))
        low = stage(low.select("bucket", F.col("low.h").alias("after"), "low.pivot", "low.label"), "pivot")
        found = low.select("bucket", "pivot", "label")
        out = found if out is None else out.unionByName(found)
        rest = rest.join(low.select("bucket", "after"), "bucket").where("h > after").drop("after")
    return out
