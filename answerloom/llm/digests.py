"""Exact deduplication: sorted runs of digests, merged along a tree of partitions.

Every partition folds its rows to a sorted run with one entry for each digest.  Then runs
are exchanged in rounds: in round ``k`` each partition keeps the entries whose home has its
own ``k``-th digit and sends the others to the partitions that differ from it in that
digit only, so a partition merges ``FAN`` sorted runs a round.  After the last round an entry
is at its home, and no partition ever held more than its share of the digests.  An entry
travels once however many rows it stands for, so a text that fills a third of the table is
``FAN`` entries in each merge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.llm.frames import text_of
from answerloom.sources.staging import stage

#: Runs that meet in one merge.
FAN = 4
#: Characters that do not count when texts are compared.
BLANKS = " \t\n\x0b\x0c\r"

_RUN = (
    "part int, digest binary, size bigint, lack bigint, void int, id bigint, row bigint, copies bigint"
)
#: Of one text the first entry in this order is the one that stays.
_ORDER = ["part", "digest", "size", "lack", "void", "id", "row"]


def squeezed(text: Column) -> Column:
    """The text less its blanks."""
    return F.translate(text, BLANKS, "")


def _starts(batch: pa.RecordBatch) -> np.ndarray:
    """Whether a row has another (part, digest, size) than the row before it."""
    digest = batch.column("digest")
    first = digest.offset
    at = np.frombuffer(digest.buffers()[1], dtype=np.int32)[first]
    words = np.frombuffer(digest.buffers()[2], dtype=np.uint64, count=4 * len(digest), offset=int(at))
    words = words.reshape(-1, 4)
    out = np.ones(len(digest), dtype=bool)
    out[1:] = (words[1:] != words[:-1]).any(axis=1)
    for name in ("part", "size"):
        value = batch.column(name).to_numpy()
        out[1:] |= value[1:] != value[:-1]
    return out


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One entry for each text of a sorted partition: its first row, with all copies."""
    last = None
    for batch in batches:
        if last is not None:
            batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        at = np.flatnonzero(_starts(batch))
        copies = np.add.reduceat(batch.column("copies").to_numpy(), at)
        kept = batch.take(pa.array(at))
        kept = kept.set_column(kept.schema.get_field_index("copies"), "copies", pa.array(copies))
        # the last entry may go on in the next batch
        last = kept.slice(len(at) - 1)
        yield kept.slice(0, len(at) - 1)
    if last is not None:
        yield last


def _sorted_runs(entries: DataFrame) -> DataFrame:
    return entries.sortWithinPartitions(*_ORDER).mapInArrow(_fold, _RUN)


def tree_merge(runs: DataFrame, leaves: int) -> DataFrame:
    """Merge the runs of ``leaves`` partitions (a power of ``FAN``) to one entry a digest."""
    step = 1
    while step < leaves:
        home = F.pmod(F.xxhash64("digest"), F.lit(leaves)).cast("int")

        def digit(x: Column) -> Column:
            return F.pmod(F.floor(x / step), F.lit(FAN)).cast("int")  # noqa: B023

        moved = F.col("part") + (digit(home) - digit(F.col("part"))) * step
        dealt = runs.withColumn("part", moved).repartitionById(leaves, "part")
        runs = _sorted_runs(dealt.select(*[c.split()[0] for c in _RUN.split(", ")]))
        step *= FAN
    return runs


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row for each row of ``docs``.

    Texts are equal when they are identical less their blanks; SHA-256 and length in bytes of
    what is left must both agree.  The row with the most code points in its original text
    stays, then the one with the smallest id, null ids last; of rows that repeat both, one.
    A null text is empty, and empty texts are equal to each other.  Other columns of
    ``docs`` are not read, so their names cannot clash.
    """
    spark = docs.sparkSession
    leaves = FAN
    while leaves < int(spark.conf.get("spark.sql.shuffle.partitions")):
        leaves *= FAN
    body, bare = text_of(text), squeezed(text_of(text)).cast("binary")
    rows = stage(
        docs.select(
            F.pmod(F.spark_partition_id(), F.lit(leaves)).alias("part"),
            F.unhex(F.sha2(bare, 256)).alias("digest"),
            F.octet_length(bare).cast("bigint").alias("size"),
            (-F.length(body)).cast("bigint").alias("lack"),
            F.isnull(doc_id).cast("int").alias("void"),
            F.col(doc_id).cast("bigint").alias("id"),
            F.monotonically_increasing_id().alias("row"),
            F.lit(1).cast("bigint").alias("copies"),
        ),
        "digest-rows",
    )
    leaf_runs = stage(_sorted_runs(rows), "leaf-runs")
    groups = (
        tree_merge(leaf_runs, leaves)
        .where("copies > 1")
        .select("digest", "size", F.col("id").alias("keep_id"), F.col("row").alias("keep"), "copies")
    )
    # answers go back to the leaves: a digest has one in each, however many rows; the rows of a
    # leaf may have been folded by several tasks
    answers = leaf_runs.select("part", "digest", "size").join(groups, ["digest", "size"]).distinct()
    many = F.col("copies").isNotNull()
    return (
        rows.drop("copies")
        .join(answers, ["part", "digest", "size"], "left")
        .select(
            F.col("id").alias("doc_id"),
            F.when(many, F.col("keep_id")).otherwise(F.col("id")).alias("keep_id"),
            F.coalesce("copies", F.lit(1)).cast("bigint").alias("group_size"),
            F.when(many, F.col("row") == F.col("keep")).otherwise(True).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )
