"""A retrieval index in a folder: raw segments, fitted versions and a manifest for each.

A segment holds what a set of rows adds: its distinct questions, and
its part of the term and row counts.  All of that is additive, so appending counts the new
rows only; document frequencies, sizes and copies are merged by sums.  The weights
depend on all counts and are fitted anew from the stored term counts; old questions are put into
blocks again, their terms are not counted again.  A version becomes visible by its manifest, which is written last; readers of an
earlier version are not disturbed.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.functions.text import clean_text
from answerloom.names import ID, QUESTION, SUBSET
from answerloom.operators import retrieval
from answerloom.operators.corpus import subset_or_null
from answerloom.operators.retrieval import EVERYTHING, Index, own_index
from answerloom.sources.staging import TEXT_CODEC, publish_text, scratch, stage

_FITTED = ("groups", "sizes", "terms", "blocks")


def manifests(spark: SparkSession, path: str) -> dict[int, dict]:
    """Every published version with its manifest."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return {}
    names = [s.getPath().toString() for s in fs.listStatus(root) if s.getPath().getName().startswith("manifest-") and "." not in s.getPath().getName()]
    found = [json.loads(r[0]) for r in spark.read.text(names, wholetext=True).collect()] if names else []
    return {m["version"]: m for m in found}


def _write_segment(train: DataFrame, folder: str) -> None:
    """What these rows add to an index."""
    asked = train.select(
        F.coalesce(subset_or_null(train), F.lit("")).alias("subset"),
        F.col(ID),
        clean_text(F.col(QUESTION)).alias("q"),
    )
    entries = asked.groupBy("subset", F.md5("q").alias("key")).agg(
        F.first("q").alias("q"), F.count("*").alias("copies"), F.min(ID).alias("tid")
    )
    with scratch(train.sparkSession):
        numbered = retrieval.number_entries(entries.withColumnRenamed("subset", "grp"), "entries")
        named = {"grp": "subset"}
        numbered.drop("size", "eid").withColumnsRenamed(named).write.parquet(f"{folder}/entries")
        retrieval.text_stats(numbered).withColumnsRenamed(named).write.parquet(f"{folder}/stats")
    retrieval.answer_rows(train).write.parquet(f"{folder}/rows", compression=TEXT_CODEC)


def _segments(spark: SparkSession, path: str, manifest: dict, table: str) -> DataFrame:
    return spark.read.parquet(*[f"{path}/segments/{n}/{table}" for n in manifest["segments"]])


def _by_index(table: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of subsets as rows of their own index and of the one over everything."""
    own = groups.select(F.col(SUBSET).alias("own"))
    both = F.array_compact(F.array(own_index(F.col("own")), F.lit(EVERYTHING)))
    return table.join(own, F.col("subset") == F.col("own"), "left").withColumn("grp", F.explode(both)).drop("own")


def _fit(spark: SparkSession, path: str, manifest: dict) -> None:
    """Write the fitted tables of a version."""

    def save(table: DataFrame, name: str) -> DataFrame:
        to = f"{path}/fitted/{manifest['version']}/{name}"
        table.write.mode("overwrite").parquet(to)
        return spark.read.schema(table.schema).parquet(to)

    entries = _segments(spark, path, manifest, "entries")
    sizes = entries.where("subset <> ''").groupBy("subset").agg(F.sum("copies").alias("n"))
    groups = save(sizes.where("n >= 2").select(F.col("subset").alias(SUBSET)), "groups")
    merged = (
        _by_index(entries, groups)
        .groupBy("grp", "key")
        .agg(
            F.first("q").alias("q"),
            F.sum("copies").alias("copies"),
            F.min("tid").alias("tid"),
        )
    )
    numbered = retrieval.number_entries(merged, "entries")
    stats = (
        _by_index(_segments(spark, path, manifest, "stats"), groups)
        .groupBy("grp", "gram")
        .agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))
    )
    rows = _segments(spark, path, manifest, "rows")
    retrieval.fit(groups, numbered, stage(stats, "stats"), rows, manifest["cap"], save)


def _publish(spark: SparkSession, path: str, manifest: dict) -> None:
    with scratch(spark):
        _fit(spark, path, manifest)
    publish_text(spark, f"{path}/manifest-{manifest['version']}", json.dumps(manifest))


def save_index(train: DataFrame, path: str, cap: int | None = retrieval.VOCABULARY) -> None:
    """Write a new index over ``train`` (unique ``ID``) to a folder without one."""
    spark = train.sparkSession
    if manifests(spark, path):
        raise ValueError(f"{path} already holds an index")
    _write_segment(train, f"{path}/segments/1")
    _publish(spark, path, {"version": 1, "segments": [1], "cap": cap})


def append_rows(train: DataFrame, path: str) -> int:
    """Add rows with new IDs as the next version, and return its number."""
    spark = train.sparkSession
    known = manifests(spark, path)
    if not known:
        raise ValueError(f"{path} holds no index")
    last = known[max(known)]
    old = _segments(spark, path, last, "rows").select(F.col("tid").alias(ID))
    if not train.join(old, ID, "left_semi").isEmpty():
        raise ValueError("rows with these IDs are in the index already")
    version = last["version"] + 1
    # a failed attempt leaves a segment that no manifest names
    folder = f"{path}/segments/{version}"
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)
    _write_segment(train, folder)
    _publish(spark, path, last | {"version": version, "segments": [*last["segments"], version]})
    return version


def load_index(spark: SparkSession, path: str, version: int | None = None) -> Index:
    """The latest published version, or the given one; nothing is computed."""
    known = manifests(spark, path)
    if not known or version is not None and version not in known:
        raise ValueError(f"{path} holds no index" + (f" of version {version}" if version else ""))
    manifest = known[version or max(known)]
    fitted = {n: spark.read.parquet(f"{path}/fitted/{manifest['version']}/{n}") for n in _FITTED}
    return Index(**fitted, rows=_segments(spark, path, manifest, "rows"))
