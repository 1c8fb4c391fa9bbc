"""Experiment analytics over long tables of (run, key, value) settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from answerloom.functions.arrays import records
from answerloom.names import SUBSET
from answerloom.sources.staging import stage

# Settings every run derives from its own name.
DERIVED = ["notes", "output_dir", "run_name", "submission_path"]


def resolve_configs(base: DataFrame, runs: DataFrame, overrides: DataFrame) -> DataFrame:
    """(run, key, value, source): base settings, overrides, then derived ones.

    ``base`` (key, value), ``runs`` (run, hypothesis), ``overrides`` (run, key,
    value). An override wins when it is present, even with a null value. Keys that
    ``base`` lacks come back with source 'unknown'.
    """
    name = F.col("run")
    folder = F.concat(F.lit("artifacts/"), name)
    derived = runs.select(
        "run",
        F.inline(
            records(
                ("key", "value"),
                (F.lit("run_name"), name),
                (F.lit("output_dir"), folder),
                (F.lit("submission_path"), F.concat(folder, F.lit("/submission.csv"))),
                (F.lit("notes"), F.col("hypothesis")),
            )
        ),
    )
    plain = overrides.where(~F.col("key").isin(DERIVED))
    unknown = overrides.join(base.select("key"), "key", "left_anti")
    # every run gets every base key; the key list is part of the base table
    keys = base.where(~F.col("key").isin(DERIVED)).agg(
        F.collect_list(F.struct("key", F.col("value").alias("base_value"))).alias("base")
    )
    settings = runs.select("run", F.lit(1).alias("k")).join(
        keys.withColumn("k", F.lit(1)), "k"
    )
    merged = (
        settings.select("run", F.inline("base"))
        .join(plain.withColumn("given", F.lit(True)), ["run", "key"], "left")
        .select(
            "run",
            "key",
            F.when(F.col("given"), F.col("value")).otherwise(F.col("base_value")).alias("value"),
            F.when(F.col("given"), "override").otherwise("base").alias("source"),
        )
    )
    return merged.unionByName(
        derived.withColumn("source", F.lit("derived"))
    ).unionByName(
        unknown.select("run", "key", "value", F.lit("unknown").alias("source"))
    )


def require_known_keys(base: DataFrame, overrides: DataFrame) -> None:
    """Raise when an override names a setting that ``base`` does not have."""
    unknown = overrides.join(base.select("key"), "key", "left_anti").select("key").distinct()
    names = [r["key"] for r in unknown.orderBy("key").limit(20).collect()]
    if names:
        raise ValueError(f"{unknown.count()} unknown settings, among them {names}")


def typed(value: Column) -> Column:
    """A setting as VARIANT: JSON keeps its type, any other text is a string, null stays null."""
    return F.coalesce(F.try_parse_json(value), value.cast("variant"))


def setting_types(settings: DataFrame) -> DataFrame:
    """(key, type, runs) of all settings, so that a run with another type stands out."""
    kind = F.coalesce(F.schema_of_variant(typed(F.col("value"))), F.lit("VOID"))
    return settings.groupBy("key", kind.alias("type")).agg(F.count("*").alias("runs"))


def changed_fields(base: DataFrame, resolved: DataFrame, runs: DataFrame) -> DataFrame:
    """(run, changed_fields): JSON of the settings that differ, keys sorted.

    Numbers, booleans and nulls are written as such, and ``1`` and ``01`` or ``{"a": 1}``
    and ``{"a":1}`` are the same setting where JSON says so.
    """
    was = base.select("key", F.col("value").alias("was"))
    now, before = (F.to_json(typed(F.col(c))) for c in ("value", "was"))
    delta = (
        resolved.where(~F.col("key").isin(DERIVED))
        .join(was, "key")
        .where(~now.eqNullSafe(before))
        .groupBy("run")
        .agg(F.sort_array(F.collect_list(F.struct("key", "value"))).alias("d"))
    )
    entries = F.transform("d", lambda e: F.struct(e["key"].alias("key"), typed(e["value"]).alias("value")))
    text = F.to_json(F.map_from_entries(entries), {"ignoreNullFields": "false"})
    return runs.select("run").join(delta, "run", "left").select(
        "run", F.coalesce(text, F.lit("{}")).alias("changed_fields")
    )


def per_subset_json(by_subset: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """JSON map subset -> combined (four digits), weakest first."""
    entry = F.struct(F.round("combined", 4).alias("v"), F.col(SUBSET).alias("s"))
    ordered = F.transform(
        F.sort_array(F.collect_list(entry)),
        lambda e: F.struct(e["s"].alias("key"), e["v"].alias("value")),
    )
    grouped = by_subset.groupBy(*(keys or [])).agg(ordered.alias("m"))
    # no subset at all leaves the field empty
    text = F.when(F.size("m") > 0, F.to_json(F.map_from_entries("m")))
    return grouped.select(*(keys or []), text.alias("per_language"))


def run_log_row(
    runs: DataFrame, overall: DataFrame, per_language: DataFrame, changed: DataFrame
) -> DataFrame:
    """Log rows: ``runs`` (run, title, hypothesis, model_name) with their scores."""
    stamp = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return (
        runs.join(overall, "run")
        .join(per_language, "run", "left")
        .join(changed, "run", "left")
        .select(
            stamp.alias("timestamp"),
            F.col("run").alias("key"),
            "title",
            "hypothesis",
            F.coalesce("changed_fields", F.lit("{}")).alias("changed_fields"),
            "model_name",
            F.round("rouge1_f1", 4).alias("rouge1_f1"),
            F.round("rougeL_f1", 4).alias("rougeL_f1"),
            F.round("combined", 4).alias("combined"),
            F.lit("").alias("public_lb"),
            "per_language",
        )
    )


def runs_by_subset(log: DataFrame) -> DataFrame:
    """(key, subset, combined) exploded from the JSON map of each logged run."""
    scores = F.from_json("per_language", "map<string,double>")
    return log.select("key", F.explode(scores).alias(SUBSET, "combined"))


def rank_runs(log: DataFrame) -> DataFrame:
    """Add ``rank`` by combined score, best first; equal scores share a rank.

    A run without a score (null or NaN) ranks after all others.  The rank of a score is one
    plus the runs above it.  Distinct scores are dealt to ranges; inside a range they are
    counted by window, across ranges over one row each, so nothing is sorted in one task.
    """
    score = F.col("combined").cast("double")
    keyed = log.withColumn("_score", F.nanvl(score, F.lit(None).cast("double")))
    scores = (
        keyed.groupBy("_score")
        .agg(F.count("*").alias("n"))
        .repartitionByRange(F.desc_nulls_last("_score"))
        .withColumn("part", F.spark_partition_id())
    )
    scores = stage(scores, "scores")
    parts = scores.groupBy("part").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy(F.lit(1)).orderBy("part")
    starts = parts.select("part", (F.sum("n").over(earlier) - F.col("n")).alias("start"))
    above = Window.partitionBy("part").orderBy(F.desc_nulls_last("_score"))
    ranks = scores.join(starts, "part").select(
        F.col("_score").alias("_other"),
        (F.col("start") + F.sum("n").over(above) - F.col("n") + 1).alias("rank"),
    )
    return keyed.join(ranks, F.col("_score").eqNullSafe(F.col("_other"))).select(*log.columns, "rank")


def _real(metric: str, greater: bool = True) -> Column:
    """The metric, so that greater is better; NaN is no value."""
    value = F.nanvl(F.col(metric).cast("double"), F.lit(None).cast("double"))
    return value if greater else -value


def best_checkpoint(history: DataFrame, greater: bool = True) -> DataFrame:
    """(run, best_epoch, best_metric); earliest epoch on ties.

    ``greater`` false takes the smallest metric.  Epochs whose metric is null or NaN are
    no candidates; a run of such epochs only has nulls.
    """
    known = F.when(F.col("m").isNotNull(), F.struct("m", (-F.col("epoch")).alias("neg"), "metric"))
    return (
        history.withColumn("m", _real("metric", greater))
        .groupBy("run")
        .agg(F.max(known).alias("t"))
        .select("run", (-F.col("t.neg")).alias("best_epoch"), F.col("t.metric").alias("best_metric"))
    )


def early_stop_epoch(
    history: DataFrame, patience: int = 2, block: int = 50_000, greater: bool = True
) -> DataFrame:
    """(run, stop_epoch): first epoch ending ``patience`` evaluations in a row that
    do not beat the best so far; null when training runs on.

    ``history`` is (run, integer epoch, metric); a null or NaN metric beats nothing. A run is worked off in blocks of
    epochs: inside a block by window, across blocks over one summary row each, so
    a run of any length never lands in one task.
    """
    runs = history.select("run").distinct()
    if patience <= 0:
        return runs.withColumn("stop_epoch", F.lit(None).cast("long"))
    blocks = Window.partitionBy("run").orderBy("block")
    inside = Window.partitionBy("run", "block").orderBy("epoch")
    earlier_blocks = blocks.rowsBetween(Window.unboundedPreceding, -1)
    earlier_rows = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows_so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    placed = history.withColumns(
        {"block": F.floor(F.col("epoch") / block), "metric": _real("metric", greater)}
    )
    best = placed.groupBy("run", "block").agg(F.max("metric").alias("m"))
    best = best.select("run", "block", F.max("m").over(earlier_blocks).alias("best"))
    before = F.greatest("best", F.max("metric").over(earlier_rows))
    # misses since the last improvement in the block, or since the block began
    judged = (
        placed.join(best, ["run", "block"])
        .withColumn("before", before)
        .withColumn(
            "better",
            F.col("metric").isNotNull()
            & (F.col("before").isNull() | (F.col("metric") > F.col("before"))),
        )
        .withColumn("nth", F.row_number().over(inside))
        .withColumn("last", F.max(F.when(F.col("better"), F.col("nth"))).over(rows_so_far))
        .withColumn("misses", F.col("nth") - F.coalesce("last", F.lit(0)))
    )
    # misses carried into a block: tails of the blocks since the last improvement
    upto = blocks.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tails = (
        judged.groupBy("run", "block")
        .agg(
            F.max_by("misses", "nth").alias("tail"),
            F.bool_or("better").alias("improved"),
        )
        .withColumn("sum", F.sum("tail").over(upto))
        .withColumn(
            "reset", F.max(F.when(F.col("improved"), F.col("sum") - F.col("tail"))).over(upto)
        )
        .withColumn("out", F.col("sum") - F.col("reset"))
        .select("run", "block", F.coalesce(F.lag("out").over(blocks), F.lit(0)).alias("carry"))
    )
    carried = F.when(F.col("last").isNull(), F.col("carry")).otherwise(F.lit(0))
    stops = (
        judged.join(tails, ["run", "block"])
        .where(F.col("misses") + carried >= patience)
        .groupBy("run")
        .agg(F.min("epoch").alias("stop_epoch"))
    )
    return runs.join(stops, "run", "left")


def leaderboard_progression(progression: DataFrame, log: DataFrame) -> DataFrame:
    """Submissions with the local scores of the run they came from."""
    local = log.select(
        F.col("key").alias("experiment_key"), "rouge1_f1", "rougeL_f1", "combined"
    )
    return progression.join(local, "experiment_key", "left")
