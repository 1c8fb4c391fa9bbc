"""Fallback, submission rows, their checks and the file they are written to."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from answerloom.functions.text import clean_strip
from answerloom.names import ID, SUBMISSION_COLUMNS
from answerloom.sources.staging import publish, remove
from answerloom.sources.tables import TEXT_ROWS, write_csv

MIN_CHARS = 5
_TARGETS = SUBMISSION_COLUMNS[1:]


def hybrid_fallback(
    df: DataFrame, generation: str, retrieved: str, min_chars: int = MIN_CHARS
) -> DataFrame:
    """Add ``prediction``: the stripped generation, or the retrieved answer when it
    has fewer than ``min_chars`` characters; and ``used_fallback``."""
    text = clean_strip(F.col(generation))
    short = F.length(text) < min_chars
    return df.withColumns(
        {
            "prediction": F.when(short, F.col(retrieved)).otherwise(text),
            "used_fallback": short,
        }
    )


def submission_rows(
    predictions: DataFrame, prediction: str = "prediction", *others: str
) -> DataFrame:
    """(ID, three equal targets, others); a blank prediction becomes one space."""
    text = clean_strip(F.col(prediction))
    answer = F.when(text == "", F.lit(" ")).otherwise(text)
    return predictions.select(ID, *[answer.alias(c) for c in _TARGETS], *others)


def align(ids: DataFrame, predictions: DataFrame) -> DataFrame:
    """Join predictions to ``ids`` by ID; raises unless they match one to one."""
    left = ids.select(ID).withColumn("n_ids", F.lit(1))
    right = predictions.select(ID).withColumn("n_predictions", F.lit(1))
    unmatched = (
        left.unionByName(right, allowMissingColumns=True)
        .groupBy(ID)
        .agg(F.count("n_ids").alias("i"), F.count("n_predictions").alias("p"))
        .where((F.col("i") != 1) | (F.col("p") != 1))
    )
    if not unmatched.isEmpty():
        raise ValueError("ids and predictions do not match one to one")
    return ids.join(predictions, ID)


def id_coverage(submission: DataFrame, sample: DataFrame) -> DataFrame:
    """(problem, ID) of missing and unexpected IDs."""
    got, want = submission.select(ID).distinct(), sample.select(ID).distinct()
    missing = want.join(got, ID, "left_anti").select(F.lit("missing").alias("problem"), ID)
    extra = got.join(want, ID, "left_anti").select(F.lit("unexpected").alias("problem"), ID)
    return missing.unionByName(extra)


def submission_check(submission: DataFrame, sample: DataFrame) -> DataFrame:
    """One row per check: (check, ok, expected, found, examples).

    IDs are counted on both sides in one aggregation; the three lowest offending
    IDs serve as examples.
    """
    same = submission.columns == sample.columns
    sides = submission.select(ID, F.lit(1).alias("got"), F.lit(0).alias("want")).unionByName(
        sample.select(ID, F.lit(0).alias("got"), F.lit(1).alias("want"))
    )
    per_id = sides.groupBy(ID).agg(
        F.sum("got").alias("got"), F.sum("want").alias("want")
    )
    rules = {
        "missing": (F.col("got") == 0) & (F.col("want") > 0),
        "unexpected": (F.col("want") == 0) & (F.col("got") > 0),
        "duplicate": F.col("got") > 1,
    }
    totals = per_id.agg(
        F.coalesce(F.sum("want"), F.lit(0)).alias("want_rows"),
        F.coalesce(F.sum("got"), F.lit(0)).alias("got_rows"),
        *[F.count_if(rule).alias(name) for name, rule in rules.items()],
    )
    examples = _lowest_ids(per_id, rules)

    def check(name: str, ok: Column, expected: Column, found: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check"),
            ok.alias("ok"),
            expected.cast("string").alias("expected"),
            found.cast("string").alias("found"),
        )

    rows = [
        check(
            "columns",
            F.lit(same),
            F.lit(",".join(sample.columns)),
            F.lit(",".join(submission.columns)),
        ),
        check(
            "row_count",
            F.col("want_rows") == F.col("got_rows"),
            F.col("want_rows"),
            F.col("got_rows"),
        ),
    ]
    rows += [check(n, F.col(n) == 0, F.lit(0), F.col(n)) for n in rules]
    return (
        totals.select(F.inline(F.array(*rows)))
        .join(examples, "check", "left")
        .select("check", "ok", "expected", "found", F.coalesce("ids", F.lit("")).alias("examples"))
    )


def _lowest_ids(per_id: DataFrame, rules: dict[str, Column], n: int = 3) -> DataFrame:
    """(check, ids): the ``n`` lowest IDs per broken rule, by top-n instead of a set."""
    parts = [
        per_id.where(rule).select(F.lit(name).alias("check"), ID).orderBy(ID).limit(n)
        for name, rule in rules.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.groupBy("check").agg(
        F.array_join(F.sort_array(F.collect_list(ID)), ",").alias("ids")
    )


def submission_targets_check(submission: DataFrame, expected_rows: DataFrame) -> DataFrame:
    """(rows, expected_rows, null_targets, differing_targets, ok) in one row."""
    a, b, c = (F.col(x) for x in _TARGETS)
    null = a.isNull() | b.isNull() | c.isNull()
    differ = ~(a.eqNullSafe(b) & a.eqNullSafe(c))
    found = submission.agg(
        F.count("*").alias("rows"),
        F.count_if(null).alias("null_targets"),
        F.count_if(differ).alias("differing_targets"),
    )
    want = expected_rows.agg(F.count("*").alias("expected_rows"))
    both = found.withColumn("k", F.lit(1)).join(want.withColumn("k", F.lit(1)), "k")
    ok = (
        (F.col("rows") == F.col("expected_rows"))
        & (F.col("null_targets") == 0)
        & (F.col("differing_targets") == 0)
    )
    return both.drop("k").withColumn("ok", ok)


def validate_submission(submission: DataFrame, sample: DataFrame) -> None:
    """Raise with all failed checks unless the submission fits the sample."""
    broken = submission_check(submission, sample).where(~F.col("ok")).collect()
    if broken:
        raise ValueError(
            "; ".join(
                f"{r['check']}: expected {r['expected']}, found {r['found']}"
                + (f" (e.g. {r['examples']})" if r["examples"] else "")
                for r in broken
            )
        )


def make_submission(
    predictions: DataFrame,
    sample: DataFrame,
    path: str,
    prediction: str = "prediction",
    fmt: str = "csv",
) -> None:
    """Write, audit, publish: targets for every ID of ``sample`` in directory ``path``.

    Predictions are aligned by ID and blanks filled while a draft is written; the job that writes it
    also counts missing, unexpected and repeated IDs and rows with unequal targets.  Only if all
    are zero the draft gets its name, else it is deleted and the counts are raised.  ``path``
    must not exist.
    """
    spark = sample.sparkSession
    sides = predictions.select(
        ID, F.struct(F.col(prediction).alias("p")).alias("p"), F.lit(1).alias("got"), F.lit(0).alias("want")
    ).unionByName(
        sample.select(
            ID, F.lit(None).cast("struct<p:string>").alias("p"), F.lit(0).alias("got"), F.lit(1).alias("want")
        )
    )
    per_id = sides.groupBy(ID).agg(
        F.first("p", ignorenulls=True)["p"].alias("text"), F.sum("got").alias("got"), F.sum("want").alias("want")
    )
    rows = submission_rows(per_id, "text", "got", "want")
    audit = Observation("submission")
    a, b, c = (F.col(x) for x in _TARGETS)
    watched = rows.observe(
        audit,
        F.count_if(F.col("got") == 0).alias("missing"),
        F.count_if(F.col("want") == 0).alias("unexpected"),
        F.count_if((F.col("got") > 1) | (F.col("want") > 1)).alias("repeated"),
        F.count_if(F.col(ID).isNull()).alias("without_id"),
        F.count_if(a.isNull() | ~(a.eqNullSafe(b) & a.eqNullSafe(c))).alias("unequal_targets"),
    )
    draft = f"{path.rstrip('/')}.draft-{uuid.uuid4().hex}"
    write_submission(watched, draft, fmt)
    wrong = {k: n for k, n in audit.get.items() if n}
    if wrong:
        remove(spark, draft)
        raise ValueError(f"no submission written: {wrong}")
    try:
        publish(spark, draft, path)
    except ValueError:
        remove(spark, draft)
        raise


def write_submission(
    submission: DataFrame, path: str, fmt: str = "csv", one_file: bool = False
) -> None:
    """Write to directory ``path``, creating parents. ``one_file`` suits small sets."""
    out = submission.select(*SUBMISSION_COLUMNS)
    if one_file:
        out = out.coalesce(1)
    if fmt == "csv":
        write_csv(out, path, "overwrite", 0 if one_file else TEXT_ROWS)
    else:
        out.write.mode("overwrite").format(fmt).save(path)
