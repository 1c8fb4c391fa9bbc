"""ROUGE-1 / ROUGE-L per row and averaged. ``ID`` aligns texts, not position."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.functions.arrays import records
from answerloom.functions.rouge import common_tokens, f1
from answerloom.functions.text import tokenize_ws
from answerloom.names import ANSWER, SUBSET
from answerloom.sources.staging import small_batches

DIGITS = 6


def score_pairs(df: DataFrame, prediction: str, reference: str = ANSWER) -> DataFrame:
    """Add ``rouge1_f1`` and ``rougeL_f1`` of each row, in place: no shuffle."""
    p, r = F.col("__p"), F.col("__r")
    return (
        small_batches(df).withColumns(
            {"__p": tokenize_ws(F.col(prediction)), "__r": tokenize_ws(F.col(reference))}
        )
        .withColumn("__n", common_tokens(p, r))
        .withColumn("rouge1_f1", f1(F.col("__n.overlap"), F.size(p), F.size(r)))
        .withColumn("rougeL_f1", f1(F.col("__n.lcs"), F.size(p), F.size(r)))
        .drop("__p", "__r", "__n")
    )


def mean_scores(digits: int | None = DIGITS) -> list[Column]:
    """Mean scores, rounded where they are a result; None where they are computed on."""
    r1 = F.coalesce(F.avg("rouge1_f1"), F.lit(0.0))
    rl = F.coalesce(F.avg("rougeL_f1"), F.lit(0.0))
    means = {"rouge1_f1": r1, "rougeL_f1": rl, "combined": (r1 + rl) * 0.5}
    return [(c if digits is None else F.round(c, digits)).alias(n) for n, c in means.items()]


def rouge_overall(scored: DataFrame) -> DataFrame:
    """One row of mean scores; zeros for an empty table."""
    return scored.agg(*mean_scores())


def rouge_by_subset(scored: DataFrame, by: str = SUBSET) -> DataFrame:
    """Mean scores and row count per subset, weakest first; null subsets are out."""
    return (
        scored.where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(F.count("*").alias("count"), *mean_scores())
        .orderBy("combined", by)
    )


def rouge_report(scored: DataFrame, by: str = SUBSET) -> DataFrame:
    """(level, subset, count, means): all rows, then each subset, weakest first, in one pass.

    Rows without a subset count overall only; an empty table has no report.
    """
    grouped = scored.groupingSets([[by], []], by)
    level = F.when(F.grouping_id() == 0, "subset").otherwise("overall")
    return (
        grouped.agg(level.alias("level"), F.count("*").alias("count"), *mean_scores())
        .where((F.col("level") == "overall") | F.col(by).isNotNull())
        .select("level", by, "count", "rouge1_f1", "rougeL_f1", "combined")
        .orderBy("level", "combined", by)
    )


def rouge_by_method(scored: DataFrame) -> DataFrame:
    """One row per ``method`` over the same rows: the baseline comparison."""
    return scored.groupBy("method").agg(F.count("*").alias("count"), *mean_scores())


def compare_baselines(
    df: DataFrame, predictions: Mapping[str, str], reference: str = ANSWER
) -> DataFrame:
    """Score several prediction columns (method name -> column) in one pass."""
    methods = records(
        ("method", "prediction"),
        *[(F.lit(name), F.col(c)) for name, c in predictions.items()],
    )
    long = df.select(F.col(reference).alias("reference"), F.inline(methods))
    return rouge_by_method(score_pairs(long, "prediction", "reference"))
