"""Quality by importance resampling: hashed n-gram models, Gumbel top-k.

A text's log weight is the sum, over its hashed token unigrams and bigrams, of the log ratio
of two generative models: target (documents labelled good) and raw (all documents).
Gumbel noise added to log weights makes the top k a sample by weight without replacement.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.llm.frames import fresh, let, text_of, whole_row
from answerloom.llm.splitters import find_cuts
from answerloom.sources.staging import stage

BUCKETS = 4096
_TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+"


def ngram_buckets(text: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of the tokens and of neighbouring pairs; a token said twice is one feature."""

    def both(tokens: Column) -> Column:
        ones = F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(buckets)).cast("int"))
        twice = F.pmod(F.xxhash64(F.lit("twice"), F.lit(2)), F.lit(buckets)).cast("int")
        pairs = F.transform(
            F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0))),
            lambda t, i: F.when(t == F.get(tokens, i), twice).otherwise(
                F.pmod(F.xxhash64(F.get(tokens, i), t), F.lit(buckets)).cast("int")
            ),
        )
        return F.concat(ones, pairs)

    return let(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), both)


def _counts(docs: DataFrame, column: str, buckets: int) -> list[int]:
    """n-grams of each bucket over all rows."""
    rows = docs.select(F.explode(column).alias("b")).groupBy("b").count().collect()
    out = [0] * buckets
    for r in rows:
        out[r["b"]] = r["count"]
    return out


def log_ratios(target: list[int], raw: list[int], prior: float) -> list[float]:
    """log(target / raw) by bucket; ``prior`` n-grams of the raw model smooth the target."""
    n_target, n_raw, b = sum(target), sum(raw), len(raw)
    out = []
    for t, r in zip(target, raw, strict=True):
        p_raw = (r + 1.0) / (n_raw + b)
        p_target = (t + prior * p_raw) / (n_target + prior)
        out.append(math.log(p_target / p_raw))
    return out


def log_weight(text: Column, ratios: list[float]) -> Column:
    """Sum of log ratios over a text's n-grams; 0 without any."""
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    return F.aggregate(
        ngram_buckets(text, len(ratios)), F.lit(0.0), lambda a, b: a + F.get(table, b)
    )


def best_threshold(scored: list[tuple[float, bool]], harm: float = 5.0) -> float:
    """Log weight at which rejecting everything below costs least on labelled texts.

    Rejecting a good text counts ``harm`` times as much as keeping a bad one.  Of equal
    cuts the middle of the widest gap wins; without bad texts nothing is rejected.
    """
    rows = sorted(scored)
    cost = sum(1.0 for _, good in rows if not good)
    best = (cost, 0.0, -math.inf)
    for i, (value, good) in enumerate(rows):
        cost += harm if good else -1.0
        above = rows[i + 1][0] if i + 1 < len(rows) else value + 1.0
        gap = above - value
        if gap > 0:
            best = min(best, (cost, -gap, value + gap / 2))
    return best[2]


def importance_resample(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
    labelled_rows: int = 50_000,
    k: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """``docs`` with ``log_weight``, ``gumbel_score`` and ``kept`` (a name that is taken gets a
    leading underscore).

    ``labels`` has doc_id and quality (1 good, 0 bad; optional toxic).  The raw model and all scores
    cover every document.  The target model and the threshold use at most about
    ``labelled_rows`` labelled documents, picked by a hash of the id: one half fits the
    model, the other half gives the cut between good and bad log weights.  ``k``, if not given, is
    the number of documents at or above the cut.  Kept are the ``k`` documents of highest
    log weight plus Gumbel noise; the noise depends on seed, id and text only, so reruns agree
    and repeated rows share their fate.  Documents without a token (null or empty) are
    never kept.  Without labels of both kinds every document with a token is kept.
    """
    names = fresh(docs, "log_weight", "gumbel_score", "kept")
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) if "toxic" in labels.columns else F.lit(0)
    marks = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("id"))
        .agg(F.min("quality").alias("quality"), F.max(toxic).alias("toxic"))
    )
    marked = max(1, marks.count())
    pick = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1_000_003))
    share = min(1_000_003, int(1_000_003 * labelled_rows / marked) + 1)
    # at most about labelled_rows rows of three numbers
    sample = F.broadcast(stage(marks.where(pick < share), "importance-labels"))
    plain = docs.select(F.col(doc_id).cast("bigint").alias("id"), text_of(text).alias("body"))
    known = stage(
        plain.join(sample, "id").withColumn("grams", ngram_buckets(F.col("body"), buckets)).select(
            "quality",
            "toxic",
            "grams",
            F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(2)).alias("half"),
        ),
        "importance-known",
    )
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    raw = _counts(plain.select(ngram_buckets(F.col("body"), buckets).alias("grams")), "grams", buckets)
    target = _counts(known.where(good & (F.col("half") == 0)), "grams", buckets)
    # smoothing must not outweigh what a small sample of labels says
    ratios = log_ratios(target, raw, prior=max(1.0, min(8.0 * buckets, sum(target) / 4.0)))
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    value = F.aggregate("grams", F.lit(0.0), lambda a, b: a + F.get(table, b))
    held = (
        known.where((F.col("half") == 1) & (F.size("grams") > 0))
        .select(value.alias("v"), (F.col("quality") == 1).alias("good"))
        .collect()
    )
    cut = -math.inf
    if any(r["good"] for r in held) and not all(r["good"] for r in held) and sum(target):
        cut = best_threshold([(r["v"], r["good"]) for r in held])

    # uniform in (0, 1) from 52 bits of a hash
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed + 2), "id", F.xxhash64("body")), 12)
    uniform = (bits.cast("double") + 0.5) / float(2**52)
    gumbel = -F.log(-F.log(uniform))
    has = F.col("body").rlike(r"[^\s]")
    scored = docs.select(
        F.col(doc_id).cast("bigint").alias("id"), text_of(text).alias("body"), whole_row(docs).alias("row")
    ).select(
        "row",
        has.alias("has"),
        log_weight(F.col("body"), ratios).alias("log_weight"),
        gumbel.alias("noise"),
        F.xxhash64("id", F.xxhash64("body")).alias("tie"),
    )
    slim = stage(scored.select("has", "log_weight", "noise", "tie"), "importance-scores")
    # best first: documents without a token last, then score, then a hash
    keys = {
        "k0": F.when(F.col("has"), 0).otherwise(1).cast("bigint"),
        "k1": -F.floor((F.col("log_weight") + F.col("noise")) * 1e6).cast("bigint"),
        "k2": F.shiftright("tie", 32).cast("bigint"),
        "k3": F.col("tie").bitwiseAND(F.lit(2**32 - 1)),
    }
    tokens = slim.where("has")
    most = tokens.count() if cut == -math.inf else tokens.where(F.col("log_weight") >= cut).count()
    if k is not None:
        most = min(k, tokens.count())
    cuts = find_cuts(
        slim.withColumns(keys).withColumn("one", F.lit(1).cast("bigint")),
        list(keys),
        "one",
        lambda total, rows: [most],
    )
    return cuts.place(scored.withColumns(keys), "piece").select(
        "row.*",
        F.col("log_weight").alias(names[0]),
        (F.col("log_weight") + F.col("noise")).alias(names[1]),
        (F.col("has") & (F.col("piece") == 0)).alias(names[2]),
    )
