"""Quality rules as a short-circuit cascade, built-in functions only."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.llm.frames import fresh, let, text_of, whole_row
from answerloom.sources.staging import stage

SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\u000b\f\r"
_WORD = r"[^\x20\x09-\x0D]+"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``reject`` is true for a bad text; it may use the base columns and ``words``."""

    name: str
    reject: Column


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))


def _repeated(words: Column) -> Column:
    """Words that lie in a window of five words which occurs twice or more."""

    def covered(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def count(p: Column) -> Column:
            again = F.filter(
                p,
                lambda x, k: ((k > 0) & (x["h"] == F.get(p, k - 1)["h"]))
                | x["h"].eqNullSafe(F.get(p, k + 1)["h"]),
            )
            places = F.sort_array(F.transform(again, lambda x: x["i"]))
            # each window adds what the one before it has not covered
            return F.aggregate(
                places,
                F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
                lambda a, i: F.struct(
                    (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")
                ),
                lambda a: a["n"],
            )

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(
            let(pairs, count)
        )

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        return F.transform(
            starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])
        )

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < WINDOW + 1, 0).otherwise(
        let(hashed, lambda h: let(windows(h), covered))
    )


def _lines(text: Column) -> Column:
    """\\n-split lines with a word that equal an earlier line."""
    own = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, _SPACE, "")) > 0)
    return let(own, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def base_columns(text: Column, words: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long)."""
    bare = F.length(F.translate(text, _SPACE, ""))
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    columns = {
        "n_words": F.size(words),
        "word_chars": bare,
        "n_symbols": symbols,
        "n_dup_lines": _lines(text),
        "n_repeat_words": _repeated(words),
    }
    return {k: v.cast("bigint") for k, v in columns.items()}


def base_failed() -> Column:
    few = F.col("n_words") < 10
    return few | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def default_rules() -> list[Rule]:
    """Lenient rules that hold for prose of any language with word spaces."""
    n, chars = F.col("n_words"), F.col("word_chars")
    upper = F.regexp_count("body", F.lit(r"\p{Lu}"))
    marks = F.length("body") - F.length(F.translate("body", "!?", ""))
    letters = F.regexp_count("body", F.lit(r"\p{L}"))
    again = F.filter(
        "words", lambda w, i: (i > 0) & (w == F.get("words", i - 1))
    )
    lines = F.filter(F.split("body", "\n"), lambda x: F.length(F.translate(x, _SPACE, "")) > 0)
    return [
        Rule("symbols", 10 * F.col("n_symbols") > n),
        Rule("duplicate_lines", 20 * F.col("n_dup_lines") > 7 * F.size(lines)),
        Rule("word_length", (chars < 2 * n) | (chars > 12 * n)),
        Rule("shouting", 2 * upper > chars),
        Rule("exclamations", 2 * marks > n),
        Rule("few_letters", 5 * letters < 2 * chars),
        Rule("stutter", 5 * F.size(again) > n),
    ]


def order_rules(sample: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """``rules`` by the rows of ``sample`` that they reject per second, best first.

    Each place goes to the best rule on the rows that the rules before it leave.
    """
    flags = [F.coalesce(r.reject, F.lit(False)).alias(f"r{i}") for i, r in enumerate(rules)]
    left = sample.groupBy(*flags).count().collect()  # at most a row for each of the sample

    def seconds(value: Column) -> float:
        start = time.perf_counter()
        sample.agg(F.sum(value.cast("int"))).collect()
        return time.perf_counter() - start

    seconds(F.col("n_words") > 0)
    idle = seconds(F.col("n_words") > 0)
    costs = [max(seconds(r.reject) - idle, 0.001) for r in rules]
    order, open_rules = [], list(range(len(rules)))
    while open_rules:
        best = max(open_rules, key=lambda i: (sum(r["count"] for r in left if r[f"r{i}"]) / costs[i], -i))
        open_rules.remove(best)
        order.append(rules[best])
        left = [r for r in left if not r[f"r{best}"]]
    return order


def cascade(
    docs: DataFrame,
    text: str = "text",
    rules: Sequence[Rule] | None = None,
    sample_rows: int = 2000,
    seed: int = 42,
) -> DataFrame:
    """``docs`` with the base columns, ``base_failed`` and ``kept``.

    A text is kept if it passes the base test and every rule.  The rules run one after the other and
    stop at the first that rejects; their order comes from costs and rejections on a
    sample of about ``sample_rows`` rows and does not change the verdict.  A null text
    has no words, so it fails the base test.  A new name that is taken gets a leading
    underscore.  Whole texts of any length are used.
    """
    rules = list(default_rules() if rules is None else rules)
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    names = fresh(docs, *new)

    def with_base(df: DataFrame) -> DataFrame:
        split = df.withColumn("words", words_of(F.col("body")))
        return split.withColumns(base_columns(F.col("body"), F.col("words")))

    bodies = docs.select(text_of(text).alias("body"), whole_row(docs).alias("row"))
    if rules:
        total = max(1, docs.count())
        part = docs.select(text_of(text).alias("body")).sample(min(1.0, sample_rows / total), seed)
        # the rules judge only rows that pass the base test
        judged = with_base(part).where(~base_failed())
        rules = order_rules(stage(judged, "rule-sample"), rules)
    verdict = F.when(F.col("base_failed"), False)
    for rule in rules:
        verdict = verdict.when(rule.reject, False)
    return (
        with_base(bodies)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", verdict.otherwise(True))
        .select("row.*", *[F.col(c).alias(n) for c, n in zip(new, names, strict=True)])
    )
