"""Cleaning, filtering and projecting QA tables. All narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.functions.text import build_prompt, clean_text, has_text
from answerloom.names import ANSWER, ID, LANGUAGES, LOW_RESOURCE, QUESTION, SUBSET


def drop_empty(df: DataFrame, has_answer: bool = True) -> DataFrame:
    """Keep rows whose question (and answer, when there is one) is not empty."""
    keep = F.col(QUESTION) != ""
    if has_answer and ANSWER in df.columns:
        keep = keep & (F.col(ANSWER) != "")
    return df.where(keep)


def clean_split(df: DataFrame, has_answer: bool = True) -> DataFrame:
    """Clean the text columns of a split and drop its empty rows."""
    texts = [QUESTION] + [ANSWER] * (has_answer and ANSWER in df.columns)
    # filtering on the raw text spares passes that read only keys the cleaning
    for c in texts:
        df = df.where(has_text(F.col(c)))
    return df.withColumns({c: clean_text(F.col(c)) for c in texts})


def subset_or_null(df: DataFrame) -> Column:
    """The subset column, or a null where the table has none."""
    return F.col(SUBSET) if SUBSET in df.columns else F.lit(None).cast("string")


def low_resource_rows(
    df: DataFrame, subsets: Sequence[str] = LOW_RESOURCE
) -> DataFrame:
    return df.where(F.col(SUBSET).isin(*subsets))


def training_pairs(
    df: DataFrame,
    style: str = "lang_prefix",
    retrieved: str | None = None,
    augment: bool = False,
    languages: Mapping[str, str] = LANGUAGES,
) -> DataFrame:
    """(ID, prompt, answer) rows; column ``retrieved`` is used only with ``augment``."""
    exemplar = F.col(retrieved) if retrieved and augment else None
    prompt = build_prompt(
        F.col(QUESTION), subset_or_null(df), style, exemplar, languages
    )
    return df.select(ID, prompt.alias("prompt"), F.col(ANSWER).alias("answer"))


def prediction_preview(
    df: DataFrame,
    n: int = 5,
    prediction: str = "answer",
    similarity: str = "similarity",
    matched: str = "matched_question",
    width: int = 120,
) -> DataFrame:
    """First ``n`` rows by ID for reading: texts cut, similarity to three digits."""

    def cut(c: str) -> Column:
        return F.substring(F.col(c), 1, width)

    return (
        df.orderBy(ID)
        .limit(n)
        .select(
            ID,
            cut(QUESTION).alias("question"),
            cut(ANSWER).alias("reference"),
            cut(prediction).alias("prediction"),
            F.format_string("%.3f", F.col(similarity)).alias("similarity"),
            cut(matched).alias("matched_question"),
        )
    )
