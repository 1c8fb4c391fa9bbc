"""QA tables derived from the driver tables, over whole texts.

``documents``: the first line is the question and everything after it the answer; of a text of
one line the first word is the question, and a single word is both.  ``conversations``: a user turn is
the question and the next assistant turn the answer. ``generation`` stands in for model
output: empty, a lone sentinel, sentinels with text, or the answer without its first
two words and with its halves changed over, so that its words are right and their order is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.functions.arrays import let
from answerloom.functions.text import tokenize_ws
from answerloom.operators.corpus import clean_split
from answerloom.sources.staging import spread

# French is left out so that an unknown prefix occurs.
DEMO_LANGUAGES = {"En": "English", "De": "German", "Es": "Spanish"}
DEMO_LOW_RESOURCE = ["De_Aaa", "Es_Aaa", "Es_Bbb", "Fr_Bbb"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def _generation(answer: Column, turn: Column) -> Column:
    tokens = tokenize_ws(answer)

    def turned(x: Column) -> Column:
        half = F.floor(F.size(x) / 2).cast("int")
        return F.concat(F.slice(x, half + 1, F.size(x)), F.slice(x, F.lit(1), half))

    late = F.array_join(let(F.slice(tokens, F.lit(3), F.size(tokens)), turned), " ")
    return (
        F.when(turn % 7 == 0, F.lit(""))
        .when(turn % 7 == 1, F.lit("<extra_id_0>"))
        .when(turn % 7 == 2, F.concat(F.lit("<extra_id_0> <extra_id_1>"), late))
        .otherwise(late)
    )


def documents_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ID, input, output, subset), not cleaned."""
    region = F.when(
        F.expr("substr(source, 4)").cast("int") % 2 == 0, F.lit("Aaa")
    ).otherwise(F.lit("Bbb"))
    return documents(spark, sf_dir).withColumn("qa", _question_and_answer(F.col("text"))).select(
        "doc_id",
        F.concat(F.lit("ID_"), F.col("doc_id").cast("string")).alias("ID"),
        "qa.input",
        "qa.output",
        F.concat(
            F.upper(F.substring("lang", 1, 1)), F.expr("substr(lang, 2)"), F.lit("_"), region
        ).alias("subset"),
    )


def _question_and_answer(text: Column) -> Column:
    """Struct (input, output); ``let`` keeps whole texts from being cut several times."""

    def left(x: Column) -> Column:
        return F.ltrim(x, F.lit(" \t\n\x0b\x0c\r"))

    def behind(x: Column, head: Column) -> Column:
        return x.substr(F.length(head) + 1, F.length(x))

    def by_word(line: Column) -> Column:
        word = F.regexp_extract(line, r"\A[^\x09-\x0D\x20]+", 0)
        rest = behind(line, word)
        return F.struct(word.alias("input"), F.when(left(rest) == "", word).otherwise(rest).alias("output"))

    def by_line(t: Column) -> Column:
        line = F.substring_index(t, "\n", 1)
        parts = F.struct(line.alias("input"), behind(t, line).alias("output"))
        return let(parts, lambda x: F.when(left(x["output"]) == "", by_word(x["input"])).otherwise(x))

    return let(left(text), by_line)


def documents_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean QA rows with ``generation`` and the fixed ``split`` label."""
    ten = F.col("doc_id") % 10
    split = F.when(ten == 8, "val").when(ten == 9, "test").otherwise("train")
    return clean_split(documents_raw(spark, sf_dir)).withColumns(
        {"generation": _generation(F.col("output"), F.col("doc_id")), "split": split}
    )


def dialogue_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean (ID, input, output, subset, generation) of user/assistant exchanges."""
    turns = spread(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    user = turns.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("input")
    )
    reply = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    language = (
        F.when(F.col("input").rlike("[äöüß]"), "De")
        .when(F.col("input").rlike("[èêç]"), "Fr")
        .when(F.col("input").rlike("[ñíó]"), "Es")
        .otherwise("En")
    )
    region = F.when(F.col("conv_id") % 2 == 0, "_Aaa").otherwise("_Bbb")
    qa = user.join(reply, ["conv_id", "turn"]).select(
        F.concat(
            F.lit("C_"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string")
        ).alias("ID"),
        "input",
        "output",
        F.concat(language, region).alias("subset"),
        (F.col("conv_id") + F.col("turn")).alias("n"),
    )
    qa = clean_split(qa)
    return qa.withColumn("generation", _generation(F.col("output"), F.col("n"))).drop("n")
