"""CSV and parquet sources and sinks of the QA data model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerloom.names import ANSWER, ID, QUESTION, SUBSET
from answerloom.operators.corpus import clean_split

# Cell contents that stand for null in a CSV table.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# File of each split.
SPLIT_FILES = {
    "train": "Train.csv",
    "val": "Val.csv",
    "test": "Test.csv",
    "sample_submission": "SampleSubmission.csv",
}

TEXT_ROWS = 10_000  # rows of texts in a CSV file

RUN_LOG = T.StructType(
    [
        T.StructField(name, T.DoubleType() if name in ("rouge1_f1", "rougeL_f1", "combined") else T.StringType())
        for name in (
            "timestamp", "key", "title", "hypothesis", "changed_fields", "model_name",
            "rouge1_f1", "rougeL_f1", "combined", "public_lb", "per_language",
        )
    ]
)

PROGRESSION = T.StructType(
    [
        T.StructField("submission", T.LongType()),
        T.StructField("date", T.StringType()),
        T.StructField("experiment_key", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("public_rougeL", T.DoubleType()),
        T.StructField("public_rouge1", T.DoubleType()),
        T.StructField("public_llm", T.DoubleType()),
        T.StructField("notes", T.StringType()),
    ]
)


def _strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def null_tokens(c: Column) -> Column:
    """Null where the cell holds one of the null tokens."""
    return F.when(~c.isin(*NULL_TOKENS), c)


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV as it is: all columns strings, in the order of the header.

    Quoted newlines and doubled quotes are read; a malformed row or a part file with
    another header raises.  One file is one task, as newlines may be quoted; parquet is the
    format for large tables.
    """
    return spark.read.csv(
        path,
        header=True,
        multiLine=True,
        quote='"',
        escape='"',
        nullValue=None,
        enforceSchema=False,
        mode="FAILFAST",
    )


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, optional: Sequence[str] = ()
) -> DataFrame:
    """Columns of ``schema`` by header name, cast to their types.

    A missing column of ``optional`` is null; any other missing column raises.
    """
    raw = read_raw_csv(spark, path)
    missing = [n for n in schema.names if n not in raw.columns]
    if set(missing) - set(optional):
        raise ValueError(f"{path} lacks columns {sorted(set(missing) - set(optional))}")
    return raw.select(
        *[
            (F.lit(None) if f.name in missing else F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def write_csv(df: DataFrame, path: str, mode: str = "error", rows: int = 0) -> None:
    """Header CSV directory; blanks inside cells survive (Spark trims by default).

    A file holds at most ``rows`` rows (0: any number), as one task reads it whole.
    """
    df.write.mode(mode).option("maxRecordsPerFile", rows).csv(
        path,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def load_split(spark: SparkSession, path: str, has_answer: bool = True) -> DataFrame:
    """Read one split from CSV, or parquet by extension, clean it, drop empty rows."""
    names = [ID, QUESTION] + ([ANSWER] if has_answer else []) + [SUBSET]
    if path.rstrip("/").endswith(".parquet"):
        raw = spark.read.parquet(path)
        return clean_split(raw.select([c for c in names if c in raw.columns]), has_answer)
    raw = read_csv(spark, path, _strings(names), optional=[SUBSET])
    return clean_split(raw.select([null_tokens(F.col(c)).alias(c) for c in names]), has_answer)


def load_all(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """train / val / test (cleaned) and sample_submission (as it is)."""
    at = {k: f"{folder.rstrip('/')}/{name}" for k, name in SPLIT_FILES.items()}
    return {
        "train": load_split(spark, at["train"]),
        "val": load_split(spark, at["val"]),
        "test": load_split(spark, at["test"], has_answer=False),
        "sample_submission": read_raw_csv(spark, at["sample_submission"]),
    }


def load_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, RUN_LOG)


def load_progression(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, PROGRESSION)


def append_runs(rows: DataFrame, path: str) -> None:
    """Write run rows to the parquet run log, one folder for each key.

    The folder of a key is replaced as a whole, so appending a run again changes nothing.
    """
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in RUN_LOG]
    (
        rows.select(*typed)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("key")
        .parquet(path)
    )


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The parquet run log in its fixed column order."""
    return spark.read.schema(RUN_LOG).parquet(path).select(*RUN_LOG.names)


def file_audit(
    spark: SparkSession, folder: str, required: Sequence[str] = tuple(SPLIT_FILES.values())
) -> DataFrame:
    """(file, present, size_mb, empty) for each required file or table folder.

    Only names and lengths are read, never contents.
    """
    names = spark.createDataFrame([(n,) for n in required], "file string")
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length")
    )
    # the part after the folder, whose name may hold any characters and may occur again below it
    at = F.locate("/" + folder.strip("/") + "/", F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))))
    path = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
    inside = F.substring(path, at + len(folder.strip("/")) + 2, F.length(path))
    sizes = (
        listed.withColumn("file", F.substring_index(inside, "/", 1))
        .groupBy("file")
        .agg(F.sum("length").alias("bytes"))
    )
    return names.join(sizes, "file", "left").select(
        "file",
        F.col("bytes").isNotNull().alias("present"),
        F.round(F.col("bytes") / 1048576.0, 6).alias("size_mb"),
        (F.coalesce("bytes", F.lit(0)) == 0).alias("empty"),
    )
