"""Questions that arrive as files, answered from a stored index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from answerloom.operators.retrieval import retrieve
from answerloom.sources.index import load_index
from answerloom.sources.staging import scratch


def question_stream(spark: SparkSession, folder: str, schema: T.StructType | str, files: int = 1) -> DataFrame:
    """Parquet files of questions as they appear, ``files`` of them a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def answer_batch(batch: DataFrame, number: int, index_path: str, out: str) -> None:
    """Answer one micro-batch with the latest index and write it under its number.

    The folder of a batch is replaced as a whole, so a batch that runs again after a failure
    leaves no row twice.
    """
    spark = batch.sparkSession
    with scratch(spark):
        found = retrieve(load_index(spark, index_path), batch)
        (
            found.withColumn("batch", F.lit(number).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(out)
        )


def answer_stream(
    questions: DataFrame, index_path: str, out: str, checkpoint: str, write=answer_batch
) -> StreamingQuery:
    """Answer everything that has arrived, then stop; the next call goes on after it.

    Batches are numbered by the checkpoint, which also knows which files they had.
    """
    return (
        questions.writeStream.foreachBatch(lambda df, n: write(df, n, index_path, out))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
