"""Written intermediate tables in the cluster's shared checkpoint folder.

A multi-pass job writes what several passes read and goes on from the file:
lineage ends there, a lost executor costs nothing, and the planner sees the real
size, so a join picks broadcast only when the table is below
``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def workspace(spark: SparkSession) -> str:
    """Shared scratch folder: ``spark.checkpoint.dir``.

    If it is unset, a local session gets a temporary folder; a cluster must name one.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    found = conf or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        found = tempfile.mkdtemp(prefix="answerloom-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    folder = _run_folder.get() or workspace(spark)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Keep everything staged inside the block in one folder, deleted at its end.

    Results are lazy: consume or write them before leaving the block.
    """
    folder = f"{workspace(spark)}/run-{uuid.uuid4().hex}"
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name first, so that it appears whole or not at all."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    draft, final = (jvm.org.apache.hadoop.fs.Path(x) for x in (f"{path}.{uuid.uuid4().hex}", path))
    fs = final.getFileSystem(conf)
    out = fs.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(draft, final):
        fs.delete(draft, False)
        raise ValueError(f"{path} exists already")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def publish(spark: SparkSession, draft: str, path: str) -> None:
    """Give a written folder its final name, which must be free, in one step."""
    source, final = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (draft, path))
    fs = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(final) or not fs.rename(source, final):
        raise ValueError(f"{path} exists already")


#: Texts and lists that go to a Python worker at once.
BATCH_BYTES = "4m"


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on sends Python workers Arrow batches of about BATCH_BYTES.

    Spark's own limits, 10,000 rows and 64 MB, hold several copies of that in the JVM and in each
    worker.  A limit that the session names itself stays.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in conf.getAll:
        conf.set(key, BATCH_BYTES)
    return df


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Give a file scan at least one partition per core; larger scans pass through.

    Only for plain scans, whose partition count is known without running a job.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() < cores:
        return scan.repartition(cores, *keys)
    return scan


#: Codec of tables that hold whole texts: smaller files than by Spark's own choice.
TEXT_CODEC = "zstd"


def stage(df: DataFrame, name: str, *keys: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as parquet and return the read-back table.

    With ``keys`` a table of few files is spread over the cores when read.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    return spread(written, *keys) if keys else written
