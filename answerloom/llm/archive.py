"""Content-addressed WARC archive: payloads once, record headers apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Copies of one payload that a single task puts back together.
COPIES = 64
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value: RFC 4648
_CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def sha1_base32(payload: Column) -> Column:
    """SHA-1 in upper-case base32, the usual form of WARC digests (built-ins only)."""
    digest = F.sha1(payload)
    quads = [
        F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*quads), _CONV32, _BASE32)


def write_archive(
    records: DataFrame,
    path: str,
    record_id: str = "page_id",
    url: str = "url",
    body: str = "html",
    min_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write one WARC record per row below ``path``.

    ``path/payloads`` has each distinct payload once under its SHA-256, with the number
    of records that use it; ``path/headers`` has each record's exact header block.  Of
    equal payloads of at least ``min_bytes`` bytes the record with the smallest id is the
    response (null ids come last), the others are revisits of it; rows that repeat the
    id of the response are responses as well.  Smaller payloads are all responses.  A
    null body is an empty payload and a null url an empty target.  Two payloads of one
    digest that differ in length or SHA-1 stop the write.  Other columns play no part.
    """
    payload = F.coalesce(F.col(body).cast("string"), F.lit("")).cast("binary")
    rows = records.select(
        F.col(record_id).alias("record_id"),
        # a line break would end the header line
        F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("")), r"[\r\n]", "%0A").alias(
            "target"
        ),
        payload.alias("payload"),
    ).withColumns(
        {
            "address": F.sha2("payload", 256),
            "digest": sha1_base32(F.col("payload")),
            "length": F.octet_length("payload").cast("bigint"),
        }
    )
    keys = rows.select("record_id", "target", "address", "digest", "length")
    # a record's own digests are checked against those of all records at its address
    stored = (
        rows.groupBy("address")
        .agg(
            F.first("payload").alias("payload"),
            F.count(F.lit(1)).alias("copies"),
            F.min("digest").alias("d0"),
            F.max("digest").alias("d1"),
            F.min("length").alias("n0"),
            F.max("length").alias("n1"),
        )
        .select(
            "address",
            F.when(
                (F.col("d0") == F.col("d1")) & (F.col("n0") == F.col("n1")), F.col("payload")
            )
            .otherwise(F.raise_error(F.lit("payloads of one digest differ")))
            .alias("payload"),
            "copies",
        )
    )
    stored.write.parquet(f"{path}/payloads")

    firsts = keys.groupBy("address").agg(
        F.min("record_id").alias("first_id"), F.count(F.lit(1)).alias("copies")
    )
    response = (
        (F.col("length") < min_bytes)
        | F.col("first_id").isNull()
        | F.col("record_id").eqNullSafe(F.col("first_id"))
    )
    refers = F.when(~response, F.col("first_id"))
    name = lambda c: F.concat(F.lit("<urn:record:"), c.cast("string"), F.lit(">"))
    line = lambda k, v: F.concat(F.lit(f"{k}: "), v, F.lit("\r\n"))
    header = F.concat_ws(
        "",
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(response, "response").otherwise("revisit")),
        line("WARC-Record-ID", name(F.coalesce(F.col("record_id").cast("string"), F.lit("none")))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("target")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(refers.isNotNull(), line("WARC-Refers-To", name(refers))),
        F.when(
            refers.isNotNull(),
            line(
                "WARC-Profile",
                F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ),
        ),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.col("length").cast("string")),
    )
    keys.join(firsts, "address").select(
        "record_id", "address", "copies", header.alias("header")
    ).write.parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, header, payload, record) of every record, ``record`` being its bytes.

    Payloads join their headers by digest and are checked against it again; one that
    does not match stops the read.  Payloads of many records are copied in salted parts,
    so that no task puts together more than about ``COPIES`` records of one payload.
    """
    stored = spark.read.parquet(f"{path}/payloads")
    headers = spark.read.parquet(f"{path}/headers")
    few, many = F.col("copies") <= COPIES, F.col("copies") > COPIES
    parts = F.floor((F.col("copies") - 1) / COPIES) + 1
    plain = headers.where(few).drop("copies").join(stored.where(few).drop("copies"), "address")
    # by row, not by id: a third of all rows may share an id, too
    salted = headers.where(many).withColumn(
        "part", F.floor(F.rand(17) * parts).cast("bigint")
    )
    copied = stored.where(many).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("bigint"), (parts - 1).cast("bigint")))
    )
    hot = salted.drop("copies").join(copied.drop("copies"), ["address", "part"]).drop("part")
    whole = plain.unionByName(hot)
    payload = F.when(F.sha2("payload", 256) == F.col("address"), F.col("payload")).otherwise(
        F.raise_error(F.lit("a stored payload does not match its digest"))
    )
    end = F.lit("\r\n").cast("binary")
    return whole.withColumn("payload", payload).select(
        "record_id",
        "header",
        "payload",
        F.concat(
            F.col("header").cast("binary"), end, F.col("payload"), end, end
        ).alias("record"),
    )


def header_field(header: str, name: str) -> Column:
    """Value of a header line; null if the record has none."""
    found = F.regexp_extract(header, rf"(?m)^{name}: (.*)$", 1)
    return F.when(found != "", found)
