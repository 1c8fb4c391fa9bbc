"""Archives read back record by record."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from answerloom.llm.archive import COPIES, header_field, read_archive, write_archive

PAGES = "page_id bigint, url string, html string"


def digest(body):
    return base64.b32encode(hashlib.sha1(body.encode()).digest()).decode()


def read(spark, df, path, **options):
    write_archive(df, path, **options)
    return read_archive(spark, path).withColumns(
        {
            "kind": header_field("header", "WARC-Type"),
            "refers": header_field("header", "WARC-Refers-To"),
            "digest": header_field("header", "WARC-Payload-Digest"),
        }
    )


def test_round_trip(spark, tmp_path):
    rows = [(i, f"http://x/{i}", "hot page" if i % 3 == 0 else f"page é {i % 50}") for i in range(400)]
    rows += [(500, None, None), (501, "u\r\nWARC-Type: evil", ""), (None, "n", "page é 1"), (None, "n", "lone"),
             (3, "again", "hot page"), (600, "long", "<p>" + "ü" * 300_000)]
    df = spark.createDataFrame(rows, PAGES).withColumn("header", F.lit("h")).withColumn("payload", F.lit("p"))
    got = read(spark, df, str(tmp_path / "a")).collect()
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, _, h in rows:
        h = h or ""
        response = h not in first or i == first[h]
        want.append((i, h, "response" if response else "revisit", None if response else f"<urn:record:{first[h]}>"))
    assert sorted(((r["record_id"], r["payload"].decode(), r["kind"], r["refers"]) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert r["digest"] == "sha1:" + digest(r["payload"].decode())
        head, body = bytes(r["record"]).split(b"\r\n\r\n", 1)
        assert body == bytes(r["payload"]) + b"\r\n\r\n"
        assert f"Content-Length: {len(r['payload'])}".encode() in head
    assert sum(h == "hot page" for _, _, h in rows) > COPIES


def test_payloads_are_stored_once(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", "same") for i in range(100)] + [(200, "u", "other")], PAGES)
    write_archive(df, str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a/payloads")).count() == 2


def test_small_payloads_are_all_responses(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], PAGES)
    got = read(spark, df, str(tmp_path / "a"), min_bytes=5)
    assert {(r["record_id"], r["kind"]) for r in got.collect()} == {
        (1, "response"), (2, "response"), (3, "response"), (4, "revisit")
    }


def test_damage_is_noticed(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "one"), (2, "u", "two")], PAGES)
    path = str(tmp_path / "a")
    write_archive(df, path)
    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit("x").cast("binary"))
    bad.write.parquet(f"{tmp_path}/b/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{tmp_path}/b/headers")
    with pytest.raises(Exception, match="does not match"):
        read_archive(spark, f"{tmp_path}/b").collect()


def test_empty(spark, tmp_path):
    assert read(spark, spark.createDataFrame([], PAGES), str(tmp_path / "a")).collect() == []


def test_ids_below_zero(spark, tmp_path):
    from answerloom.llm.queries import op4_content_archive

    rows = [(-5, "u", "same"), (-3, "u", "same"), (2, "u", "same"), (None, "u", "own")]
    spark.createDataFrame(rows, PAGES).write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in op4_content_archive(spark, str(tmp_path)).collect()}
    assert got == {-5: ("response", None), -3: ("revisit", -5), 2: ("revisit", -5), None: ("response", None)}
