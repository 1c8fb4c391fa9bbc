"""Each stage keeps the columns and works on what the one before kept."""

import random

import corpus_pipeline
from pyspark.sql import functions as F


def table(make_docs, spark, tmp_path):
    # lines of different documents are unlike by edit similarity, or the lines stage would drop them
    rng = random.Random(3)
    words = "the river ran past an old mill and on to sea where boats lay at anchor in quiet water while we sang".split()
    prose = lambda n: " ".join(rng.choices(words, k=n)) + "."
    rows = [(i, f"{prose(25)}\n{prose(12)}", f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, "buy$$$ now*** {} cheap### deal%%% click&&&".format(i), "s0") for i in range(20)]
    rows += [(200, rows[0][1], "s1"), (201, None, None), (202, "", "s1"), (203, "shared line of two\n" + rows[1][1], "s2")]
    df = make_docs(rows).withColumn("row", F.lit("r"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, 1, 0) for i in range(0, 60, 2)] + [(100 + i, 0, 0) for i in range(0, 20, 2)]
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return df


def test_stages(spark, make_docs, tmp_path):
    docs = table(make_docs, spark, tmp_path)
    columns, seen = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs
        if name != "tokens":
            assert docs.columns == columns
    ids = lambda name: {r["doc_id"] for r in seen[name].select("doc_id").collect()}
    assert set(range(60)) <= ids("quality") and not ids("quality") & {*range(100, 120), 201, 202}
    assert 200 not in ids("lines") and ids("lines") >= set(range(60))
    assert seen["lines"].where("n_chars <> length(text)").count() == 0
    assert ids("near_duplicates") <= ids("lines")
    assert seen["tokens"].where("not round_trip").count() == 0
    assert seen["tokens"].count() == seen["mixing"].count() > 0


def test_empty_table(spark, make_docs, tmp_path):
    make_docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
