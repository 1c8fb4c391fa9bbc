"""The stored index and the stream that is answered from it."""

import os
import random

import pytest
from pyspark.sql import functions as F
from test_retrieval import brute_force, corpus, same

from answerloom.operators import retrieval
from answerloom.sources.index import append_rows, load_index, manifests, save_index
from answerloom.sources.staging import workspace
from answerloom.streaming.answers import answer_batch, answer_stream, question_stream

TRAIN = "ID string, input string, output string, subset string"
ASKED = "ID string, input string, subset string"


def data(seed=11):
    rnd, text, row = corpus(seed, 120, "copies")
    subsets = ["hot", "hot", "a", "b", None, "", "*", "__global__"]
    train = [(f"T{i:03d}", row(i) if i % 2 else text(), f"answer {i}", rnd.choice(subsets)) for i in range(90)]
    train.append(("T900", "came alone", "single", "one"))
    late = [("T901", "came later", "second", "one"), ("T000b", train[0][1], "copy", train[0][3])]
    queries = [(f"Q{i}", text(), rnd.choice([*subsets, "one", "zz"])) for i in range(30)]
    return train, late, queries


def answers(df):
    return {r["ID"]: (r["answer"], r["similarity"], r["matched_question"]) for r in df.collect()}


def test_appended_index_equals_a_rebuilt_one(spark, tmp_path):
    train, late, queries = data()
    asked = spark.createDataFrame(queries, ASKED)
    old, new = (spark.createDataFrame(x, TRAIN) for x in (train, late))
    path = str(tmp_path / "index")
    save_index(old, path)
    assert append_rows(new, path) == 2
    index, whole = load_index(spark, path), retrieval.build_index(old.unionByName(new))
    terms = [sorted(map(tuple, i.terms.drop("term").withColumn("idf", F.round("idf", 12)).collect())) for i in (index, whole)]
    assert terms[0] == terms[1]
    assert sorted(map(tuple, index.sizes.collect())) == sorted(map(tuple, whole.sizes.collect()))
    same(answers(retrieval.retrieve(index, asked)), brute_force(train + late, queries))
    # an earlier version stays as it was
    same(answers(retrieval.retrieve(load_index(spark, path, 1), asked)), brute_force(train, queries))


def test_only_new_rows_and_published_versions(spark, tmp_path):
    train, late, _ = data()
    df = spark.createDataFrame(train, TRAIN)
    path = str(tmp_path / "index")
    with pytest.raises(ValueError, match="no index"):
        append_rows(df, path)
    save_index(df, path)
    with pytest.raises(ValueError, match="already holds"):
        save_index(df, path)
    with pytest.raises(ValueError, match="in the index already"):
        append_rows(df.limit(3), path)
    # a segment without a manifest is what a failed append leaves; the next one replaces it
    spark.range(3).write.parquet(f"{path}/segments/2/entries")
    assert list(manifests(spark, path)) == [1]
    append_rows(spark.createDataFrame(late, TRAIN), path)
    assert load_index(spark, path).rows.count() == len(train) + len(late)
    with pytest.raises(ValueError, match="version 7"):
        load_index(spark, path, 7)


def test_stream_goes_on_after_a_failure(spark, tmp_path):
    train, _, queries = data(13)
    path, folder = str(tmp_path / "index"), str(tmp_path / "asked")
    save_index(spark.createDataFrame(train, TRAIN), path)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for i in range(3):
        spark.createDataFrame(queries[i::3], ASKED).coalesce(1).write.mode("append").parquet(folder)
    calls = []

    def breaks_after_writing(df, n, index_path, to):
        answer_batch(df, n, index_path, to)
        calls.append(n)
        if len(calls) == 2:
            raise RuntimeError("lost")

    asked = question_stream(spark, folder, ASKED)
    with pytest.raises(Exception, match="lost"):
        answer_stream(asked, path, out, state, breaks_after_writing).awaitTermination()
    answer_stream(asked, path, out, state, breaks_after_writing).awaitTermination()
    assert calls == [0, 1, 1, 2]  # the second batch ran twice
    rows = spark.read.parquet(out)
    assert rows.count() == len(queries)
    same(answers(rows), brute_force(train, queries))
    # nothing new arrived
    answer_stream(asked, path, out, state, breaks_after_writing).awaitTermination()
    assert len(calls) == 4


def test_few_pairs_are_completed(spark):
    """Most similarities of a search are never completed, and copies open few blocks."""
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(3, 8))) for _ in range(4000)]
    text = lambda: " ".join(rnd.choices(words, k=rnd.randint(8, 30)))
    train = [(f"T{i}", text(), "x", None) for i in range(3000)]
    index = retrieval.build_index(spark.createDataFrame(train, TRAIN))

    def shares(asked):
        df = spark.createDataFrame([(f"Q{i}", q, None) for i, q in enumerate(asked)], ASKED)
        keyed = df.select(F.lit("*").alias("grp"), F.md5("input").alias("key"), F.col("input").alias("q"), F.lit(1).alias("copies"))
        vectors = retrieval.query_vectors(index, retrieval.number_entries(keyed, "asked"))
        met = retrieval.search(index, vectors).agg(F.sum("pairs"), F.sum("scored")).first()
        return [x / (len(asked) * len(train)) for x in met]

    opened, completed = shares([q for _, q, _, _ in train[::100]])
    assert opened < 0.5 and completed < 0.05
    unlike = shares([text() for _ in range(30)])[1]
    assert unlike < 0.8


def test_publishing_leaves_no_second_copy(spark, tmp_path):
    rows = [(f"i{n}", f"word{n} and more", "a", "S") for n in range(20)]
    train = spark.createDataFrame(rows, "ID string, input string, output string, subset string")
    root = workspace(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    save_index(train, str(tmp_path / "index"))
    left = set(os.listdir(root)) - before if os.path.isdir(root) else set()
    assert not left
    assert {r[0] for r in load_index(spark, str(tmp_path / "index")).blocks.select("grp").collect()} == {"*", "=S"}


def test_a_stored_index_takes_little_more_room_than_its_texts(spark, tmp_path):
    """Neither segments nor fitted versions hold a row or an array for the terms of each text."""
    from test_retrieval import long_texts, written

    texts = long_texts(1500)
    rows = [(f"T{i}", q, "x", None) for i, q in enumerate(texts)]
    old, new = (spark.createDataFrame(x, TRAIN) for x in (rows[:1000], rows[1000:]))
    path = str(tmp_path / "index")
    save_index(old, path)
    append_rows(new, path)
    assert written(path) < 4 * sum(map(len, texts))


def test_exchanges_are_cut_once_for_an_evaluation(spark, sf_dir):
    """The conversations are joined with themselves and cleaned for one file, which all passes read."""
    import glob

    from answerloom.plans.catalog import QUERIES
    from answerloom.sources.staging import scratch

    with scratch(spark) as folder:
        QUERIES["evaluate_predictions"](spark, sf_dir)
        assert len(glob.glob(f"{folder.removeprefix('file:')}/qa-*")) == 1
        assert not glob.glob(f"{folder.removeprefix('file:')}/counts-*")


def test_answers_are_stored_compressed(spark, tmp_path):
    path = str(tmp_path / "index")
    save_index(spark.createDataFrame([(f"T{i}", f"word{i}", "long answer " * 50, "a") for i in range(5)], TRAIN), path)
    assert all(".zstd." in f for f in load_index(spark, path).rows.inputFiles())
    assert load_index(spark, path).rows.where(F.length("answer") == 600).count() == 5
