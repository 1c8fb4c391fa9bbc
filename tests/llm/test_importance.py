import math

from pyspark.sql import functions as F

from answerloom.llm.importance import best_threshold, importance_resample, log_ratios

GOOD = "the river ran past the old mill and on to the sea, where boats lay at anchor number {}."
BAD = "buy$$$ now*** {} cheap### deal%%% click&&& here!!! win||| cash>>>"


def corpus(make_docs, n=400):
    rows = [(i, (BAD if i % 4 == 0 else GOOD).format(i) * (1 + i % 3)) for i in range(n)]
    return make_docs(rows), {i: int(i % 4 != 0) for i, _ in rows}


def labels(spark, marks):
    return spark.createDataFrame([(i, q, 0) for i, q in marks.items()], "doc_id bigint, quality int, toxic int")


def test_held_out_documents_are_told_apart(spark, make_docs):
    df, truth = corpus(make_docs)
    known = labels(spark, {i: q for i, q in truth.items() if i < 160})
    out = importance_resample(df, known)
    held = [r for r in out.collect() if r["doc_id"] >= 160]
    right = sum(r["kept"] == bool(truth[r["doc_id"]]) for r in held)
    assert right >= 0.98 * len(held)
    again = importance_resample(df.repartition(3), known)
    assert out.select("doc_id", "kept", "gumbel_score").exceptAll(again.select("doc_id", "kept", "gumbel_score")).count() == 0


def test_k_best_scores_are_kept(spark, make_docs):
    df, truth = corpus(make_docs, 120)
    rows = importance_resample(df, labels(spark, truth), k=37).collect()
    ranked = sorted(rows, key=lambda r: -r["gumbel_score"])
    assert {r["doc_id"] for r in rows if r["kept"]} == {r["doc_id"] for r in ranked[:37]}


def test_edge_cases(spark, make_docs, clashing):
    df, truth = corpus(make_docs, 80)
    odd = make_docs([(900, None), (901, ""), (902, " \n"), (None, GOOD.format(1)), (903, "word " * 40_000), (5, GOOD.format(5) * 3)])
    both = df.unionByName(odd).withColumns({c: F.lit(c) for c in [*clashing, "kept"]})
    marks = labels(spark, truth).unionByName(spark.createDataFrame([(None, 1, 0), (7, None, None), (901, 1, 0)], "doc_id bigint, quality int, toxic int"))
    out = importance_resample(both, marks)
    got = {r["doc_id"]: r["_kept"] for r in out.collect()}
    assert out.count() == 86 and not got[900] and not got[901] and not got[902] and got[None]
    no_labels = importance_resample(df, labels(spark, {1: 1}))
    assert no_labels.where("not kept").count() == 0
    assert importance_resample(make_docs([]), labels(spark, {1: 1})).collect() == []


def test_models():
    assert all(abs(x) < 1e-9 for x in log_ratios([0, 0], [5, 5], 4.0))
    up, down = log_ratios([90, 10], [50, 50], 1.0)
    assert up > 0 > down
    assert best_threshold([(1.0, True)]) == -math.inf
    assert -5 < best_threshold([(-5.0, False), (2.0, True), (3.0, True)]) < 2
