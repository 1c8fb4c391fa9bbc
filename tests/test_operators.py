import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from answerloom.names import SUBMISSION_COLUMNS
from answerloom.operators import encoding, predict, retrieval, runs, scoring, stats, submission
from answerloom.sources import tables

QA = "ID string, input string, output string, subset string"


def score(spark, pairs):
    df = spark.createDataFrame([(str(i), p, r) for i, (p, r) in enumerate(pairs)], "ID string, p string, output string")
    return scoring.score_pairs(df, "p")


# -- scoring -----------------------------------------------------------------------


@pytest.mark.parametrize(
    "pred,ref,r1,rl",
    [("rest and drink", "rest and drink", 1, 1), ("wash hands", "see a nurse", 0, 0),
     ("boil water first", "boil the water for ten minutes", 4 / 9, 4 / 9), ("night at sleep", "sleep at night", 1, 1 / 3), ("", "a", 0, 0), (None, "a", 0, 0), ("a", "", 0, 0),
     ("a a a", "a", 0.5, 0.5), ("A", "a", 0, 0)],
)
def test_rouge_pair(spark, pred, ref, r1, rl):
    row = score(spark, [(pred, ref)]).first()
    assert row["rouge1_f1"] == pytest.approx(r1) and row["rougeL_f1"] == pytest.approx(rl)


def test_rouge_bounds(spark):
    rnd = random.Random(1)
    pairs = [[" ".join(rnd.choice("abcde") for _ in range(rnd.randint(0, 70))) for _ in "pr"] for _ in range(200)]
    for r in score(spark, pairs).collect():
        assert 0 <= r["rougeL_f1"] <= r["rouge1_f1"] <= 1


def test_rouge_tables(spark):
    df = spark.createDataFrame(
        [("k1", "one two three", "three two", "north"), ("k2", "four", "four", "south"), ("k3", "five six", "six", "north"),
         ("k4", "seven", "eight", None)],
        "ID string, p string, output string, subset string",
    )
    scored = scoring.score_pairs(df, "p")
    rows = [tuple(r) for r in scoring.rouge_by_subset(scored).collect()]
    # north: (0.8 + 2/3) / 2 and (0.4 + 2/3) / 2
    assert rows == [("north", 2, 0.733333, 0.533333, 0.633333), ("south", 1, 1.0, 1.0, 1.0)]
    assert scoring.rouge_overall(scored.limit(0)).first()["combined"] == 0.0


# -- submission ----------------------------------------------------------------------


def test_submission_format(spark, tmp_path):
    said = {"p-9": "  drink, then rest\n", "p-10": "\t", "p-11": None}
    sub = submission.submission_rows(spark.createDataFrame(list(said.items()), "ID string, prediction string"))
    assert sub.columns == SUBMISSION_COLUMNS
    assert {r[0]: set(r[1:]) for r in sub.collect()} == {"p-9": {"drink, then rest"}, "p-10": {" "}, "p-11": {" "}}
    path = str(tmp_path / "deep" / "sub")
    submission.write_submission(sub, path, one_file=True)
    assert sorted(map(tuple, tables.read_csv(spark, path, sub.schema).collect())) == sorted(map(tuple, sub.collect()))


def test_align_and_validate(spark):
    ids = spark.createDataFrame([("a",)], "ID string")
    two = spark.createDataFrame([("a", "x"), ("b", "y")], "ID string, prediction string")
    with pytest.raises(ValueError):
        submission.align(ids, two)
    assert submission.align(ids, two.where("ID = 'a'")).count() == 1
    sample = submission.submission_rows(two)
    submission.validate_submission(sample, sample)
    with pytest.raises(ValueError, match="missing.*b"):
        submission.validate_submission(sample.where("ID = 'a'"), sample)
    with pytest.raises(ValueError, match="columns"):
        submission.validate_submission(sample.select(*sample.columns[::-1]), sample)
    with pytest.raises(ValueError, match="duplicate"):
        submission.validate_submission(sample.unionByName(sample), sample)


def test_fallback_counts_characters(spark):
    df = spark.createDataFrame([("abcd", "r"), (" abcde ", "r"), (None, "r"), ("ለለለለለ", "r")], "g string, r string")
    out = submission.hybrid_fallback(df, "g", "r").collect()
    assert [r["prediction"] for r in out] == ["r", "abcde", "r", "ለለለለለ"]
    assert [r["used_fallback"] for r in out] == [True, False, True, False]


# -- statistics -------------------------------------------------------------------------


def test_histogram_matches_numpy(spark):
    rnd = random.Random(2)
    sizes = [(rnd.randint(1, 90), rnd.randint(1, 500)) for _ in range(300)]
    df = spark.createDataFrame([(str(i), "w " * a, "w " * b, "s") for i, (a, b) in enumerate(sizes)], QA)
    rows = stats.length_histogram(df).collect()
    for metric, values in (("question", [a for a, _ in sizes]), ("answer", [min(b, 300) for _, b in sizes])):
        counts, edges = np.histogram(values, bins=50)
        got = sorted((r for r in rows if r["metric"] == metric), key=lambda r: r["bin"])
        assert [r["count"] for r in got] == counts.tolist()
        assert [r["low"] for r in got] == pytest.approx(edges[:-1].tolist(), abs=1e-5)
    flat = stats.length_histogram(df.limit(1).union(df.limit(1))).where("metric = 'question' and count > 0").collect()
    assert [(r["bin"], r["count"]) for r in flat] == [(25, 2)]


def test_length_stats_on_empty_table(spark):
    assert stats.length_stats(spark.createDataFrame([], QA)).first()["a_max"] is None
    assert stats.answer_uniqueness(spark.createDataFrame([], QA)).first()["unique_ratio"] == 0.0


# -- sources -----------------------------------------------------------------------------


def test_csv_quoting_and_null_tokens(spark, tmp_path):
    text = 'ID,input,output,subset\n1,"a\nb ""c""",x,Eng_Uga\n2,NA,x,Eng_Uga\n3,q,null,\n4,q,,Eng_Uga\n5,"q, r", y ,\n'
    (tmp_path / "Train.csv").write_text(text)
    rows = sorted(map(tuple, tables.load_split(spark, str(tmp_path / "Train.csv")).collect()))
    assert rows == [("1", 'a b "c"', "x", "Eng_Uga"), ("5", "q, r", "y", None)]


def test_run_log_takes_a_row_once(spark, tmp_path):
    path = str(tmp_path / "log")
    row = spark.createDataFrame([("k", 0.5)], "key string, combined double")
    full = row.select(*[
        (F.col(f.name) if f.name in row.columns else F.lit(None)).alias(f.name) for f in tables.RUN_LOG
    ])
    tables.append_runs(full, path)
    tables.append_runs(full, path)
    assert tables.read_runs(spark, path).count() == 1


# -- encoding and prediction ----------------------------------------------------------------


def test_masks(spark):
    df = spark.createDataFrame([([5, 0, 7, -100],)], "x array<int>")
    row = df.select(
        encoding.label_mask(F.col("x")).alias("m"),
        encoding.label_unmask(F.col("x")).alias("u"),
        encoding.prediction_unmask(F.col("x")).alias("p"),
    ).first()
    assert row["m"] == [5, -100, 7, -100] and row["u"] == [5, 7] and row["p"] == [5, 7]


def test_encode_and_pad(spark):
    pairs = spark.createDataFrame(
        [(str(i), " ".join("abc"[j % 3] for j in range(i)), "a zz") for i in range(1, 12)],
        "ID string, prompt string, answer string",
    )
    vocabulary = encoding.word_vocabulary(pairs, "prompt")
    enc = encoding.encode_examples(pairs, vocabulary, max_input=9)
    rows = {r["ID"]: r for r in enc.collect()}
    assert rows["4"]["input_ids"] == [2, 3, 4, 2] and len(rows["11"]["input_ids"]) == 9
    assert rows["4"]["labels"] == [2, 1]
    padded = encoding.pad_batches(enc, batch_size=4).collect()
    for _, batch in itertools.groupby(sorted(padded, key=lambda r: r["batch"]), key=lambda r: r["batch"]):
        batch = list(batch)
        assert len({len(r["input_ids"]) for r in batch}) == 1 and len(batch[0]["input_ids"]) in (8, 16)
        assert all(len(r["labels"]) == 8 and r["labels"][2:] == [-100] * 6 for r in batch)
        assert all(sum(r["attention_mask"]) == len([x for x in r["input_ids"] if x]) for r in batch)


def test_batch_predict(spark):
    def load():
        return lambda prompts: ["<extra_id_0>" if "bad" in p else f"<extra_id_1>{p} ({len(prompts)})" for p in prompts]

    train = spark.createDataFrame([("t1", "bad fever", "rest", "Eng_Uga"), ("t2", "cough", "tea", "Eng_Uga")], QA)
    ask = spark.createDataFrame([("q1", "bad fever!", "Eng_Uga"), ("q2", "cough", "Eng_Uga")], "ID string, input string, subset string")
    plain = {r["ID"]: r["prediction"] for r in predict.batch_predict(ask.coalesce(1), load).collect()}
    assert plain == {"q1": "", "q2": "English: cough (2)"}
    index = retrieval.build_index(train)
    both = predict.batch_predict(ask, load, index=index, augment=True, fallback=True)
    got = {r["ID"]: r["prediction"] for r in both.collect()}
    assert got["q1"] == "rest" and "Reference: tea" in got["q2"]
    with pytest.raises(ValueError):
        predict.batch_predict(ask, load, fallback=True)


def test_evaluation_without_subset(spark):
    df = spark.createDataFrame([("1", "a", "a")], "ID string, prediction string, output string")
    report, _ = predict.evaluate_predictions(df)
    (row,) = report.collect()
    assert (row["level"], row["combined"]) == ("overall", 1.0)


# -- runs -----------------------------------------------------------------------------------


def test_config_overrides(spark):
    base = spark.createDataFrame([("epochs", "3"), ("beta", None), ("run_name", "run")], "key string, value string")
    named = spark.createDataFrame([("r1", "h1"), ("r2", "h2")], "run string, hypothesis string")
    given = spark.createDataFrame([("r1", "epochs", "1"), ("r2", "epochs", None), ("r2", "oops", "1")], "run string, key string, value string")
    out = {(r["run"], r["key"]): (r["value"], r["source"]) for r in runs.resolve_configs(base, named, given).collect()}
    assert out["r1", "epochs"] == ("1", "override") and out["r2", "epochs"] == (None, "override")
    assert out["r1", "beta"] == (None, "base") and out["r2", "oops"] == ("1", "unknown")
    assert out["r1", "run_name"] == ("r1", "derived") and out["r1", "notes"] == ("h1", "derived")
    with pytest.raises(ValueError, match="oops"):
        runs.require_known_keys(base, given)
    changed = {r["run"]: r["changed_fields"] for r in runs.changed_fields(base, runs.resolve_configs(base, named, given), named).collect()}
    assert changed == {"r1": '{"epochs":1}', "r2": '{"epochs":null}'}


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_early_stop_in_blocks(spark, block):
    rnd = random.Random(4)
    history = [(r, e, float(rnd.randint(0, 3 + e // 4))) for r in range(12) for e in range(40)]
    df = spark.createDataFrame(history, "run int, epoch long, metric double")
    for patience in (1, 2, 4):
        want = {}
        for r in range(12):
            best, misses, want[r] = None, 0, None
            for e in range(40):
                m = history[r * 40 + e][2]
                better = best is None or m > best
                best, misses = (m, 0) if better else (best, misses + 1)
                if misses >= patience:
                    want[r] = e
                    break
        got = {r["run"]: r["stop_epoch"] for r in runs.early_stop_epoch(df, patience, block).collect()}
        assert got == want
    assert runs.early_stop_epoch(df, 0).where("stop_epoch is not null").count() == 0


def test_best_checkpoint_prefers_early_ties(spark):
    df = spark.createDataFrame([("r", 1, 0.5), ("r", 2, 0.7), ("r", 3, 0.7)], "run string, epoch long, metric double")
    assert tuple(runs.best_checkpoint(df).first()) == ("r", 2, 0.7)


def test_empty_subset_json_is_null(spark):
    none = spark.createDataFrame([], "subset string, combined double")
    assert runs.per_subset_json(none).first()["per_language"] is None


def test_rank_shares_ties(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", 0.7), ("c", 0.5), ("d", 0.1)], "key string, combined double")
    assert {r["key"]: r["rank"] for r in runs.rank_runs(df).collect()} == {"b": 1, "a": 2, "c": 2, "d": 4}


def test_runs_without_a_score_rank_last(spark):
    rows = [("a", 0.5), ("b", None), ("c", float("nan")), ("d", 0.9), ("e", 0.5)]
    df = spark.createDataFrame(rows, "key string, combined double")
    got = {r["key"]: r["rank"] for r in runs.rank_runs(df).collect()}
    assert got == {"d": 1, "a": 2, "e": 2, "b": 4, "c": 4}


def test_checkpoints_skip_missing_metrics(spark):
    rows = [("r", 1, 0.5), ("r", 2, float("nan")), ("r", 3, 0.7), ("r", 4, None), ("s", 1, None)]
    df = spark.createDataFrame(rows, "run string, epoch int, metric double")
    assert sorted(map(tuple, runs.best_checkpoint(df).collect())) == [("r", 3, 0.7), ("s", None, None)]
    assert ("r", 1, 0.5) in list(map(tuple, runs.best_checkpoint(df, greater=False).collect()))
    stops = {r["run"]: r["stop_epoch"] for r in runs.early_stop_epoch(df, 1).collect()}
    assert stops == {"r": 2, "s": 1}


def test_csv_columns_by_name(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    with open(path, "w") as f:
        f.write('output,ID,input\n"an answer, quoted",7,what is it\n')
    row = tables.load_split(spark, path).first()
    assert (row["ID"], row["input"], row["output"], row["subset"]) == ("7", "what is it", "an answer, quoted", None)
    with open(path, "w") as f:
        f.write("ID,output\n7,x\n")
    with pytest.raises(ValueError, match="lacks"):
        tables.load_split(spark, path)


def test_submission_with_swapped_columns_is_noticed(spark, tmp_path):
    path = str(tmp_path / "s.csv")
    with open(path, "w") as f:
        f.write("ID,TargetLLM,TargetR1F1,TargetRLF1\n1,a,b,c\n")
    sample = spark.createDataFrame([("1", "?", "?", "?")], "ID string, TargetRLF1 string, TargetR1F1 string, TargetLLM string")
    checks = {r["check"]: r["ok"] for r in submission.submission_check(tables.read_raw_csv(spark, path), sample).collect()}
    assert not checks["columns"] and checks["row_count"]


def test_weights_below_one_are_refused(spark):
    from answerloom.operators.sampling import oversample_subsets

    with pytest.raises(ValueError):
        oversample_subsets(spark.createDataFrame([("1", "a")], "ID string, subset string"), ["a"], 0)


def test_a_cluster_must_name_a_shared_folder():
    from types import SimpleNamespace

    from answerloom.sources.staging import workspace

    context = SimpleNamespace(
        getConf=lambda: SimpleNamespace(get=lambda k: None), getCheckpointDir=lambda: None, master="spark://a:7077"
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace(SimpleNamespace(sparkContext=context))


def test_file_audit_takes_names_literally(spark, tmp_path):
    folder = tmp_path / "data+1" / "x" / "data+1"
    folder.mkdir(parents=True)
    (folder / "inner.txt").write_text("abc")
    (tmp_path / "data+1" / "Train.csv").write_text("ID\n")
    rows = {r["file"]: r["present"] for r in tables.file_audit(spark, str(tmp_path / "data+1"), ["Train.csv", "inner.txt"]).collect()}
    assert rows == {"Train.csv": True, "inner.txt": False}


# -- reports, submissions and logs ---------------------------------------------------


def test_report_has_all_rows_and_each_subset(spark):
    df = spark.createDataFrame(
        [("1", "p q", "p q", "Xx"), ("2", "p", "q", "Yy"), ("3", "p", "p", None)],
        "ID string, p string, output string, subset string",
    )
    rows = scoring.rouge_report(scoring.score_pairs(df, "p")).collect()
    assert [(r["level"], r["subset"], r["count"], r["combined"]) for r in rows] == [
        ("overall", None, 3, 0.666667), ("subset", "Yy", 1, 0.0), ("subset", "Xx", 1, 1.0),
    ]
    assert scoring.rouge_report(scoring.score_pairs(df.limit(0), "p")).collect() == []


def test_submission_is_published_only_if_it_fits(spark, tmp_path):
    sample = spark.createDataFrame([("a",), ("b",), ("c",)], "ID string")
    good = [("a", " x "), ("b", None), ("c", "z, \"q\"\nr")]
    path = tmp_path / "out" / "submission"
    path.parent.mkdir()
    faults = {
        "missing": good[:2], "unexpected": [*good, ("d", "w")], "repeated": [*good, ("a", "y")],
        "without_id": [*good, (None, "w")],
    }
    for name, rows in faults.items():
        with pytest.raises(ValueError, match=name):
            submission.make_submission(spark.createDataFrame(rows, "ID string, prediction string"), sample, str(path))
        assert list(path.parent.iterdir()) == []
    predictions = spark.createDataFrame(good, "ID string, prediction string")
    submission.make_submission(predictions, sample, str(path))
    written = tables.read_csv(spark, str(path), submission.submission_rows(predictions).schema)
    assert sorted(map(tuple, written.collect())) == [
        ("a", "x", "x", "x"), ("b", " ", " ", " "), ("c", *['z, "q"\nr'] * 3),
    ]
    with pytest.raises(ValueError, match="exists"):
        submission.make_submission(predictions, sample, str(path))
    assert [p.name for p in path.parent.iterdir()] == ["submission"]


def test_settings_keep_their_types(spark):
    base = spark.createDataFrame(
        [("n", "3"), ("flag", "false"), ("name", "plain text"), ("empty", None), ("list", "[1, 2]")], "key string, value string"
    )
    named = spark.createDataFrame([("r", "h"), ("same", "h")], "run string, hypothesis string")
    given = spark.createDataFrame(
        [("r", "n", "2.5"), ("r", "flag", "true"), ("r", "name", 'with "quotes"'), ("r", "empty", "null"), ("r", "list", "[1,3]"),
         ("same", "list", "[1,2]"), ("same", "n", "3")], "run string, key string, value string",
    )
    resolved = runs.resolve_configs(base, named, given)
    got = {r["run"]: r["changed_fields"] for r in runs.changed_fields(base, resolved, named).collect()}
    assert got == {"r": '{"empty":null,"flag":true,"list":[1,3],"n":2.5,"name":"with \\"quotes\\""}', "same": "{}"}
    kinds = {(r["key"], r["type"]) for r in runs.setting_types(resolved).collect()}
    assert {("n", "BIGINT"), ("n", "DECIMAL(2,1)"), ("flag", "BOOLEAN"), ("name", "STRING"), ("empty", "VOID")} <= kinds


def test_log_row_has_the_time_in_utc(spark):
    import datetime

    one = spark.createDataFrame([("k", "t", "h", "m")], "run string, title string, hypothesis string, model_name string")
    means = spark.createDataFrame([("k", 0.123449, 0.2, 0.16)], "run string, rouge1_f1 double, rougeL_f1 double, combined double")
    maps = spark.createDataFrame([("k", "{}")], "run string, per_language string")
    row = runs.run_log_row(one, means, maps, spark.createDataFrame([], "run string, changed_fields string")).first()
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00", row["timestamp"])
    age = datetime.datetime.now(datetime.UTC) - datetime.datetime.fromisoformat(row["timestamp"])
    assert abs(age.total_seconds()) < 300
    assert (row["rouge1_f1"], row["changed_fields"]) == (0.1234, "{}")


def test_log_of_a_repeated_run(spark, tmp_path):
    path = str(tmp_path / "log")

    def log(*rows):
        df = spark.createDataFrame(rows, "key string, combined double")
        return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).alias(f.name) for f in tables.RUN_LOG])

    tables.append_runs(log(("a", 0.5), ("b", 0.1)), path)
    tables.append_runs(log(("b", 0.7)), path)
    rows = tables.read_runs(spark, path)
    assert rows.columns == tables.RUN_LOG.names
    assert sorted((r["key"], r["combined"]) for r in rows.collect()) == [("a", 0.5), ("b", 0.7)]


def test_rare_words_come_from_a_join(spark):
    """The same ids whether all, some or none of the vocabulary is at hand in the tasks."""
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 30))), " ".join(rnd.choices([*words, "odd"], k=9))) for i in range(80)]
    pairs = spark.createDataFrame([*rows, (80, None, "")], "ID bigint, prompt string, answer string").repartition(3)
    vocabulary = encoding.word_vocabulary(pairs, "prompt")
    known = {r["word"]: r["word_id"] for r in vocabulary.collect()}
    want = {i: ([known[w] for w in (p or "").split()], [known.get(w, 1) for w in a.split()]) for i, p, a in [*rows, (80, None, "")]}
    for head in (0, 7, 1000):
        got = {r["ID"]: (r["input_ids"], r["labels"]) for r in encoding.encode_examples(pairs, vocabulary, head=head).collect()}
        assert got == want
    plan = encoding.encode_examples(pairs, vocabulary)._jdf.queryExecution().toString()
    assert not {"i", "t"} & set(re.findall(r"explode\w*\((\w+)", plan))  # no row of tokens


def test_ids_are_decoded_and_scored(spark):
    vocabulary = spark.createDataFrame([("a", 2), ("b", 3), ("c", 4)], "word string, word_id int")
    rows = [(1, [2, 3, -100, 4], [4, 3, 0, -5, 9]), (2, [], [2]), (3, None, None)]
    df = spark.createDataFrame(rows, "ID int, labels array<int>, predictions array<int>")
    got = {r["ID"]: r for r in encoding.score_ids(df, vocabulary).collect()}
    assert (got[1]["reference"], got[1]["prediction"]) == ("a b c", "c b")
    assert got[1]["rouge1_f1"] == pytest.approx(0.8) and got[1]["rougeL_f1"] == pytest.approx(0.4)
    assert (got[2]["reference"], got[2]["rouge1_f1"], got[3]["prediction"]) == ("", 0.0, "")
    same = encoding.score_ids(df, vocabulary, score=lambda t, p, r: t.select("ID", (F.col(p) == F.col(r)).alias("same")))
    assert {r["ID"]: r["same"] for r in same.collect()} == {1: False, 2: False, 3: True}


def test_sketches_merge(spark):
    rnd = random.Random(6)
    rows = [(str(i), "q", f"answer {rnd.randint(0, 900)}", rnd.choice(["a", "b", None])) for i in range(3000)]
    exact = {s: {o for _, _, o, t in rows if t == s} for s in "ab"}
    found = {r["subset"]: r for r in stats.sketched_uniqueness(stats.answer_sketches(spark.createDataFrame(rows, QA))).collect()}
    for s, other in ("ab", "ba"):
        assert found[s]["unique_answers"] == len(exact[s]) and found[s]["elsewhere"] == len(exact[s] & exact[other])
        assert found[s]["by_hll"] == pytest.approx(len(exact[s]), rel=0.03)
    assert found[None]["unique_answers"] == len(exact["a"] | exact["b"])
    large = spark.range(200_000).select(F.lit("x").alias("subset"), F.col("id").cast("string").alias("output"))
    row = stats.sketched_uniqueness(stats.answer_sketches(large)).where("subset = 'x'").first()
    assert row["unique_answers"] == pytest.approx(200_000, rel=0.03) and row["by_hll"] == pytest.approx(200_000, rel=0.03)
    assert row["elsewhere"] == 0


def test_csv_files_of_texts_are_bounded(spark, tmp_path, monkeypatch):
    """One task reads a file whole, so a file must not grow with the table."""
    monkeypatch.setattr(submission, "TEXT_ROWS", 10)
    rows = [(f"I{n:03d}", f"some\ntext {n}") for n in range(95)]
    made = spark.createDataFrame(rows, "ID string, prediction string").coalesce(1)
    path = str(tmp_path / "out")
    submission.write_submission(submission.submission_rows(made), path)
    back = tables.read_csv(spark, path, submission.submission_rows(made).schema)
    assert sorted((r["ID"], r["TargetLLM"]) for r in back.collect()) == rows
    parts = [p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-")]
    assert len(parts) >= 10


def test_words_are_looked_up_in_bounded_slices(spark, monkeypatch):
    """Slices of a batch give the same ids as the whole batch."""
    rows = [(f"I{n}", "a b c" if n % 3 else "", f"d x{n % 5} a") for n in range(23)]
    pairs = spark.createDataFrame(rows, "ID string, prompt string, answer string").coalesce(1)
    both = pairs.selectExpr("concat_ws(' ', prompt, answer) text")
    words = encoding.word_vocabulary(both, "text").localCheckpoint()

    def coded(n):
        monkeypatch.setattr(encoding, "_CODED", n)
        return sorted(map(tuple, encoding.encode_examples(pairs, words, head=2).collect()), key=repr)

    assert coded(4) == coded(1000) and len(coded(1)) == 23


def test_decoding_fetches_a_word_once_for_all_arrays(spark):
    """Both arrays of a row share its rare words, and the first words of the vocabulary are not joined."""
    words = [(f"w{i}", i) for i in range(2, 50)]
    vocabulary = spark.createDataFrame(words, "word string, word_id int")
    rnd = random.Random(4)
    rows = [(i, [rnd.randint(-2, 60) for _ in range(rnd.randint(0, 40))], [rnd.choice([None, 2, 9, 47, 99])]) for i in range(1200)]
    rows += [(1200, None, [3]), (1201, [], None)]
    df = spark.createDataFrame(rows, "ID int, a array<int>, b array<int>").repartition(2)
    text = lambda ids: " ".join(f"w{i}" for i in ids or [] if i is not None and 2 <= i < 50)
    for head in (0, 10, 1000):
        got = {r["ID"]: (r["x"], r["y"]) for r in encoding.decode_ids(df, vocabulary, {"a": "x", "b": "y"}, head=head).collect()}
        assert got == {i: (text(a), text(b)) for i, a, b in rows}
    one = encoding.decode_ids(df, vocabulary, "a")
    assert {r["ID"]: r["text"] for r in one.collect()} == {i: text(a) for i, a, _ in rows}
