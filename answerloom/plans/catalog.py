"""Every registered query: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.functions.arrays import records, value_counts
from answerloom.functions.rouge import f1, lcs_length, overlap
from answerloom.functions.text import (
    build_prompt,
    char_ngrams,
    clean_strip,
    clean_text,
    language_name,
    latin_fraction,
    sentinel_cleanup,
    sentinel_delete,
    tokenize_ws,
)
from answerloom.names import ANSWER, ID, QUESTION, SUBMISSION_COLUMNS, SUBSET
from answerloom.operators import corpus, encoding, predict, retrieval, runs, sampling
from answerloom.operators import scoring, stats, submission
from answerloom.plans.corpora import (
    DEMO_LANGUAGES,
    DEMO_LOW_RESOURCE,
    dialogue_qa,
    documents,
    documents_qa,
    documents_raw,
    table,
)
from answerloom.sources import index, tables
from answerloom.sources.staging import TEXT_CODEC, new_path, stage
from answerloom.streaming import answers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

QA = [ID, QUESTION, ANSWER, SUBSET]
HOLDOUT, SEED = 0.05, 42


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_qa(spark, sf_dir).select(*QA)


# -- text expressions over the raw documents ---------------------------------


def _column_query(rows: Callable[[SparkSession, str], DataFrame], key: str):
    """Register functions that build one column over ``rows``; named like the query."""

    def register(name: str, out: str, column: Callable[[], Column]) -> None:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rows(spark, sf_dir).select(key, column().alias(out))

        QUERIES[name] = run

    return register


def _prompt(style: str, retrieved: str | None = None) -> Column:
    exemplar = F.col(retrieved) if retrieved else None
    return build_prompt(F.col(QUESTION), F.col(SUBSET), style, exemplar, DEMO_LANGUAGES)


_text = _column_query(documents, "doc_id")
_text("clean_text", "cleaned", lambda: clean_text(F.col("text")))
_text("clean_strip", "stripped", lambda: clean_strip(F.col("text")))
_text("tokenize_ws", "tokens", lambda: tokenize_ws(F.col("text")))
_text("latin_fraction", "latin", lambda: latin_fraction(F.col("text")))

_question = _column_query(documents_raw, ID)
_question("prompt_bare", "prompt", lambda: _prompt("bare"))
_question("prompt_instruction", "prompt", lambda: _prompt("instruction"))
_question("prompt_lang_prefix", "prompt", lambda: _prompt("lang_prefix"))

_made = _column_query(documents_qa, ID)
_made("prompt_with_reference", "prompt", lambda: _prompt("lang_prefix", "generation"))
_made("sentinel_cleanup", "text", lambda: sentinel_cleanup(F.col("generation")))
_made("sentinel_delete", "text", lambda: sentinel_delete(F.col("generation")))


@query
def subset_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = language_name(F.col(SUBSET), DEMO_LANGUAGES)
    rows = documents_raw(spark, sf_dir).select(
        ID, F.when(F.col("doc_id") % 11 != 0, F.col(SUBSET)).alias(SUBSET)
    )
    return rows.select(ID, SUBSET, name.alias("language"))


def _gram_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = value_counts(char_ngrams(F.col(QUESTION)))
    return (
        _qa(spark, sf_dir)
        .select(ID, F.explode(counts).alias("gram", "k"))
        .groupBy("gram")
        .agg(F.count("*").alias("rows"), F.sum(F.col("k").cast("long")).alias("total"))
    )


QUERIES["char_ngrams"] = _gram_totals


@query
def drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = documents_raw(spark, sf_dir).select(*QA)
    return corpus.drop_empty(
        raw.withColumns({c: clean_text(F.col(c)) for c in (QUESTION, ANSWER)})
    )


# -- sources and sinks --------------------------------------------------------


def _csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with some null tokens among the questions."""
    token = F.element_at(
        F.array(F.lit("NA"), F.lit("null"), F.lit("None")), (F.col("doc_id") % 3 + 1).cast("int")
    )
    return documents_raw(spark, sf_dir).withColumn(
        QUESTION, F.when(F.col("doc_id") % 50 == 0, token).otherwise(F.col(QUESTION))
    )


def _write_splits(spark: SparkSession, sf_dir: str) -> str:
    folder = new_path(spark, "splits")
    rows = _csv_rows(spark, sf_dir)
    ten = F.col("doc_id") % 10
    test = rows.where(ten == 9)
    # columns are found by name, in any order
    tables.write_csv(rows.where(ten < 8).select(*QA[::-1]), f"{folder}/Train.csv", rows=tables.TEXT_ROWS)
    tables.write_csv(rows.where(ten == 8).select(*QA), f"{folder}/Val.csv", rows=tables.TEXT_ROWS)
    tables.write_csv(test.select(ID, QUESTION, SUBSET), f"{folder}/Test.csv", rows=tables.TEXT_ROWS)
    blank = test.select(
        ID, *[F.lit("?").alias(c) for c in SUBMISSION_COLUMNS[1:]]
    )
    tables.write_csv(blank, f"{folder}/SampleSubmission.csv")
    return folder


@query
def load_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "train-csv")
    tables.write_csv(_csv_rows(spark, sf_dir).select(SUBSET, QUESTION, "doc_id", ANSWER, ID), path, rows=tables.TEXT_ROWS)
    return tables.load_split(spark, path)


@query
def load_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = tables.load_all(spark, _write_splits(spark, sf_dir))
    long = None
    for name, part in parts.items():
        rows = part.withColumn("split", F.lit(name))
        long = rows if long is None else long.unionByName(rows, allowMissingColumns=True)
    return long


@query
def dataset_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = tables.load_all(spark, _write_splits(spark, sf_dir))
    names = ("train", "val", "test")
    labels = [parts[name].select(F.lit(name).alias("split")) for name in names]
    return stats.dataset_shapes(
        labels[0].unionByName(labels[1]).unionByName(labels[2]),
        {name: len(parts[name].columns) for name in names},
    )


@query
def submission_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "submission")
    rows = submission.submission_rows(_predicted(spark, sf_dir))
    submission.write_submission(rows, path)
    return tables.read_csv(spark, path, rows.schema)


@query
def make_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audited and published, then read back."""
    path = new_path(spark, "published")
    predicted = _predicted(spark, sf_dir)
    sample = documents_raw(spark, sf_dir).select(ID)
    submission.make_submission(predicted, sample.join(predicted, ID, "left_semi"), path)
    return tables.read_csv(spark, path, submission.submission_rows(predicted).schema)


@query
def run_log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of runs; the second comes twice, as after a failure, and changes nothing."""
    path = new_path(spark, "run-log")
    log = stage(_run_log(spark, sf_dir), "log")
    tables.append_runs(log.where(F.col("key") == "echo"), path)
    for _ in range(2):
        tables.append_runs(log.where(F.col("key") != "echo"), path)
    return tables.read_runs(spark, path).drop("timestamp")


@query
def load_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log as CSV, read by its header."""
    path = new_path(spark, "runs-csv")
    tables.write_csv(_run_log(spark, sf_dir).select(*tables.RUN_LOG.names[::-1]), path)
    return tables.load_runs(spark, path).drop("timestamp").fillna("", ["public_lb"])


# -- projections ---------------------------------------------------------------


@query
def low_resource_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.low_resource_rows(_qa(spark, sf_dir), DEMO_LOW_RESOURCE)


@query
def training_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.training_pairs(
        documents_qa(spark, sf_dir), retrieved="generation", augment=True, languages=DEMO_LANGUAGES
    )


@query
def hybrid_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predicted(spark, sf_dir)


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation with the question standing in for the retrieved answer."""
    cleaned = documents_qa(spark, sf_dir).select(
        ID, sentinel_cleanup(F.col("generation")).alias("generation"), QUESTION
    )
    made = submission.hybrid_fallback(cleaned, "generation", QUESTION)
    return made.select(ID, "prediction", "used_fallback")


@query
def submission_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = documents_qa(spark, sf_dir).select(
        ID, sentinel_cleanup(F.col("generation")).alias("prediction")
    )
    return submission.submission_rows(raw)


def _faulty_submission(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A submission that misses IDs, has strange ones and repeats some."""
    rows = documents_qa(spark, sf_dir).select("doc_id", ID, F.col("generation").alias("prediction"))
    sample = submission.submission_rows(rows)
    odd = F.when(F.col("doc_id") % 13 == 0, F.concat(F.lit("X"), ID)).otherwise(F.col(ID))
    copies = F.when(F.col("doc_id") % 17 == 0, F.lit(2)).otherwise(F.lit(1))
    copies = F.when(F.col("doc_id") % 19 == 0, F.lit(0)).otherwise(copies)
    faulty = rows.withColumn(ID, odd).withColumn(
        "copy", F.explode(F.array_repeat(F.lit(1), copies))
    )
    return submission.submission_rows(faulty), sample


@query
def id_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return submission.id_coverage(*_faulty_submission(spark, sf_dir))


@query
def submission_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return submission.submission_check(*_faulty_submission(spark, sf_dir))


@query
def submission_targets_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    faulty, sample = _faulty_submission(spark, sf_dir)
    length = F.length("TargetLLM")
    faulty = faulty.withColumns(
        {
            "TargetR1F1": F.when(length % 5 != 0, F.col("TargetR1F1")),
            "TargetLLM": F.when(length % 7 == 0, F.lit("?")).otherwise(F.col("TargetLLM")),
        }
    )
    return submission.submission_targets_check(faulty, sample)


# -- sampling ------------------------------------------------------------------


@query
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.stratified_labels(_qa(spark, sf_dir), HOLDOUT, SEED).select(ID, SUBSET, "part")


@query
def holdout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.stratified_split(_qa(spark, sf_dir), HOLDOUT, SEED)[1]


@query
def stratified_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.stratified_cap(_qa(spark, sf_dir), 150, SEED).select(ID, SUBSET)


@query
def sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_n(_qa(spark, sf_dir), 200, SEED).select(ID, SUBSET)


@query
def oversample_subsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.oversample_subsets(_qa(spark, sf_dir), DEMO_LOW_RESOURCE).select(
        ID, SUBSET, "copy_no"
    )


@query
def shuffle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sampling.oversample_subsets(_qa(spark, sf_dir), DEMO_LOW_RESOURCE)
    return sampling.shuffle_rows(rows.select(ID, "copy_no"), SEED)


# -- retrieval -----------------------------------------------------------------


def _split(spark: SparkSession, sf_dir: str, share: float = HOLDOUT) -> tuple[DataFrame, DataFrame]:
    """Both parts of the clean corpus, written once because many passes read it."""
    return sampling.stratified_split(stage(_qa(spark, sf_dir), "qa", ID, codec=TEXT_CODEC), share, SEED)


def _all_routes(holdout: DataFrame) -> DataFrame:
    """Queries for own indexes, unknown subsets and no subset at all."""
    code = F.col(SUBSET)
    changed = F.when(code.startswith("Fr"), F.lit("Xx_Aaa")).when(code != "De_Bbb", code)
    return holdout.withColumn(SUBSET, changed)


@query
def eligible_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.eligible_groups(_split(spark, sf_dir)[0])


@query
def retrieval_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, holdout = _split(spark, sf_dir)
    groups = retrieval.eligible_groups(train).select(SUBSET)
    return retrieval.route(_all_routes(holdout), groups).select(ID, SUBSET, "grp")


def _counts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    entries = retrieval.index_entries(_qa(spark, sf_dir))
    # read once, so not written
    return entries, retrieval.gram_counts(entries)


@query
def gram_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries, counts = _counts(spark, sf_dir)
    sizes = retrieval.index_sizes(entries)
    terms = retrieval.gram_idf(sizes, stage(retrieval.gram_stats(counts), "stats"))
    return terms.withColumn("idf", F.round("idf", 6))


@query
def vocab_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, counts = _counts(spark, sf_dir)
    return retrieval.vocab_topk(stage(retrieval.gram_stats(counts), "stats"), 2000)


@query
def retrieve_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, holdout = _split(spark, sf_dir)
    return retrieval.retrieve_nearest(train, _all_routes(holdout).drop(ANSWER))


@query
def stored_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same answers from an index in a folder: saved, appended to, loaded."""
    train, holdout = _split(spark, sf_dir)
    path = new_path(spark, "index")
    late = F.crc32(F.col(ID).cast("binary")) % 3 == 0
    index.save_index(train.where(~late), path)
    index.append_rows(train.where(late), path)
    return retrieval.retrieve(index.load_index(spark, path), _all_routes(holdout).drop(ANSWER))


@query
def answer_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The holdout arrives in two files, each a micro-batch answered from a stored index."""
    train, holdout = _split(spark, sf_dir)
    root = new_path(spark, "stream")
    index.save_index(train, f"{root}/index")
    asks = _all_routes(holdout).drop(ANSWER)
    half = F.crc32(F.col(ID).cast("binary")) % 2 == 0
    for part in (asks.where(half), asks.where(~half)):
        part.coalesce(1).write.mode("append").parquet(f"{root}/asked")
    asked = answers.question_stream(spark, f"{root}/asked", asks.schema)
    answers.answer_stream(asked, f"{root}/index", f"{root}/answers", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/answers").drop("batch")


@query
def prediction_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the rows that are shown are searched for."""
    train, holdout = _split(spark, sf_dir)
    shown = holdout.orderBy(ID).limit(5)
    return corpus.prediction_preview(retrieval.retrieve_nearest(train, shown))


def _retrieval_scores(spark: SparkSession, sf_dir: str, share: float) -> DataFrame:
    train, holdout = _split(spark, sf_dir, share)
    return scoring.score_pairs(retrieval.retrieve_nearest(train, holdout), "answer")


@query
def retrieval_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.rouge_report(_retrieval_scores(spark, sf_dir, HOLDOUT))


@query
def retrieval_ceiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.rouge_overall(_retrieval_scores(spark, sf_dir, 0.1))


# -- scoring --------------------------------------------------------------------


def _methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three predictions for every exchange: the question, the text, the repaired text."""
    rows = dialogue_qa(spark, sf_dir).withColumn("text", sentinel_cleanup(F.col("generation")))
    rows = submission.hybrid_fallback(rows, "text", QUESTION)
    made = records(
        ("method", "p"),
        (F.lit("echo"), F.col(QUESTION)),
        (F.lit("generation"), F.col("text")),
        (F.lit("hybrid"), F.col("prediction")),
    )
    return rows.select(ID, SUBSET, ANSWER, F.inline(made))


@query
def rouge1_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: the sentinel-cleaned generation against the whole answer."""
    p, r = F.col("p"), F.col("r")
    tokens = documents_qa(spark, sf_dir).select(
        ID,
        tokenize_ws(sentinel_cleanup(F.col("generation"))).alias("p"),
        tokenize_ws(F.col(ANSWER)).alias("r"),
    )
    return tokens.withColumn("common", overlap(p, r)).select(
        ID, "common", f1(F.col("common"), F.size(p), F.size(r)).alias("rouge1_f1")
    )


@query
def rougeL_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scoring.score_pairs(_methods(spark, sf_dir), "p")
    common = lcs_length(tokenize_ws(F.col("p")), tokenize_ws(F.col(ANSWER)))
    return rows.select(ID, "method", common.alias("common"), "rougeL_f1")


@query
def rougeL_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over whole documents, texts of up to 20,000 words."""
    rows = scoring.score_pairs(
        documents_qa(spark, sf_dir).withColumn("p", sentinel_cleanup(F.col("generation"))), "p"
    )
    return rows.select(ID, "rouge1_f1", "rougeL_f1")


def _method(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scoring.score_pairs(_methods(spark, sf_dir).where(F.col("method") == name), "p")


@query
def rouge_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.rouge_overall(_method(spark, sf_dir, "hybrid"))


@query
def rouge_by_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.rouge_by_subset(_method(spark, sf_dir, "hybrid"))


@query
def baseline_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dialogue_qa(spark, sf_dir).withColumn("text", sentinel_cleanup(F.col("generation")))
    return scoring.compare_baselines(rows, {"echo": QUESTION, "generation": "text"})


# -- statistics -------------------------------------------------------------------


def _train_stat(f: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(_qa(spark, sf_dir))

    return run


def sketched_uniqueness(qa: DataFrame) -> DataFrame:
    """From stored sketches; HLL's estimate is left out, as it is not exact."""
    return stats.sketched_uniqueness(stage(stats.answer_sketches(qa), "sketches")).drop("by_hll")


for _f in (
    stats.length_stats,
    stats.length_histogram,
    stats.answer_uniqueness,
    stats.answer_reuse,
    stats.top_answers,
    stats.script_composition,
    sketched_uniqueness,
):
    QUERIES[_f.__name__] = _train_stat(_f)


@query
def subset_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.subset_distribution(documents_qa(spark, sf_dir))


@query
def length_budget_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.length_budget_coverage(_qa(spark, sf_dir), 32, 256)


# -- batch prediction and encoded examples ------------------------------------------


def stub_loader() -> Callable[[], Callable[[Sequence[str]], list[str]]]:
    """Loader of a deterministic stand-in for a model."""

    def load():
        def answer(prompts):
            return [
                "<extra_id_0>" if len(p) % 3 == 0 else f"{p} <extra_id_1>" for p in prompts
            ]

        return answer

    return load


@query
def batch_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = predict.batch_predict(_qa(spark, sf_dir), stub_loader(), languages=DEMO_LANGUAGES)
    return rows.select(ID, "prompt", "prediction")


def _evaluated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Index on the train part, holdout answered by the stub with both hybrids on."""
    # written once, because many passes read it
    qa = stage(dialogue_qa(spark, sf_dir).select(*QA), "qa", ID, codec=TEXT_CODEC)
    train, holdout = sampling.stratified_split(qa, 0.2, SEED)
    predicted = predict.batch_predict(
        holdout,
        stub_loader(),
        index=retrieval.build_index(train),
        augment=True,
        fallback=True,
        languages=DEMO_LANGUAGES,
    )
    return predict.evaluate_predictions(predicted)


@query
def evaluate_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluated(spark, sf_dir)[0]


@query
def evaluated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluated(spark, sf_dir)[1].select(ID, "prediction", "rouge1_f1", "rougeL_f1")


def _encoded_with_words(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    # written, as cutting and cleaning whole texts costs more than to read them twice
    pairs = stage(corpus.training_pairs(_qa(spark, sf_dir), languages=DEMO_LANGUAGES), "training-pairs", ID)
    both = pairs.select(F.concat_ws(" ", "prompt", "answer").alias("text"))
    words = stage(encoding.word_vocabulary(both, "text"), "vocabulary")
    return encoding.encode_examples(pairs, words), words


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded_with_words(spark, sf_dir)[0]


@query
def decoded_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels, and as predictions the labels in reverse with some padding, decoded and scored."""
    encoded, words = _encoded_with_words(spark, sf_dir)
    made = F.concat(F.reverse("labels"), F.array(F.lit(-100), F.lit(0)))
    rows = encoding.score_ids(encoded.withColumn("predictions", made), words)
    return rows.select(ID, "reference", "rouge1_f1")


@query
def encode_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded(spark, sf_dir)


@query
def pad_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.pad_batches(stage(_encoded(spark, sf_dir), "encoded"), 4, 8, SEED)


def _label_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word lengths of every question, less one, so that padding ids occur."""
    ids = F.transform(tokenize_ws(F.col(QUESTION)), lambda w: F.length(w) - 1)
    return _qa(spark, sf_dir).select(ID, ids.alias("ids"))


@query
def label_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_arrays(spark, sf_dir).select(ID, encoding.label_mask(F.col("ids")).alias("labels"))


@query
def label_unmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = encoding.label_mask(F.col("ids"))
    return _label_arrays(spark, sf_dir).select(
        ID,
        encoding.label_unmask(masked).alias("labels"),
        encoding.prediction_unmask(F.transform("ids", lambda x: x - 2)).alias("predictions"),
    )


# -- runs -----------------------------------------------------------------------------


def _configs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Settings from events: a user is a run, an event type is a setting."""
    events = table(spark, sf_dir, "events")
    run = F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run")
    base = (
        events.where(F.col("event_type") != "error")
        .groupBy(F.col("event_type").alias("key"))
        .agg(F.floor(F.min("value") + 1).cast("string").alias("value"))
    )
    named = events.groupBy(run).agg(F.max("props").alias("hypothesis"))
    value = F.when(F.count("*") % 3 != 0, F.floor(F.min("value")).cast("string"))
    given = events.groupBy(run, F.col("event_type").alias("key")).agg(value.alias("value"))
    return base, named, given


@query
def resolve_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.resolve_configs(*_configs(spark, sf_dir))


@query
def changed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, named, given = _configs(spark, sf_dir)
    return runs.changed_fields(base, runs.resolve_configs(base, named, given), named)


def _method_settings(spark: SparkSession, meta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Settings of a run over the exchanges and what each method changes, as JSON texts."""
    base = {"min_chars": "0", "fallback": "false", "style": "bare", "prompt": "true", "note": None}
    given = {
        "echo": {"min_chars": "null", "style": "bare", "note": '"the question"'},
        "generation": {"prompt": "true"},
        "hybrid": {"min_chars": str(submission.MIN_CHARS), "fallback": "true", "style": "lang_prefix"},
    }
    settings = spark.createDataFrame(list(base.items()), "key string, value string")
    rows = [(run, k, v) for run, changes in given.items() for k, v in changes.items()]
    overrides = spark.createDataFrame(rows, "run string, key string, value string")
    return settings, overrides.join(meta.select("run"), "run", "left_semi")


def _run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One logged run per prediction method over the exchanges, with what it changed."""
    scored = stage(scoring.score_pairs(_methods(spark, sf_dir), "p"), "scored")
    scored = scored.withColumnRenamed("method", "run")
    by_subset = scored.groupBy("run", SUBSET).agg(*scoring.mean_scores(None))
    overall = scored.groupBy("run").agg(*scoring.mean_scores(None))
    meta = scored.select(
        "run",
        F.concat(F.lit("Run "), F.col("run")).alias("title"),
        F.lit("none").alias("hypothesis"),
        F.lit("stub").alias("model_name"),
    ).distinct()
    base, given = _method_settings(spark, meta)
    runs.require_known_keys(base, given)
    changed = runs.changed_fields(base, runs.resolve_configs(base, meta, given), meta)
    return runs.run_log_row(meta, overall, runs.per_subset_json(by_subset, ["run"]), changed)


@query
def setting_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.setting_types(runs.resolve_configs(*_configs(spark, sf_dir)))


@query
def run_log_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_log(spark, sf_dir).drop("timestamp")


@query
def per_subset_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(scoring.score_pairs(_methods(spark, sf_dir), "p"), "scored")
    by_subset = rows.groupBy("method", SUBSET).agg(*scoring.mean_scores(None))
    return runs.per_subset_json(by_subset, ["method"])


@query
def runs_by_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.runs_by_subset(_run_log(spark, sf_dir))


def _event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per user; some have no score, some share one."""
    run = F.concat(F.lit("run_"), F.col("user_id").cast("string"))
    best = F.max("value")
    combined = (
        F.when(F.max("user_id") % 97 == 0, None)
        .when(F.max("user_id") % 5 == 0, F.floor(best).cast("double"))
        .otherwise(best)
    )
    return table(spark, sf_dir, "events").groupBy(run.alias("key")).agg(
        F.max("value").alias("rouge1_f1"),
        F.min("value").alias("rougeL_f1"),
        combined.alias("combined"),
    )


@query
def rank_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.rank_runs(_event_runs(spark, sf_dir)).select("key", "combined", "rank")


@query
def leaderboard_progression(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "progression")
    rows = table(spark, sf_dir, "events")
    key = F.concat(F.lit("run_"), F.col("user_id").cast("string"))
    scores = {
        "public_rougeL": F.when(F.col("event_id") % 2 == 0, F.col("value")),
        "public_rouge1": F.when(F.col("event_id") % 3 == 0, F.col("value")),
        "public_llm": F.lit(None).cast("double"),
    }
    made = rows.select(
        F.col("event_id").cast("bigint").alias("submission"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        key.alias("experiment_key"),
        F.col("props").alias("description"),
        *[c.alias(n) for n, c in scores.items()],
        F.col("event_type").alias("notes"),
    )
    tables.write_csv(made, path)
    log = _event_runs(spark, sf_dir)
    return runs.leaderboard_progression(tables.load_progression(spark, path), log)


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    metric = (
        F.when(F.col("event_id") % 97 == 0, F.lit(float("nan")))
        .when(F.col("event_id") % 89 == 0, None)
        .otherwise(F.col("value"))
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"), F.col("event_id").alias("epoch"), metric.alias("metric")
    )


@query
def best_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.best_checkpoint(_history(spark, sf_dir))


@query
def early_stop_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.early_stop_epoch(_history(spark, sf_dir), 5)
