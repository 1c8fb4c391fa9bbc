"""Headline queries, one JSON line: seconds per query and in total."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from answerloom.plans.catalog import QUERIES
from answerloom.session import local_session
from answerloom.sources.staging import scratch

HEADLINE = [
    "retrieval_baseline",
    "gram_idf",
    "char_ngrams",
    "stratified_split",
    "shuffle_rows",
    "rouge1_pairs",
    "rougeL_documents",
    "rouge_by_subset",
    "subset_distribution",
    "length_stats",
    "length_histogram",
    "answer_reuse",
    "top_answers",
    "script_composition",
    "training_pairs",
    "batch_predict",
    "encode_examples",
    "pad_batches",
    "submission_check",
    "load_split",
    "early_stop_epoch",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's and the Python workers' engines before the clock runs
    QUERIES["rouge_by_subset"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        with scratch(spark):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
