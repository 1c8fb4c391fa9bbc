"""Python workers get batches of a few MB, whatever the texts' size."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from answerloom.llm.bpe import round_trip
from answerloom.llm.minhash import near_duplicates
from answerloom.llm.queries import tokenizer
from answerloom.operators.scoring import score_pairs

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


STEPS = {
    "encode": lambda docs: round_trip(docs, *tokenizer()),
    "duplicates": near_duplicates,
    "score": lambda docs: score_pairs(docs, "text", "text"),
}


@pytest.mark.parametrize("step", STEPS)
def test_large_texts_go_in_small_batches(spark, step):
    def batch_bytes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    spark.conf.unset(LIMIT)
    few = spark.createDataFrame([(1, "some words")], "doc_id bigint, text string")
    long = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("x"), 500_000).alias("text"))
    try:
        STEPS[step](few)
        sizes = [r["n"] for r in long.mapInArrow(batch_bytes, "n bigint").collect()]
        assert sum(sizes) >= 20_000_000
        assert max(sizes) < 8_000_000
        spark.conf.set(LIMIT, "1m")
        STEPS[step](few)
        assert spark.conf.get(LIMIT) == "1m"
    finally:
        spark.conf.unset(LIMIT)
