import pytest
from pyspark.sql import types as T

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents of (doc_id, text) or (doc_id, text, source)."""

    def make(rows):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1]))
            for r in rows
        ]
        return spark.createDataFrame(full, DOCS).coalesce(2)

    return make


@pytest.fixture(scope="session")
def clashing():
    """Names that operators use inside, as extra columns."""
    return [
        "row", "doc", "body", "node", "label", "bucket", "shard", "slot", "_piece", "_key0", "words",
        "key", "size", "copies", "piece", "k0", "id", "rank", "digest", "token", "code", "drop",
    ]
