"""Every registered query against its SQL counterpart, whole tables."""

import pytest
from compare import canonical, connect, duck_result, spark_result

import __spark_entry__ as entry_module
from answerloom.plans import catalog

QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    own = set(catalog.QUERIES)
    assert own - set(SQL) == {"rougeL_documents"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_result(spark, sf_dir, con, name):
    assert spark_result(QUERIES[name](spark, sf_dir)) == duck_result(con, SQL[name])


def test_entry(spark, sf_dir):
    rows = entry_module.entry(spark).collect()
    assert rows and {"subset", "count", "combined"} <= set(rows[0].asDict())


def test_file_audit(spark, sf_dir):
    from answerloom.sources.tables import file_audit

    wanted = [f"{n}.parquet" for n in ("documents", "conversations", "events", "answers")]
    rows = {r["file"]: r for r in file_audit(spark, sf_dir, wanted).collect()}
    assert rows["documents.parquet"]["present"] and rows["documents.parquet"]["size_mb"] > 0
    assert not rows["answers.parquet"]["present"] and rows["answers.parquet"]["empty"]


def test_whole_document_rouge_matches_plain_dynamic_programming(spark, sf_dir):
    from pyspark.sql import functions as F

    from answerloom.functions.text import sentinel_cleanup
    from answerloom.plans.corpora import documents_qa

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    # the shortest answers only, as the plain algorithm is quadratic
    texts = documents_qa(spark, sf_dir).select("ID", "output", sentinel_cleanup(F.col("generation")).alias("g"))
    short = texts.where(F.length("output") < 900).collect()
    got = {r["ID"]: r["rougeL_f1"] for r in QUERIES["rougeL_documents"](spark, sf_dir).collect()}
    assert len(got) == texts.count() and len(short) > 20
    for r in short:
        a, b = r["g"].split(), r["output"].split()
        n = lcs(a, b)
        want = 0.0 if n == 0 else 2 * (n / len(a)) * (n / len(b)) / (n / len(a) + n / len(b))
        assert got[r["ID"]] == pytest.approx(want, abs=1e-12)


def test_canonical_sorts_columns_by_name():
    assert canonical(["b", "a"], [(1, 2.0)]) == (["a", "b"], [(2.0, 1)])
