import re

import pytest
from pyspark.sql import functions as F

from answerloom.functions import text as T
from answerloom.functions.arrays import value_counts
from answerloom.operators.corpus import clean_split, training_pairs

SPACES = [chr(i) for i in range(0x110000) if chr(i).isspace()]


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


def test_there_are_29_whitespace_characters():
    assert len(SPACES) == 29


def test_clean_text_matches_python(spark):
    texts = ["\r\n drink\x0b\x0cwarm \x1f water \x85", None, "ሙቅ ውሃ ጠጣ", "", "\u3000", "no\u200bbreak", "\ufeffmark", "ŋ ɖ"]
    texts += [f"{c}x{c}{c}y{c}" for c in SPACES]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select(
        "i",
        T.clean_text(F.col("t")).alias("c"),
        T.clean_strip(F.col("t")).alias("s"),
        T.tokenize_ws(F.col("t")).alias("w"),
        T.has_text(F.col("t")).alias("h"),
        T.clean_text(T.clean_text(F.col("t"))).alias("cc"),
    ).collect()
    for r in got:
        t = texts[r["i"]] or ""
        assert r["c"] == re.sub(r"\s+", " ", t).strip() == r["cc"]
        assert r["s"] == t.strip()
        assert r["w"] == t.split()
        assert r["h"] == (r["c"] != "")


@pytest.mark.parametrize(
    "code,name",
    [("Lug_Xyz", "Luganda"), ("Swa", "Swahili"), ("eng_Uga", "eng_Uga"), ("", "English"), (None, "English"),
     ("Fra_Cmr", "Fra_Cmr"), ("_Eth", "_Eth")],
)
def test_language_name(spark, code, name):
    assert one(spark, T.language_name(F.col("s")), s=code) == name


@pytest.mark.parametrize(
    "style,whole",
    [("bare", "how long to boil water"), ("lang_prefix", "Luganda: how long to boil water"),
     ("instruction", "Answer this health question in Luganda: how long to boil water")],
)
def test_prompt_styles(spark, style, whole):
    got = one(spark, T.build_prompt(F.col("q"), F.col("s"), style), q=" how long\nto boil water ", s="Lug_Uga")
    assert got == whole


def test_prompt_with_exemplar(spark):
    def prompt(r):
        column = T.build_prompt(F.col("q"), F.col("s"), "bare", F.col("r"))
        return one(spark, column, q="fever in the night", s="Zul_Zaf", r=r)

    assert prompt("see a nurse,\n if it stays") == "fever in the night\nReference: see a nurse, if it stays"
    assert prompt("") == prompt(None) == "fever in the night"
    # tested before cleaning: a blank exemplar still opens the line
    assert prompt("\t") == "fever in the night\nReference: "


def test_unknown_style_fails_when_the_plan_is_built(spark):
    with pytest.raises(ValueError):
        T.build_prompt(F.col("q"), F.col("s"), "poem")


@pytest.mark.parametrize(
    "text,spaced,deleted",
    [("a<extra_id_0> <extra_id_1>b", "a  b", "a b"), ("<extra_id_12>", "", ""), (None, "", ""),
     ("a<extra_id_0>b", "a b", "ab"), ("a   b", "a  b", "a   b"), ("<extra_id_>", "<extra_id_>", "<extra_id_>")],
)
def test_sentinels(spark, text, spaced, deleted):
    assert one(spark, T.sentinel_cleanup(F.col("t")), t=text) == spaced
    assert one(spark, T.sentinel_delete(F.col("t")), t=text) == deleted


@pytest.mark.parametrize("text,share", [("ab1", 1.0), ("", 0.0), ("123", 0.0), ("aለ", 0.5), (None, 0.0)])
def test_latin_fraction(spark, text, share):
    assert one(spark, T.latin_fraction(F.col("t")), t=text) == share


def test_char_ngrams(spark):
    def expected(t):
        padded = [f" {w} " for w in t.split()]
        return sorted(p[i : i + n] for p in padded for n in (3, 4, 5) for i in range(len(p) - n + 1))

    for t in ("a", "ab cd", "hello", "ለመ é", "", "  x  yz "):
        assert sorted(one(spark, T.char_ngrams(F.col("t")), t=t)) == expected(t)


def test_value_counts(spark):
    got = one(spark, value_counts(F.split("t", " ")), t="b a b c b a")
    assert got == {"a": 2, "b": 3, "c": 1}
    assert one(spark, value_counts(T.tokenize_ws(F.col("t"))), t="") == {}


def test_clean_split_drops_blank_rows(spark):
    rows = [("1", " q ", "a"), ("2", " ", "a"), ("3", "q", None), ("4", "q", "b\n\nc")]
    df = spark.createDataFrame(rows, "ID string, input string, output string")
    assert [tuple(r) for r in clean_split(df).collect()] == [("1", "q", "a"), ("4", "q", "b c")]
    assert clean_split(df, has_answer=False).count() == 3


def test_training_pairs_without_subset(spark):
    df = spark.createDataFrame([("1", "q", "a", "r")], "ID string, input string, output string, r string")
    assert training_pairs(df, retrieved="r").first()["prompt"] == "English: q"
    assert "Reference: r" in training_pairs(df, retrieved="r", augment=True).first()["prompt"]


def test_expressions_stay_streamable(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("1", " a  b ", "Swa_Ken")], "ID string, input string, subset string").write.parquet(src)
    stream = spark.readStream.schema("ID string, input string, subset string").parquet(src)
    out = stream.select(T.build_prompt(F.col("input"), F.col("subset")).alias("p"))
    q = out.writeStream.format("memory").queryName("prompts").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [r["p"] for r in spark.table("prompts").collect()] == ["Swahili: a b"]


def test_lcs_turns_few_rows_at_a_time_into_objects(spark, monkeypatch):
    """Batches stay in Arrow; null tokens and empty lists count, too."""
    from pyspark.sql import functions as F

    from answerloom.functions.rouge import lcs_length

    made = []
    plain = F.pandas_udf
    monkeypatch.setattr(F, "pandas_udf", lambda *a, **b: made.append(a) or plain(*a, **b))
    rows = [(n, ["a", "b", "c"] * (n % 3), ["b", "x", "c", "a"]) for n in range(150)]
    df = spark.createDataFrame(rows, "n int, a array<string>, b array<string>").coalesce(1)
    got = {r[0]: r[1] for r in df.select("n", lcs_length(F.col("a"), F.col("b"))).collect()}
    assert got == {n: (0, 2, 3)[n % 3] for n in range(150)}
    assert not made


def test_first_words_leave_the_rest_alone(spark):
    """The first words of a text with blanks at its ends; what lies behind them is not split."""
    texts = ["", "  ", " a  b\tc\nd ", "a b", "one", "　x y z", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for n in (0, 1, 2, 3, 9):
        got = [r[0] for r in rows.select(T.tokenize_ws(F.col("t"), n)).collect()]
        assert got == [(t or "").split()[:n] for t in texts]
    plan = rows.select(T.tokenize_ws(F.col("t"), 3))._jdf.queryExecution().toString()
    assert ", 5)" in plan and "regexp_replace" not in plan
