import random
import re
from collections import Counter

from pyspark.sql import functions as F

from answerloom.llm.rules import Rule, cascade, default_rules, order_rules

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_base_columns(make_docs, clashing):
    rng = random.Random(3)
    texts = [None, "", "\n \t\n", "a b c d e", "a b c d e a b c d e", "x " * 500, "é#* <b> 🙂 |", "l\nl\n\nl\n ", "a\x0bb\x0cc\rd\x1ce\xa0f"]
    texts += [" ".join(rng.choices(["a", "b", "c\n", "d#"], k=rng.randint(1, 120))) for _ in range(150)]
    texts += [" ".join(f"w{i % 7000}" for i in range(20_000))]
    df = make_docs(list(enumerate(texts))).withColumns({c: F.lit(c) for c in [*clashing, "kept"]})
    out = cascade(df)
    assert out.columns[-1] == "_kept"
    for r in out.collect():
        want = brute(texts[r["doc_id"]])
        assert tuple(r[c] for c in BASE) == want, r["doc_id"]
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert r["base_failed"] == failed and not (failed and r["_kept"])


def test_order_changes_no_verdict(make_docs):
    df = make_docs([(i, f"this is text number {i} with enough words to pass " + "#" * (i % 40)) for i in range(200)])
    verdicts = {tuple(sorted((r["doc_id"], r["kept"]) for r in cascade(df, rules=rules).collect()))
                for rules in (default_rules(), default_rules()[::-1], default_rules()[3:] + default_rules()[:3])}
    assert len(verdicts) == 1 and {k for _, k in verdicts.pop()} == {True, False}
    assert cascade(make_docs([])).collect() == []


def test_strong_cheap_rules_come_first(make_docs):
    df = make_docs([(i, "x") for i in range(300)]).withColumns({"n_words": F.lit(1), "body": F.col("text")})
    never = Rule("never", F.regexp_count(F.repeat("body", F.lit(3000)), F.lit("y")) > 0)
    always = Rule("always", F.col("n_words") > 0)
    assert [r.name for r in order_rules(df, [never, always])] == ["always", "never"]


def test_rules_are_placed_by_what_is_left(make_docs):
    """A rule that only repeats what another one rejects comes last, however much that is."""
    df = make_docs([(i, "x") for i in range(300)])
    many = [Rule(name, F.col("doc_id") < 200) for name in ("one", "same")]
    order = order_rules(df.withColumn("n_words", F.lit(1)), [*many, Rule("other", F.col("doc_id") >= 280)])
    assert len(order) == 3 and order[-1].name in {"one", "same"}
