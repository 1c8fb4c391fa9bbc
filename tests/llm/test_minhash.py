"""Near-duplicate classes against weighted Jaccard over all pairs."""

import random

import numpy as np
from pyspark.sql import functions as F

from answerloom.llm import groups
from answerloom.llm.minhash import (
    SIMILARITY,
    damped_idf,
    document_frequencies,
    drop_near_duplicates,
    near_duplicates,
    shingles,
    signatures,
    weighted_jaccard,
    word_hashes,
)


def sample():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    docs, n = [], 0
    passage = " ".join(rng.choices(words, k=60))
    for _ in range(40):
        base = rng.choices(words, k=rng.randint(3, 300))
        for _ in range(rng.choice([1, 1, 2, 6])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 8, 20])):
                own[rng.randrange(len(own))] = rng.choice(words)
            text = " ".join(own)
            docs.append((n, text if rng.random() < 0.7 else passage + " " + text))
            n += 1
    return docs + [(n + i, docs[5][1].upper() + "!" * (i % 2)) for i in range(30)]


def brute(spark, df):
    rows = df.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), word_hashes(F.coalesce("text", F.lit(""))).alias("w")
    ).collect()
    counts, documents = document_frequencies(df.select(word_hashes(F.coalesce("text", F.lit(""))).alias("words")))
    idf = damped_idf(counts, documents)
    sets = [shingles(np.array(r["w"], dtype=np.int64), np.array([len(r["w"])])) for r in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i], rows[j]
            like = a["text"] != "" and a["text"] == b["text"]
            if not like and len(sets[i][0]) and len(sets[j][0]):
                like = weighted_jaccard(sets[i], sets[j], idf, 1)[0] >= SIMILARITY
            if like:
                top[find(i)] = find(j)
    low, size = {}, {}
    for i, r in enumerate(rows):
        k = find(i)
        low.setdefault(k, []).append(r["doc_id"])
        size[k] = size.get(k, 0) + 1
    first = {k: min((x for x in v if x is not None), default=None) for k, v in low.items()}
    return sorted(((r["doc_id"], first[find(i)], size[find(i)]) for i, r in enumerate(rows)), key=repr)


def classes(df):
    return sorted(((r["doc_id"], r["class_id"], r["class_size"]) for r in near_duplicates(df).collect()), key=repr)


def test_against_all_pairs(spark, make_docs):
    df = make_docs(sample())
    assert classes(df) == brute(spark, df)
    kept = sorted(r["doc_id"] for r in drop_near_duplicates(df).collect())
    assert kept == sorted({c for _, c, _ in brute(spark, df)})


def test_edge_cases(spark, make_docs, clashing):
    docs = [(1, None), (2, None), (3, ""), (4, ""), (5, "***"), (6, "***"), (7, "one two"), (8, "One, two."), (9, "one"),
            (10, "a b c d e f"), (10, "a b c d e f"), (None, "a b c d e f"), (None, "lone text of nobody at all"),
            (11, " ".join(f"x{i}" for i in range(30_000)))]
    df = make_docs(docs).withColumns({c: F.lit(c) for c in clashing})
    assert classes(df) == brute(spark, df)
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    got = sorted((r["doc_id"] for r in kept.collect()), key=lambda x: (x is None, x))
    assert got == [1, 2, 3, 4, 5, 7, 9, 10, 11, None]
    assert classes(make_docs([])) == [] and drop_near_duplicates(make_docs([])).collect() == []


def test_samples_agree_as_often_as_the_similarity():
    rng = np.random.default_rng(1)
    shingle = rng.integers(0, 2**63, 400).astype(np.uint64)
    weight = rng.uniform(1, 5, 400)
    other = weight * np.where(rng.random(400) < 0.3, rng.uniform(0.2, 2.0, 400), 1.0)
    a = signatures(np.zeros(400, dtype=int), shingle, weight, 3000)[0]
    b = signatures(np.zeros(400, dtype=int), shingle, other, 3000)[0]
    true = np.minimum(weight, other).sum() / np.maximum(weight, other).sum()
    assert abs((a == b).mean() - true) < 0.03


def test_crowd_in_one_bucket(make_docs):
    """Many copies of one text, each with a word of its own, are one class."""
    words = [f"w{i}" for i in range(200)]
    df = make_docs([(i, " ".join(words[:100] + [f"own{i}"] + words[100:])) for i in range(300)])
    assert {c for _, c, _ in classes(df)} == {0}


def test_family_of_unlike_copies(spark, make_docs):
    """Copies with 0 to 25 % of their words replaced: some pairs are links, most are not, and
    all of them meet in the same buckets."""
    rng = random.Random(21)
    words = [f"w{i}" for i in range(5000)]
    base = rng.choices(words, k=150)
    docs = []
    for i in range(160):
        own = list(base)
        at, n = rng.randrange(100), rng.choice([0, 1, 2, 3, 5, 8, 12, 20, 35])
        # half of them change a run of words, others words here and there
        for k in range(at, at + n) if i % 2 else rng.sample(range(150), n):
            own[k] = rng.choice(words)
        docs.append((i, " ".join(own)))
    df = make_docs(docs)
    found = classes(df)
    assert found == brute(spark, df)
    assert 1 < len({c for _, c, _ in found}) < 160


def test_pairs_that_lack_too_much_are_not_made(monkeypatch, make_docs):
    """Twins with a run of words of their own, in copies of one text: all meet in the same buckets,
    no word is in one text alone, and no two families are alike."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(5000)]
    base = rng.choices(words, k=150)
    docs = []
    for i in range(60):
        own, at = list(base), rng.randrange(130)
        own[at : at + 18] = rng.choices(words, k=18)
        docs += [(2 * i, " ".join(own)), (2 * i + 1, " ".join([*own, "more"]))]
    sizes = {}
    write = groups.stage
    monkeypatch.setattr(groups, "stage", lambda df, name, *keys: sizes.__setitem__(name, out := write(df, name, *keys)) or out)
    found = classes(make_docs(docs))
    assert len({c for _, c, _ in found}) > 40
    assert sizes["third-pairs"].count() < 500
