"""Fuzzy lines against plain Python over all pairs."""

import random
import re
import struct

import xxhash
from pyspark.sql import functions as F

from answerloom.llm.lines import BLOCKS, DISTANCE, FAR, LETTERS, PARTS, SIMILARITY, WIDTH, dedup_lines, normalised, simhash


def norm(line):
    return re.sub(r"[\W_]+", " ", line.lower()).strip()


def signed(n):
    return n - (1 << 64) if n >= 1 << 63 else n


def code(line):
    """The parts of a code, from bit 0 of part 0 on, as one number."""
    words = line.split(" ")
    words = [w for w in words if len(w) >= LETTERS] or words
    whole = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in words]
    out = 0
    for j in range(PARTS):
        values = [xxhash.xxh64(struct.pack("<i", j), seed=v).intdigest() for v in whole]
        for b in range(64):
            out |= (2 * sum(v >> b & 1 for v in values) > len(words)) << (64 * j + b)
    return out


def meet(a, b):
    """Whether two codes agree in a block."""
    other = a ^ b
    return any(other >> WIDTH * t & (1 << WIDTH) - 1 == 0 for t in range(BLOCKS))


def edits(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def brute(docs):
    """{position: text} with one occurrence of each group, smallest id first."""
    lines = {norm(x) for _, t in docs for x in (t or "").split("\n")} - {""}
    order = sorted(lines)
    codes = {x: code(x) for x in order}
    top = {x: x for x in order}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(order):
        for b in order[:i]:
            near = bin((codes[a] ^ codes[b]) & (1 << WIDTH * BLOCKS) - 1).count("1") <= DISTANCE
            assert meet(codes[a], codes[b]) or not near
            if meet(codes[a], codes[b]) and bin(codes[a] ^ codes[b]).count("1") <= FAR:
                long, short = max(len(a), len(b)), min(len(a), len(b))
                if short >= SIMILARITY * long and edits(a, b) <= (1 - SIMILARITY) * long:
                    top[find(a)] = find(b)
    seen, out = {}, {}
    for i in sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0)):
        kept = []
        for number, raw in enumerate((docs[i][1] or "").split("\n")):
            n = norm(raw)
            place = (docs[i][0], docs[i][1], number)
            if n == "" or seen.setdefault(find(n), place) == place:
                kept.append(raw)
        out[i] = None if docs[i][1] is None else "\n".join(kept)
    return out


def rows(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def expected(docs):
    got = brute(docs)
    return sorted(((docs[i][0], got[i]) for i in got), key=repr)


def sample():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(400)]
    line = lambda n: " ".join(rng.choices(words, k=n))
    base = [line(rng.randint(1, 80)) for _ in range(60)]
    docs = []
    for i in range(80):
        own = []
        for _ in range(rng.randint(1, 6)):
            text = rng.choice(base) if rng.random() < 0.6 else line(rng.randint(3, 60))
            w = text.split(" ")
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                w[rng.randrange(len(w))] = rng.choice(words)
            text = " ".join(w)
            own.append(text.upper() + "!" if rng.random() < 0.2 else text)
        own.insert(rng.randrange(len(own) + 1), rng.choice(["", "***", "  "]))
        docs.append((i, "\n".join(own)))
    return docs


def test_against_all_pairs(make_docs):
    docs = sample()
    assert rows(dedup_lines(make_docs(docs))) == expected(docs)


def test_simhash_and_normal_form(spark):
    texts = ["One, two!  THREE", "a " * 70_000 + "b", "Été 42 -- naïve", "x", " ".join(map(str, range(1000, 1126)))]
    df = spark.createDataFrame(list(enumerate(texts)), "node long, t string").select(
        "node", normalised(F.col("t")).alias("line")
    )
    assert [r["line"] for r in df.orderBy("node").collect()] == [norm(t) for t in texts]
    got = {r["node"]: list(r)[1:] for r in simhash(df).collect()}
    parts = lambda n: [signed(n >> 64 * j & (1 << 64) - 1) for j in range(PARTS)]
    assert got == {i: parts(code(norm(t))) for i, t in enumerate(texts)}


def test_edge_cases(spark, make_docs, clashing):
    long = "\n".join(f"line number {i} of a very long text" for i in range(3000))
    docs = [
        (1, None), (2, ""), (3, "\n\n"), (4, "same line here\nsame line here"), (5, "Same line, here."),
        (6, "twice the same row"), (6, "twice the same row"), (None, "of nobody\nsame line here"),
        (7, "!!!\n???"), (8, long), (9, long),
    ]
    df = make_docs(docs).withColumns({c: F.lit(c) for c in clashing})
    out = dedup_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"]
    # all lines of the long text are alike, so its first one stands for them in the plain version
    head = long.split("\n", 1)[0]
    plain = expected([(i, head if t == long else t) for i, t in docs])
    assert rows(out) == plain and (8, head) in plain and (9, "") in plain
    assert out.where("row <> 'row' or drop <> 'drop'").count() == 0
    assert dedup_lines(make_docs([])).collect() == []


def test_hot_line(make_docs):
    """One line in every document, and a crowd of lines that differ in one word."""
    words = [f"w{i}" for i in range(120)]
    docs = [
        (i, "shared by all of them\n" + " ".join(words[:60] + [f"own{i % 40}"] + words[60:]))
        for i in range(200)
    ]
    assert rows(dedup_lines(make_docs(docs))) == expected(docs)


def test_changed_words_at_every_length(make_docs):
    """Lines of 8 to 60 words with up to a fifth of the words replaced, or letters mistyped:
    all pairs whose codes meet are found, and no others."""
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(3000)]
    pairs = []
    for n in (8, 10, 15, 20, 30, 40, 60):
        for share in (0, 0.1, 0.15):
            for _ in range(5):
                old = rng.choices(words, k=n)
                new = list(old)
                for i in rng.sample(range(n), max(1, int(share * n))):
                    new[i] = rng.choice(words)
                pairs.append((" ".join(old), " ".join(new)))
        old = rng.choices(words, k=n)
        letters = list(" ".join(old))
        for i in rng.sample(range(len(letters)), len(letters) // 20):
            letters[i] = "z"
        pairs.append((" ".join(old), "".join(letters)))
    linked = [p for p in pairs if edits(*p) <= (1 - SIMILARITY) * max(map(len, p))]
    assert len(linked) > 90
    docs = [(k * len(linked) + i, p[k]) for k in (0, 1) for i, p in enumerate(linked)]
    found = rows(dedup_lines(make_docs(docs)))
    assert found == expected(docs)
    # one word in ten of a short line moves the code too far, one of a long line does not
    gone = {i - len(linked) for i, text in found if not text}
    assert {i for i, p in enumerate(linked) if p[0] == p[1]} <= gone and len(gone) > 20
