"""Fuzzy line deduplication: SimHash, pigeonhole blocks, edit similarity, groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.llm.frames import fresh, let, text_of, whole_row
from answerloom.llm.groups import connect, only_possible
from answerloom.sources.staging import stage

#: Two lines are alike if their edit similarity is at least SIMILARITY and their SimHash codes
#: agree in a block and differ in at most FAR bits (lines that share no word differ in half).
SIMILARITY = 0.8
#: Shorter words are in most lines and would make unrelated codes agree.
LETTERS = 4
#: A code has PARTS times 64 bits; BLOCKS blocks of WIDTH bits are cut from it.
PARTS, WIDTH, FAR = 4, 28, 80
BLOCKS = PARTS * 64 // WIDTH
#: Codes that differ in at most so many bits agree in a block (pigeonhole principle).
DISTANCE = BLOCKS - 1
#: Votes of so many words fit lanes of 8 bits, with a bit to spare for the sign.
_CHUNK = 63
_BYTES, _EVERY_FOURTH, _PAIR = 0x0101010101010101, 0x000000FF000000FF, 0x0000000100000001


def normalised(line: Column) -> Column:
    """Lower case, letters and digits only, single spaces."""
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def simhash(lines: DataFrame) -> DataFrame:
    """(node, c0, c1, ...): SimHash codes of (node, line), ``PARTS`` times 64 bits a line.

    Bit ``b`` of part ``j`` is set if more than half of the line's words of LETTERS letters or more
    (of all words, if there is none) have it set in ``xxhash64(word, j)``.  Votes on eight bits are added up in one long for up to 63 words; longer
    lines add those up, two bits in a long.
    """
    spaces = F.length("line") - F.length(F.replace("line", F.lit(" ")))
    # told apart before the words are rows
    kinds = lines.select(
        "node",
        "line",
        (spaces >= _CHUNK).alias("long"),
        (~F.col("line").rlike(rf"\S{{{LETTERS}}}")).alias("all"),
    )
    words = kinds.select(
        "node", "long", "all", F.posexplode(F.split("line", " ")).alias("at", "word")
    ).where(F.col("all") | (F.length("word") >= LETTERS))
    hashes = words.select(
        "node",
        "long",
        F.expr(f"at div {_CHUNK}").alias("chunk"),
        *[F.xxhash64("word", F.lit(j)).alias(f"h{j}") for j in range(PARTS)],
    )
    lanes = [(j, i) for j in range(PARTS) for i in range(8)]
    packed = hashes.groupBy("node", "long", "chunk").agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.sum(F.shiftrightunsigned(f"h{j}", i).bitwiseAND(F.lit(_BYTES))).alias(f"v{j}_{i}")
            for j, i in lanes
        ],
    )
    wide = packed.where("long").groupBy("node").agg(
        F.sum("n").alias("n"),
        *[
            F.sum(F.shiftrightunsigned(f"v{j}_{i}", 8 * s).bitwiseAND(F.lit(_EVERY_FOURTH))).alias(
                f"v{j}_{i + 8 * s}"
            )
            for j, i in lanes
            for s in range(4)
        ],
    )
    return _codes(packed.where("not long"), 8, 6, _BYTES).unionByName(_codes(wide, 32, 30, _PAIR))


def _codes(votes: DataFrame, lanes: int, top: int, ones: int) -> DataFrame:
    """Codes from votes in ``lanes`` columns a part: bit ``top`` of a lane is set by more votes
    than half of ``n`` if what is missing to it is added; ``ones`` has bit 0 of each lane set."""
    lift = ((F.lit((1 << top) - 1) - F.floor(F.col("n") / 2)) * ones).alias("lift")

    def part(j: int) -> Column:
        bits = (
            F.shiftleft(F.shiftrightunsigned(F.col(f"v{j}_{b}") + F.col("lift"), top).bitwiseAND(F.lit(ones)), b)
            for b in range(lanes)
        )
        return reduce(Column.bitwiseOR, bits).alias(f"c{j}")

    return votes.select("*", lift).select("node", *[part(j) for j in range(PARTS)])


def block_keys() -> Column:
    """The blocks of a code in ``c0``, ``c1``, ..., each marked with its number."""

    def block(t: int) -> Column:
        j, skip = divmod(t * WIDTH, 64)
        value = F.shiftrightunsigned(f"c{j}", skip)
        if skip + WIDTH > 64:
            value = value.bitwiseOR(F.shiftleft(F.col(f"c{j + 1}"), 64 - skip))
        return value.bitwiseAND(F.lit((1 << WIDTH) - 1)) + F.lit(t << WIDTH)

    return F.array(*[block(t) for t in range(BLOCKS)])


def _common_prefix(a: Column, b: Column) -> Column:
    """Length of the common prefix, by steps of halving length."""
    steps = F.sequence(F.lit(30), F.lit(0), F.lit(-1))
    return F.aggregate(
        steps,
        F.lit(0),
        lambda n, k: let(
            F.call_function("shiftleft", F.lit(1), k),
            lambda step: F.when(
                (n + step <= F.least(F.length(a), F.length(b)))
                & (F.substring(a, n + 1, step) == F.substring(b, n + 1, step)),
                n + step,
            ).otherwise(n),
        ),
    )


def _middles(a: Column, b: Column) -> tuple[Column, Column]:
    """Both texts less their common prefix and suffix; their edit distance is the same."""

    def cut(x: Column, n: Column) -> Column:
        return F.substring(x, n + 1, F.length(x))

    pair = let(
        _common_prefix(a, b), lambda n: F.struct(cut(a, n).alias("a"), cut(b, n).alias("b"))
    )
    back = let(
        pair,
        lambda p: let(
            F.struct(F.reverse(p["a"]).alias("a"), F.reverse(p["b"]).alias("b")),
            lambda r: let(
                _common_prefix(r["a"], r["b"]),
                lambda n: F.struct(cut(r["a"], n).alias("a"), cut(r["b"], n).alias("b")),
            ),
        ),
    )
    return back["a"], back["b"]


def alike(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """Rows of (a, b) whose lines are alike.

    ``lines`` has (node, line) and the codes.  Lengths or codes too far apart end first; only
    the other lines are fetched.
    """
    parts = [f"c{j}" for j in range(PARTS)]
    x, y = (
        lines.select(F.col("node").alias(k), F.length("line").alias(f"n{k}"), F.struct(*parts).alias(f"c{k}"))
        for k in "ab"
    )
    longer, shorter = F.greatest("na", "nb"), F.least("na", "nb")
    differ = sum((F.bit_count(F.col(f"ca.{c}").bitwiseXOR(F.col(f"cb.{c}"))) for c in parts), F.lit(0))
    close = (shorter >= SIMILARITY * longer) & (differ <= FAR)
    near = stage(pairs.join(x, "a").join(y, "b").where(close).select("a", "b"), "near-codes")
    x, y = (lines.select(F.col("node").alias(k), F.col("line").alias(f"l{k}")) for k in "ab")
    most = F.floor((1 - SIMILARITY) * F.greatest(F.length("la"), F.length("lb"))).cast("int")
    # -1 beyond the limit, where counting ends early
    edits = F.call_function("levenshtein", *_middles(F.col("la"), F.col("lb")), most)
    return near.join(x, "a").join(y, "b").where(edits >= 0).select("a", "b")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``; ``n_lines`` and ``n_dropped`` added.

    Lines are split at \\n.  Lines that are equal after normalisation, or alike (edit similarity
    of at least SIMILARITY, a block of the SimHash in common, which codes within DISTANCE bits
    have, and no more than FAR bits apart), are linked; of each connected group the occurrence with the smallest id, text hash and line number stays (null ids first), all others go, also within
    a text.  Lines without letters or digits stay as they are.  Rows with the same id and
    text count as one document and keep the same lines.  A null text stays null, an empty
    one empty; a text that loses all lines becomes empty.  All rows and other columns
    stay; a new name that is taken gets a leading underscore.
    """
    n_lines, n_dropped = fresh(docs, "n_lines", "n_dropped")
    body = text_of(text)
    ident = F.col(doc_id).cast("bigint")
    row = F.xxhash64(F.coalesce(ident, F.lit(-1)), F.isnull(ident).cast("int"), F.xxhash64(body))
    keys = ["id", "row", "number", "node"]

    def lines_with_words(rows: DataFrame) -> DataFrame:
        split = rows.select(
            ident.alias("id"), row.alias("row"), F.posexplode(F.split(body, "\n")).alias("number", "raw")
        ).withColumn("line", normalised(F.col("raw")))
        return split.select("id", "row", "number", F.xxhash64("line", F.lit(11)).alias("node"), "line")

    marked = lines_with_words(docs).where("line <> ''")
    places = stage(marked.select(*keys), "line-places")
    unique = marked.groupBy("node").agg(
        F.min(F.struct("id", "row", "number")).alias("first"),
        F.first("line").alias("line"),
        F.count(F.lit(1)).alias("n"),
    )
    # codes are counted where the lines already are: one shuffle serves both sides of the join,
    # if both use all its columns
    used = unique.where("n > 0 and first.row is not null").select("node", "line")
    unique = stage(unique.join(simhash(used), "node"), "line-nodes")
    members = unique.select(F.explode(block_keys()).alias("bucket"), "node")
    labels = stage(connect(members, lambda pairs: alike(pairs, unique)), "line-labels")
    grouped = (
        unique.select("node", "first", "n")
        .join(labels, "node", "left")
        .where("n > 1 or label is not null")
        .select("node", F.coalesce("label", "node").alias("label"), "first")
    )
    keepers = grouped.groupBy("label").agg(F.min("first").alias("keep"))
    repeated = stage(grouped.join(keepers, "label").select("node", "keep"), "repeated-lines")
    drops = (
        only_possible(places.select("id", "row", "number", "node"), "node", repeated)
        .join(repeated, "node")
        .where(~F.struct("id", "row", "number").eqNullSafe(F.col("keep")))
        .groupBy("row")
        .agg(F.collect_set("number").alias("drop"))
    )
    lines_of = F.split(F.col("body"), "\n")
    kept = F.filter(lines_of, lambda x, i: ~F.array_contains("drop", i))
    drops = stage(drops, "line-drops")
    packed = docs.select(whole_row(docs).alias("doc"), row.alias("row"), body.alias("body"))
    # texts that surely keep all lines need not move
    out = only_possible(packed, "row", drops).join(drops, "row", "left").unionByName(
        only_possible(packed, "row", drops, surely_not=True).withColumn(
            "drop", F.lit(None).cast("array<int>")
        )
    )
    some = F.col("drop").isNotNull()
    new = F.when(some, F.array_join(kept, "\n")).otherwise(F.col(f"doc.`{text}`"))
    return out.select(
        *[new.alias(c) if c == text else F.col(f"doc.`{c}`") for c in docs.columns],
        F.size(lines_of).alias(n_lines),
        F.when(some, F.size("drop")).otherwise(0).alias(n_dropped),
    )
