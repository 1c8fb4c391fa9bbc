"""Phrase collocations: pairs counted in direct-address tiles, level by level.

Level ``L`` counts phrases of ``L`` words as pairs of the two phrases of ``L - 1`` words
that they consist of.  The ``HEAD`` most frequent of those have ranks; pairs of ranks fall into tiles of
``TILE`` x ``TILE`` cells.  A tile that many pairs of a slice fall into is counted by dense
bincount, all other pairs as sorted coordinates.  Frequent pairs are ranked anew for the next
level.  Only phrases whose parts are frequent can be frequent, so rare parts are left out early by
bitmaps of fixed size, which may let a rare phrase pass but never lose one; counts are exact.
Longer phrases are also counted by hash cells first, and those of cells that stay below the threshold
are left out; a few tasks a core then count the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from answerloom.llm.frames import text_of
from answerloom.sources.staging import stage

#: Ranked phrases of a level, and the side of a tile.
HEAD, TILE = 2048, 256
#: Bits of the filter over frequent phrases (8 MB).
FILTER_BITS = 1 << 26
#: Longest phrase.
LONGEST = 4
#: Phrases of so many words and more are first counted in CELLS cells by hash (one byte each, 8 MB a
#: task): the threshold is absolute, so more text makes more of their parts frequent than in proportion.
SIEVED, CELLS = 3, 1 << 23
_CELL_PART = 1 << 14
#: Join keys that each row of a looked-up table is spread over, as common words are in many phrases.
SALTS = 8
_SLICE = 1 << 18
_HELD = 1 << 19
#: Ids of a stored list, or a little more.
_LIST = 64
_IDS = ["w1", "w2", "w3", "w4"]
_U = np.uint64


def words_and_breaks(text: Column) -> Column:
    """Words of a text in lower case (A-Z only); each end of a piece is the word ``\\n``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = F.translate(text, upper, upper.lower())
    marked = F.regexp_replace(low, r"[.,;:!?\x0A-\x0D]+", " \n ")
    return F.filter(F.split(marked, r"[\x20\x09]+"), lambda w: w != "")


def _rotate(x: np.ndarray, n: int) -> np.ndarray:
    return (x << _U(n)) | (x >> _U(64 - n))


# The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (
    _U(0x9E3779B185EBCA87),
    _U(0xC2B2AE3D27D4EB4F),
    _U(0x165667B19E3779F9),
    _U(0x85EBCA77C2B2AE63),
    _U(0x27D4EB2F165667C5),
)


def xxhash_longs(columns: list[np.ndarray]) -> np.ndarray:
    """What ``F.xxhash64`` gives for these bigint columns, as unsigned numbers."""
    h = np.full(len(columns[0]), 42, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for c in columns:
            h = (h + _P5 + _U(8)) ^ (_rotate(c.view(np.uint64) * _P2, 31) * _P1)
            h = _rotate(h, 27) * _P1 + _P4
            h = (h ^ (h >> _U(33))) * _P2
            h = (h ^ (h >> _U(29))) * _P3
            h ^= h >> _U(32)
    return h


def _filter_of(hashes: DataFrame, name: str) -> np.ndarray:
    """Bytes of the bitmap over a column of hashes; at most 8 MB come to the driver."""
    spot = F.pmod(F.col(name), F.lit(FILTER_BITS)) + 1
    parts = (
        hashes.select(spot.alias("x"))
        .groupBy(F.bitmap_bucket_number("x").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("bits"))
    )
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for r in parts.toLocalIterator():
        start = (r["part"] - 1) * 4096
        out[start : start + 4096] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return out


def _passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    spot = h & _U(8 * len(bits) - 1)
    return (bits[(spot >> _U(3)).astype(np.intp)] >> (spot & _U(7)).astype(np.uint8)) & 1 == 1


class _Ranks:
    """Ranks of the most frequent phrases of one length; equal hashes are told apart."""

    def __init__(self, rows: list[tuple], width: int):
        self.keys = np.array(rows, dtype=np.int64).reshape(len(rows), width)
        h = xxhash_longs([np.ascontiguousarray(self.keys[:, i]) for i in range(width)])
        self.order = np.argsort(h, kind="stable")
        self.hashes = h[self.order]

    def of(self, columns: list[np.ndarray], h: np.ndarray) -> np.ndarray:
        """The rank of each row, -1 if it has none."""
        out = np.full(len(h), -1, dtype=np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            rank = self.order[at]
            hit = self.hashes[at] == h
            for i, c in enumerate(columns):
                hit &= self.keys[rank, i] == c
            out[hit] = rank[hit]
        return out


def _coordinates(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted coordinates with equal neighbours added up."""
    if not len(counts):
        return columns, counts
    order = np.argsort(xxhash_longs(columns))
    columns, counts = [c[order] for c in columns], counts[order]
    first = np.ones(len(counts), dtype=bool)
    first[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    at = np.flatnonzero(first)
    return [c[at] for c in columns], np.add.reduceat(counts, at)


def _id_slices(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    """The ids of a batch in slices that overlap by ``width`` - 1 ids."""
    column = batch.column("ids")
    ends = column.offsets.to_numpy()
    ids = column.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    for start in range(0, max(0, len(ids) - width + 1), _SLICE):
        yield np.ascontiguousarray(ids[start : start + _SLICE + width - 1])


def _parts_of(x: np.ndarray, width: int, bits: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Phrases one word shorter than ``width`` at each place, their hashes, whether they may be
    frequent, and the places at which both parts of a phrase may be."""
    short = width - 1
    n = len(x) - short + 1
    parts = [np.ascontiguousarray(x[i : i + n]) for i in range(short)]
    h = xxhash_longs(parts)
    good = np.logical_and.reduce([p != 0 for p in parts])
    good &= _passes(bits, h)
    return parts, h, good, np.flatnonzero(good[:-1] & good[1:])


def _sieve(lists: DataFrame, width: int, bits: np.ndarray, least: int) -> np.ndarray:
    """Bitmap of the hash cells with at least ``least`` phrases of ``width`` words whose parts may be
    frequent; 1 MB comes to the driver.  A cell may hold several phrases, so rare ones may pass."""
    most = min(least, 255)  # cells count up to that

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, dtype=np.uint8)
        for batch in batches:
            for x in _id_slices(batch, width):
                *_, at = _parts_of(x, width, bits)
                h = xxhash_longs([x[at + i] for i in range(width)])
                spot, n = np.unique((h & _U(CELLS - 1)).astype(np.int64), return_counts=True)
                cells[spot] = np.minimum(cells[spot] + n, most)
        used = {i: c.tobytes() for i, c in enumerate(cells.reshape(-1, _CELL_PART)) if c.any()}
        columns = [pa.array(list(used), pa.int32()), pa.array(list(used.values()), pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["part", "cells"])

    def full(table: pa.Table) -> pa.Table:
        cells = np.zeros(_CELL_PART, dtype=np.int64)
        for given in table.column("cells"):
            cells += np.frombuffer(given.as_buffer(), dtype=np.uint8)
        bitmap = np.packbits(cells >= most, bitorder="little").tobytes()
        return pa.table([table.column("part").slice(0, 1), pa.array([bitmap], pa.binary())], names=["part", "bits"])

    counted = lists.mapInArrow(run, "part int, cells binary")
    out = np.zeros((CELLS // _CELL_PART, _CELL_PART // 8), dtype=np.uint8)
    for r in counted.groupBy("part").applyInArrow(full, "part int, bits binary").collect():
        out[r["part"]] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return out.ravel()


def _count(width: int, ranks: _Ranks, bits: np.ndarray, names: list[str], sieve: np.ndarray | None = None):
    """Partial counts of phrases of ``width`` words over lists of ids; 0 ends a piece.

    Phrases that ``sieve`` shows to be rare are left out.
    """
    side = -(-HEAD // TILE)

    def out(columns: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in [*columns, counts]], [*names, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles: dict[int, np.ndarray] = {}
        held: list[tuple[list[np.ndarray], np.ndarray]] = []

        def merged() -> tuple[list[np.ndarray], np.ndarray]:
            columns = [np.concatenate([h[0][i] for h in held]) for i in range(width)]
            return _coordinates(columns, np.concatenate([h[1] for h in held]))

        for batch in batches:
            for x in _id_slices(batch, width):
                parts, h, good, at = _parts_of(x, width, bits)
                rank = np.where(good, ranks.of(parts, h), -1)
                if sieve is not None:
                    at = at[_passes(sieve, xxhash_longs([x[at + i] for i in range(width)]))]
                left, right = rank[at], rank[at + 1]
                both = (left >= 0) & (right >= 0)
                left, right = left[both], right[both]
                tile = (left // TILE) * side + right // TILE
                cell = (left % TILE) * TILE + right % TILE
                sparse = [at[~both]]
                load = np.bincount(tile, minlength=side * side)
                for t in np.flatnonzero(load):
                    mine = tile == t
                    if load[t] * 64 < TILE * TILE and t not in tiles:
                        sparse.append(at[both][mine])
                    else:
                        dense = np.bincount(cell[mine], minlength=TILE * TILE)
                        tiles[t] = tiles[t] + dense if t in tiles else dense
                at = np.concatenate(sparse)
                if len(at):
                    held.append(_coordinates([x[at + i] for i in range(width)], np.ones(len(at), dtype=np.int64)))
                if sum(len(c) for _, c in held) > _HELD:
                    held = [merged()]
                    if len(held[0][1]) > _HELD // 2:
                        yield out(*held.pop())
        if held:
            yield out(*merged())
        for t, dense in tiles.items():
            cell = np.flatnonzero(dense)
            left = ranks.keys[(t // side) * TILE + cell // TILE]
            right = ranks.keys[(t % side) * TILE + cell % TILE]
            # the parts overlap; pairs of ranks that do not are never counted
            columns = [np.ascontiguousarray(left[:, i]) for i in range(width - 1)]
            yield out([*columns, np.ascontiguousarray(right[:, -1])], dense[cell])

    return run


def _row_runs(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, last) position of runs of whole rows with about ``_SLICE`` values."""
    first = 0
    while first < len(ends) - 1:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + _SLICE, side="right")) - 1)
        yield int(ends[first]), int(ends[last])
        first = last


def _keep_frequent(bits: np.ndarray):
    """Ids with 0 for words that are surely rare, one 0 at a time, in short lists that end with 0.

    A 0 ends a piece wherever it stands, so lists need not be documents; short ones keep
    batches small.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ids")
            values = column.values.to_numpy(zero_copy_only=False)
            for start, end in _row_runs(column.offsets.to_numpy()):
                ids = np.ascontiguousarray(values[start:end])
                ids = np.where(_passes(bits, xxhash_longs([ids])), ids, 0)
                idle = ids == 0
                again = idle.copy()
                again[1:] &= idle[:-1]
                ids = ids[~again]
                # every document ends with a 0, and so does the last list
                breaks = np.flatnonzero(ids == 0) + 1
                part = breaks // _LIST
                offsets = np.append(0, breaks[np.append(part[1:] != part[:-1], True)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                yield pa.RecordBatch.from_arrays([lists], ["ids"])

    return run


def _salted(df: DataFrame, table: DataFrame, on: list[str], keys: list[str], value: str, how: str = "inner") -> DataFrame:
    """Join ``table`` (``keys``, ``value``) at columns ``on``, each of its rows at ``SALTS`` keys.

    By a shuffle: the planner takes the copies for the size of the compressed file that the table comes
    from, and would build tables of all of them in the driver, several at a time.
    """
    copies = table.select(*[F.col(k).alias(f"_{k}") for k in keys], value).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    salt = F.pmod(F.xxhash64(*_IDS), F.lit(SALTS)).cast("int")
    match = F.col("_salt0") == F.col("_salt")
    for a, k in zip(on, keys, strict=True):
        match &= F.col(a) == F.col(f"_{k}")
    out = df.withColumn("_salt0", salt).join(copies.hint("merge"), match, how)
    return out.drop("_salt0", "_salt", *[f"_{k}" for k in keys])


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 30, top: int = 2000
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two to four words by language.

    A phrase lies within a piece between ``.,;:!?`` and ends of lines; ``a`` counts all its
    occurrences, overlaps too.  Phrases with fewer than ``least`` are left out.  A cut gives the counts
    ``l`` and ``r`` of both parts and floor(2000000 a / (l + r)); the cut that scores least
    counts, ties to the earliest.  A phrase inside a longer one that has at least 80 % of its
    occurrences is dropped.  Ranked by score, then ``a``, then the bytes of the phrase; ``n`` is the
    number of all words of the language.  A null language is ``und``, a null text empty;
    an empty table gives no rows.  Other columns are not read.
    """
    code = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    words = docs.select(code.alias("lang"), words_and_breaks(text_of(text)).alias("words"))
    counts = stage(
        words.select("lang", F.explode("words").alias("word"))
        .where(F.col("word") != "\n")
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n")),
        "word-counts",
    )
    seed = _injective_seed(counts, least)
    numbered = counts.where(F.col("n") >= least).select(
        "lang", "word", "n", F.xxhash64("lang", "word", F.lit(seed)).alias("w1")
    )
    vocabulary = stage(numbered, "frequent-words")
    hashes = vocabulary.select(F.xxhash64("w1").alias("h"))
    bits = _filter_of(hashes, "h")
    ids = F.transform(
        "words",
        lambda w: F.when(w == "\n", F.lit(0).cast("bigint")).otherwise(F.xxhash64(F.col("lang"), w, F.lit(seed))),
    )
    lists = stage(
        words.select(F.concat(ids, F.array(F.lit(0).cast("bigint"))).alias("ids")).mapInArrow(
            _keep_frequent(bits), "ids array<bigint>"
        ),
        "word-ids",
    )
    levels = [vocabulary.select("w1", F.col("n").alias("a"))]
    for width in range(2, LONGEST + 1):
        parts, names = levels[-1], _IDS[:width]
        head = parts.orderBy(F.desc("a"), *_IDS[: width - 1]).limit(HEAD).collect()
        if width > 2:
            bits = _filter_of(parts.select(F.xxhash64(*_IDS[: width - 1]).alias("h")), "h")
        ranks = _Ranks([tuple(r)[:-1] for r in head], width - 1)
        sieve = _sieve(lists, width, bits, least) if width >= SIEVED else None
        schema = ", ".join(f"{c} bigint" for c in [*names, "n"])
        # a task gives a row for each frequent phrase that it meets: as many tasks as data allow would make
        # rows grow with the square of the text
        few = lists.coalesce(2 * lists.sparkSession.sparkContext.defaultParallelism) if sieve is not None else lists
        found = (
            few.mapInArrow(_count(width, ranks, bits, names, sieve), schema)
            .groupBy(*names)
            .agg(F.sum("n").alias("a"))
            .where(F.col("a") >= least)
        )
        levels.append(stage(found, f"phrases-{width}"))
    return _ranked(_scored(levels, vocabulary), vocabulary, counts, top)


def _injective_seed(counts: DataFrame, least: int) -> int:
    """A seed for which no frequent word shares its id with any other word."""
    seed = 1
    while True:
        ids = counts.select(F.xxhash64("lang", "word", F.lit(seed)).alias("id"), "n")
        shared = ids.groupBy("id").agg(F.count(F.lit(1)).alias("words"), F.max("n").alias("n"))
        if shared.where(((F.col("words") > 1) | (F.col("id") == 0)) & (F.col("n") >= least)).isEmpty():
            return seed
        seed += 1


def _scored(levels: list[DataFrame], vocabulary: DataFrame) -> DataFrame:
    """(lang, w1..w4, a, l, r, score) of the phrases that no longer one takes in."""
    scored = []
    for width in range(2, LONGEST + 1):
        rows = levels[width - 1]
        rows = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("bigint").alias(c) for c in _IDS], "a")
        cuts = []
        for k in range(1, width):
            sides = []
            for side, first, last in (("l", 0, k), ("r", k, width)):
                name = f"{side}{k}"
                table = levels[last - first - 1].withColumnRenamed("a", name)
                rows = _salted(rows, table, _IDS[first:last], _IDS[: last - first], name)
                sides.append(F.col(name))
            total = (sides[0] + sides[1]).cast("decimal(38,0)")
            score = F.call_function("div", F.col("a").cast("decimal(20,0)") * F.lit(2000000).cast("decimal(7,0)"), total)
            cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), sides[0].alias("l"), sides[1].alias("r")))
        best = F.array_min(F.array(*cuts))
        scored.append(rows.select(*_IDS, "a", best["l"].alias("l"), best["r"].alias("r"), best["score"].alias("score")))
    rows = scored[0]
    for more in scored[1:]:
        rows = rows.unionByName(more)
    inside = _inside(levels)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _IDS]
    match = same[0] & same[1] & same[2] & same[3]
    left = rows.join(inside.hint("merge"), match, "left").where(
        F.col("most").isNull() | (F.col("most").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * 80)
    )
    return _salted(left.select(*_IDS, "a", "l", "r", "score"), vocabulary, ["w1"], ["w1"], "lang")


def _inside(levels: list[DataFrame]) -> DataFrame:
    """(_w1.._w4, most): the count of the most frequent longer phrase around each phrase."""
    found = None
    for width in range(3, LONGEST + 1):
        for size in range(2, width):
            for first in range(width - size + 1):
                ids = [
                    (F.col(_IDS[first + i]) if i < size else F.lit(None).cast("bigint")).alias(f"_{c}")
                    for i, c in enumerate(_IDS)
                ]
                rows = levels[width - 1].select(*ids, "a")
                found = rows if found is None else found.unionByName(rows)
    return found.groupBy(*[f"_{c}" for c in _IDS]).agg(F.max("a").alias("most"))


def _ranked(rows: DataFrame, vocabulary: DataFrame, counts: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language, with their words.  Words are fetched for rows that
    score and count leave in the race only."""
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    race = rows.withColumn("place", F.rank().over(by)).where(F.col("place") <= top).drop("place")
    race = stage(race.withColumn("key", F.monotonically_increasing_id()), "race")
    spelt = (
        race.select("key", F.posexplode(F.array(*_IDS)).alias("pos", "id"))
        .join(vocabulary.select(F.col("w1").alias("id"), "word"), "id")
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("words"))
        .select("key", F.array_join(F.col("words.word"), " ").alias("phrase"))
    )
    sums = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        race.join(spelt, "key")
        .withColumn("rank", F.row_number().over(last).cast("bigint"))
        .where(F.col("rank") <= top)
        .join(sums, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
