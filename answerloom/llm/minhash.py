"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from answerloom.llm.frames import text_of, whole_row
from answerloom.llm.groups import connect, only_possible
from answerloom.sources.staging import small_batches, stage

WORDS = 5
SIMILARITY = 0.8
#: A pair at SIMILARITY shares a band with probability 1 - (1 - 0.8**ROWS)**BANDS = 0.9998.
BANDS, ROWS = 16, 4
#: Document frequencies are counted by shingle hash in so many cells.
CELLS = 1 << 18
#: Shingles that are sampled together, so that arrays stay in cache.
_CHUNK = 1 << 15
#: Cells of a text's shingles whose weights bound what two texts have in common.
SPOTS = 64
_U = np.uint64


def word_hashes(text: Column) -> Column:
    """xxhash64 of the lower-case letter and digit runs, filled up to one shingle.

    No word gives no hash.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    short = (F.size(hashes) > 0) & (F.size(hashes) < WORDS)
    fill = F.array_repeat(F.lit(0).cast("bigint"), F.when(short, WORDS - F.size(hashes)).otherwise(0))
    return F.concat(hashes, fill)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixer (splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, times) of each row's different shingles, ordered by row.

    ``hashes`` holds the words of all rows one after the other.
    """
    n = len(hashes)
    row = np.repeat(np.arange(len(lengths)), lengths)
    if n < WORDS:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty.astype(np.uint64), empty
    words = hashes.view(np.uint64)
    value = np.zeros(n - WORDS + 1, dtype=np.uint64)
    for k in range(WORDS):
        value = _mix(value * _U(0x9E3779B97F4A7C15) + words[k : n - WORDS + 1 + k])
    whole = row[: n - WORDS + 1] == row[WORDS - 1 :]
    row, value = row[: n - WORDS + 1][whole], value[whole]
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    first = np.ones(len(row), dtype=bool)
    first[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    starts = np.flatnonzero(first)
    times = np.diff(np.append(starts, len(row)))
    return row[starts], value[starts], times


def cells(shingle: np.ndarray) -> np.ndarray:
    return (shingle >> _U(40)).astype(np.int64) % CELLS


def damped_idf(frequency: np.ndarray, documents: int) -> np.ndarray:
    """Between 2 (in no other document) and 1 (in all): rare shingles count more, yet copies of
    a text that has many stay copies."""
    return 1.0 + np.log((documents + 1.0) / (np.minimum(frequency, documents) + 1.0)) / math.log(
        documents + 2.0
    )


def _tables(seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Draws of Gamma(2, 1) and of the logarithm of Gamma(2, 1)."""
    rng = np.random.default_rng(seed)
    return rng.gamma(2.0, 1.0, 1 << 16), np.log(rng.gamma(2.0, 1.0, 1 << 16))


_GAMMA, _LOG_GAMMA = _tables()


def signatures(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """``k`` consistent weighted samples for each run of equal ``row``.

    For each shingle S and sample: t = floor(ln w / r + b), ln a = ln c - r (t - b + 1) with
    r, c ~ Gamma(2, 1) and b ~ U(0, 1) drawn from a hash of S.  The least ln a of a row depends
    on its shingle and t alone, so it stands for the sample.
    """
    starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    log_weight = np.log(weight)
    out = np.empty((len(starts), k))
    for i in range(k):
        z = _mix(shingle + _U((0x9E3779B97F4A7C15 * (i + 1)) & (2**64 - 1)))
        r = _GAMMA[(z & _U(0xFFFF)).astype(np.intp)]
        log_c = _LOG_GAMMA[((z >> _U(16)) & _U(0xFFFF)).astype(np.intp)]
        b = (z >> _U(32)).astype(np.float64) * 2.0**-32
        t = np.floor(log_weight / r + b)
        out[:, i] = np.minimum.reduceat(log_c - r * (t - b + 1.0), starts)
    return out


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, lengths) of an Arrow list column."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return np.ascontiguousarray(values, dtype=np.int64), np.diff(offsets)


def _parts(values: np.ndarray, lengths: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Runs of rows of about ``size`` words; a longer row is a run of its own."""
    ends = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield first, last, values[base : ends[last - 1]]
        first = last


def _count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CELLS, dtype=np.int64)
    for batch in batches:
        values, lengths = _lists(batch.column("words"))
        for first, last, part in _parts(values, lengths, 1 << 17):
            row, shingle, _ = shingles(part, lengths[first:last])
            if len(row):
                # a document counts once for a cell
                pair = np.unique(row * CELLS + cells(shingle))
                total += np.bincount(pair % CELLS, minlength=CELLS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["cell", "n"])


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents for each cell, over all rows of ``docs`` (words), and their number."""
    counted = docs.mapInArrow(_count_cells, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    found = counted.toPandas()  # at most CELLS rows
    out = np.zeros(CELLS, dtype=np.int64)
    out[found["cell"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    return out, docs.count()


def _bands(idf: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            values, lengths = _lists(batch.column("words"))
            for first, last, part in _parts(values, lengths, _CHUNK):
                row, shingle, times = shingles(part, lengths[first:last])
                if not len(row):
                    continue
                samples = signatures(row, shingle, times * idf[cells(shingle)], BANDS * ROWS)
                bits = samples.view(np.uint64).reshape(len(samples), BANDS, ROWS)
                key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bits.shape[:2])
                for i in range(ROWS):
                    key = _mix(key * _U(0x9E3779B97F4A7C15) + bits[:, :, i])
                own = nodes[first:last][row[np.append(True, row[1:] != row[:-1])]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(own, BANDS))],
                    ["bucket", "node"],
                )

    return run


def weighted_jaccard(a: tuple, b: tuple, idf: np.ndarray, n: int) -> np.ndarray:
    """Similarity of row ``i`` of ``a`` and row ``i`` of ``b``, both (row, shingle, times)."""
    row = np.concatenate([a[0], b[0]])
    shingle = np.concatenate([a[1], b[1]])
    weight = np.concatenate([a[2], b[2]]) * idf[cells(shingle)]
    order = np.lexsort((shingle, row))
    row, shingle, weight = row[order], shingle[order], weight[order]
    same = np.zeros(len(row), dtype=bool)
    same[1:] = (row[1:] == row[:-1]) & (shingle[1:] == shingle[:-1])
    at = np.flatnonzero(same)
    total = np.bincount(row, weights=weight, minlength=n)
    common = np.bincount(row[at], weights=np.minimum(weight[at], weight[at - 1]), minlength=n)
    return common / np.maximum(total - common, 1e-300)


def _distances(idf: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a few pairs at a time bound the memory of long texts
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sides = [_lists(part.column(c)) for c in ("wa", "wb")]
                found = weighted_jaccard(*[shingles(v, n) for v, n in sides], idf, part.num_rows)
                yield part.select(["a", "b"]).append_column("far", pa.array(1.0 - found))

    return run


def _parts_of(idf: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            values, lengths = _lists(batch.column("words"))
            for first, last, part in _parts(values, lengths, _CHUNK):
                row, shingle, times = shingles(part, lengths[first:last])
                columns = [nodes[first:last][row], shingle.view(np.int64), times * idf[cells(shingle)]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "shingle", "weight"])

    return run


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """(doc_id, node, class_id, class_size): one row for each row of ``docs``.

    Two texts are linked if they are equal, or if the weighted Jaccard similarity of their
    shingles of five words is at least ``similarity`` and they share a band.  Words are
    runs of letters and digits in lower case; a shingle weighs its count in the text times its
    damped inverse document frequency; a text of one to four words is one shingle.  A class is a
    connected group, its id the smallest doc_id in it (a null id counts last).  ``node`` is the
    64-bit hash of the text.  Texts without a word are linked only to equal texts; null and
    empty texts are never linked, their class is their own doc_id.
    """
    body = text_of(text)
    node = F.xxhash64(body, F.lit(23))
    source = small_batches(docs).select(
        F.col(doc_id).cast("bigint").alias("doc_id"), node.alias("node"), body.alias("body")
    )
    worded = source.select("node", word_hashes(F.col("body")).alias("words"))
    frequency, documents = document_frequencies(worded.select("words"))
    idf = damped_idf(frequency, documents)
    members = stage(
        worded.mapInArrow(_bands(idf), "bucket bigint, node bigint").distinct(), "bands"
    )

    def texts_of(nodes: DataFrame) -> DataFrame:
        found = (
            only_possible(source.select("node", "body"), "node", nodes)
            .join(nodes, "node")  # a semi-join would go below the filter
            .groupBy("node")
            .agg(F.first("body").alias("body"))
        )
        return stage(found, "near-texts")

    def weights(nodes: DataFrame) -> DataFrame:
        """(node, total, own, spots): weight of all shingles, of those that no other node has, and
        of the others by cell."""
        worded = texts_of(nodes).select("node", word_hashes(F.col("body")).alias("words"))
        parts = stage(worded.mapInArrow(_parts_of(idf), "node bigint, shingle bigint, weight double"), "near-shingles")
        alone = parts.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"))
        alone = stage(alone.where("n = 1").select("shingle", "node"), "own-shingles")
        spot = F.pmod("shingle", F.lit(SPOTS)).cast("int")
        cells_of = (
            parts.join(alone.withColumn("single", F.lit(True)), ["shingle", "node"], "left")
            .groupBy("node", F.when(F.col("single"), -1).otherwise(spot).alias("spot"))
            .agg(F.sum("weight").alias("weight"))
            .groupBy("node")
            .agg(F.sum("weight").alias("total"), F.map_from_entries(F.collect_list(F.struct("spot", "weight"))).alias("of"))
        )
        at = F.sequence(F.lit(0), F.lit(SPOTS - 1))
        return cells_of.select(
            "node",
            "total",
            F.coalesce(F.col("of")[-1], F.lit(0.0)).alias("own"),
            F.transform(at, lambda i: F.coalesce(F.try_element_at("of", i), F.lit(0.0))).alias("spots"),
        )

    def distances(pairs: DataFrame) -> DataFrame:
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        texts = texts_of(stage(nodes, "near-nodes"))
        x, y = (texts.select(F.col("node").alias(k), F.col("body").alias(f"t{k}")) for k in "ab")
        return (
            pairs.join(x, "a")
            .join(y, "b")
            .select("a", "b", word_hashes(F.col("ta")).alias("wa"), word_hashes(F.col("tb")).alias("wb"))
            .mapInArrow(_distances(idf), "a bigint, b bigint, far double")
        )

    # one less the weighted Jaccard similarity is a metric
    labels = stage(connect(members, distances, 1.0 - similarity + 1e-9, weights), "near-labels")
    empty = F.octet_length("body") == 0
    rows = stage(source.select("doc_id", "node", empty.alias("empty")), "near-rows")
    known = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    sizes = (
        known.where(~F.col("empty"))
        .groupBy("label")
        .agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
        .where("class_size > 1")
    )
    alone = F.col("empty") | F.col("class_size").isNull()
    return known.join(sizes, "label", "left").select(
        "doc_id",
        "node",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, 1).otherwise(F.col("class_size")).cast("bigint").alias("class_size"),
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` less near-duplicates: of each class the row with the smallest id stays.

    Of rows that repeat both id and text one stays; rows without text all stay.
    """
    classes = near_duplicates(docs, doc_id, text, **options)
    first = (
        classes.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
        .groupBy("doc_id", "node")
        .agg(F.lit(1).alias("stays"))
    )
    ident = F.col(doc_id).cast("bigint")
    body = text_of(text)
    packed = docs.select(
        ident.alias("doc_id"),
        F.xxhash64(body, F.lit(23)).alias("node"),
        (F.octet_length(body) == 0).alias("empty"),
        whole_row(docs).alias("row"),
    )
    again = Window.partitionBy("node", "doc_id").orderBy(F.xxhash64("row"))
    chosen = packed.alias("p").join(
        first.alias("f"),
        (F.col("p.node") == F.col("f.node")) & F.col("p.doc_id").eqNullSafe(F.col("f.doc_id")),
        "left_semi",
    )
    numbered = chosen.withColumn("n", F.row_number().over(again))
    return numbered.where((F.col("n") == 1) | F.col("empty")).select("row.*")
