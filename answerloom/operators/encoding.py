"""Integer-encoded training examples: word vocabulary, ids, masks, padded batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerloom.functions.text import tokenize_ws
from answerloom.names import ID
from answerloom.operators.sampling import shuffle_rows
from answerloom.operators.scoring import score_pairs
from answerloom.sources.staging import stage

PAD = 0  # id of padding
UNKNOWN = 1  # id of words outside the vocabulary
IGNORED = -100  # label value the loss skips
MAX_INPUT, MAX_TARGET = 256, 512
_CODED = 500  # rows whose words are looked up at a time
HEAD_WORDS = 1 << 15  # most frequent words, which go to every task


#: Words of so few occurrences are many; they are ranked in hash buckets.
_RARE = 16


def word_vocabulary(texts: DataFrame, column: str, size: int | None = None) -> DataFrame:
    """(word, word_id) of all words, or of the ``size`` most frequent ones; ids from 2.

    Frequent words come first; ties in word order, but for words of at most ``_RARE``
    occurrences, which tie in the order of their md5.  Ranks inside a bucket of equal
    counts (and leading hash digits) are shifted by the words of all earlier buckets.
    There are at most 4,096 buckets for each small count and one for each other count.
    """
    digest = F.when(F.col("n") <= _RARE, F.md5(F.col("word").cast("binary"))).otherwise("")
    words = (
        texts.select(F.explode(tokenize_ws(F.col(column))).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .withColumn("hash", digest)
        .withColumn("bucket", F.substring("hash", 1, 3))
    )
    earlier = Window.partitionBy(F.lit(1)).orderBy(F.desc("n"), "bucket")
    starts = (
        words.groupBy("n", "bucket")
        .agg(F.count("*").alias("k"))
        .select("n", "bucket", (F.sum("k").over(earlier) - F.col("k")).alias("start"))
    )
    inside = Window.partitionBy("n", "bucket").orderBy("hash", "word")
    rank = F.col("start") + F.row_number().over(inside)
    ranked = words.join(starts, ["n", "bucket"]).select(
        "word", (rank + UNKNOWN).cast("int").alias("word_id")
    )
    return ranked if size is None else ranked.where(F.col("word_id") <= size + UNKNOWN)


def encode_examples(
    pairs: DataFrame,
    vocabulary: DataFrame,
    max_input: int = MAX_INPUT,
    max_target: int = MAX_TARGET,
    head: int = HEAD_WORDS,
) -> DataFrame:
    """(ID, input_ids, attention_mask, labels) from (ID, prompt, answer) with unique ``ID``.

    The length limits are those of the encoding itself.  The ``head`` first words of the
    vocabulary go to every task and give most ids where the row is.  The others
    are looked up by a join, once for each row and word, and put into their places by number:
    no row of tokens moves, and no common word is a join key.
    """
    first = vocabulary.where(F.col("word_id") <= head + UNKNOWN).select("word", "word_id").toArrow()
    words = pairs.select(
        ID,
        tokenize_ws(F.col("prompt"), max_input).alias("i"),
        tokenize_ws(F.col("answer"), max_target).alias("t"),
    )
    kind = f"`{ID}` {pairs.schema[ID].dataType.simpleString()}, i array<int>, t array<int>, rare array<string>"
    coded = stage(words.mapInArrow(_code_head(first.column("word"), first.column("word_id")), kind), "head-ids")
    missing = coded.select(ID, F.posexplode("rare").alias("place", "word"))
    rest = vocabulary.where(F.col("word_id") > head + UNKNOWN)
    found = (
        missing.join(rest, "word", "left")
        .groupBy(ID)
        .agg(F.array_sort(F.collect_list(F.struct("place", F.coalesce("word_id", F.lit(UNKNOWN)).alias("id")))).alias("ids"))
        .select(ID, F.col("ids.id").alias("ids"))
    )

    def whole(side: str) -> Column:
        return F.transform(side, lambda x: F.when(x < 0, F.get("ids", -1 - x)).otherwise(x))

    return coded.join(found, ID, "left").select(
        ID,
        whole("i").alias("input_ids"),
        F.transform("i", lambda _x: F.lit(1)).alias("attention_mask"),
        label_mask(whole("t")).alias("labels"),
    )


def _code_head(known: pa.ChunkedArray, ids: pa.ChunkedArray):
    """Ids of known words; the others of a row are listed once, and -1, -2, ... point to them."""
    known, ids = known.combine_chunks(), ids.combine_chunks().to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, _CODED) for b in batches for at in range(0, b.num_rows, _CODED)):
            n = batch.num_rows
            sides = [batch.column("i"), batch.column("t")]
            words = pa.concat_arrays([s.flatten() for s in sides])
            row = np.concatenate([np.repeat(np.arange(n), np.diff(s.offsets.to_numpy())) for s in sides])
            at = pc.index_in(words, known)
            code = np.where(pc.is_valid(at).to_numpy(False), ids[pc.fill_null(at, 0).to_numpy()] if len(ids) else 0, 0)
            code = code.astype(np.int64)
            unknown = np.flatnonzero(code == 0)
            texts = words.take(pa.array(unknown)).dictionary_encode()
            pair = row[unknown] * (len(texts.dictionary) + 1) + texts.indices.to_numpy()
            distinct, back = np.unique(pair, return_inverse=True)
            owner, which = np.divmod(distinct, len(texts.dictionary) + 1)
            starts = np.searchsorted(owner, np.arange(n + 1))
            code[unknown] = -1 - (back - starts[row[unknown]])
            cut = len(sides[0].flatten())
            lists = [
                pa.ListArray.from_arrays(pa.array(_offsets(s), pa.int32()), pa.array(part, pa.int32()))
                for s, part in zip(sides, (code[:cut], code[cut:]), strict=True)
            ]
            rare = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), texts.dictionary.take(pa.array(which)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists, rare], [batch.schema.names[0], "i", "t", "rare"])

    return run


def _offsets(lists: pa.ListArray) -> np.ndarray:
    offsets = lists.offsets.to_numpy()
    return offsets - offsets[0]


def _spell(first: pa.ChunkedArray, first_ids: pa.ChunkedArray, n: int) -> Callable[..., Column]:
    """Function of ``n`` id arrays and of the other words that a row has fetched, sorted by id: a struct
    of the arrays' words, joined by blanks.  The first words of the vocabulary are in every task."""
    first, first_ids = first.combine_chunks(), first_ids.combine_chunks().to_numpy().astype("int64")
    few, missing = _CODED, -1

    def sizes(lists: pa.ListArray) -> np.ndarray:
        return pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype("int64")

    def key(row: np.ndarray, ids: np.ndarray) -> np.ndarray:
        # the first words are those of row -1, so that one sorted array serves all
        return ((row + 1) << 32) + ids

    def words(lists: pa.Array, known: pa.Array) -> pa.Array:
        rare = known.flatten()
        spelt = pa.concat_arrays([first, rare.field("word")])
        own = np.repeat(np.arange(len(known)), sizes(known))
        keys = np.append(key(np.int64(-1), first_ids), key(own, rare.field("word_id").to_numpy().astype("int64")))
        row, found = np.repeat(np.arange(len(lists)), sizes(lists)), lists.flatten()
        ids = pc.fill_null(found, 0).to_numpy().astype("int64")
        place = np.full(len(ids), missing)
        for wanted in (key(row, ids), key(np.int64(-1), ids)):
            at = np.searchsorted(keys, wanted, side="right") - 1  # the last of equal keys
            hit = (place == missing) & (at >= 0)
            hit[hit] = keys[at[hit]] == wanted[hit]
            place[hit] = at[hit]
        good = (place != missing) & pc.is_valid(found).to_numpy(False)
        ends = np.append(0, np.cumsum(np.bincount(row[good], minlength=len(lists)))).astype("int32")
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), spelt.take(pa.array(place[good]))), " ")

    def spell(*columns: pa.Array) -> pa.Array:
        starts = range(0, len(columns[0]), few)
        parts = [[words(c.slice(at, few), columns[-1].slice(at, few)) for at in starts] for c in columns[:-1]]
        texts = [pa.concat_arrays(x) if x else pa.array([], pa.string()) for x in parts]
        return pa.StructArray.from_arrays(texts, [f"c{i}" for i in range(n)])

    return F.arrow_udf(spell, ", ".join(f"c{i} string" for i in range(n)))


def decode_ids(
    encoded: DataFrame, vocabulary: DataFrame, columns: str | Mapping[str, str], out: str = "text", head: int = HEAD_WORDS
) -> DataFrame:
    """Add the words of id arrays, joined by blanks; ids without a word are left out.

    ``columns`` is one id array, decoded to ``out``, or a mapping of id arrays to new names.  The ``head``
    first words of the vocabulary go to every task; each row fetches any other word once, however
    often its arrays have it.  ``ID`` must be unique.
    """
    names = {columns: out} if isinstance(columns, str) else dict(columns)
    common = F.col("word_id").between(UNKNOWN + 1, head + UNKNOWN)
    first = vocabulary.where(common).select("word", F.col("word_id").cast("int")).orderBy("word_id", "word").toArrow()
    empty = F.array().cast("array<int>")
    ids = F.array_distinct(F.concat(*[F.coalesce(c, empty) for c in names]))
    rare = encoded.select(ID, F.explode(F.filter(ids, lambda x: ~x.between(UNKNOWN + 1, head + UNKNOWN))).alias("word_id"))
    known = (
        rare.join(vocabulary.where(~common), "word_id")
        .groupBy(ID)
        .agg(F.array_sort(F.collect_list(F.struct(F.col("word_id").cast("int").alias("word_id"), "word"))).alias("_known"))
    )
    spell = _spell(first.column("word"), first.column("word_id"), len(names))
    spelt = encoded.join(known, ID, "left").withColumn("_known", spell(*[F.col(c) for c in names], F.col("_known")))
    # a row without ID fetches no word
    made = [F.when(F.col(ID).isNull(), "").otherwise(F.col(f"_known.c{i}")) for i in range(len(names))]
    return spelt.withColumns(dict(zip(names.values(), made, strict=True))).drop("_known")


def score_ids(
    encoded: DataFrame,
    vocabulary: DataFrame,
    predictions: str = "predictions",
    labels: str = "labels",
    score: Callable[[DataFrame, str, str], DataFrame] = score_pairs,
) -> DataFrame:
    """Scores of predicted ids against masked labels: unmask, decode, score.

    ``score`` gets the table and the names of both text columns.
    """
    plain = encoded.withColumns(
        {"_p": prediction_unmask(F.col(predictions)), "_r": label_unmask(F.col(labels))}
    )
    spelt = decode_ids(stage(plain, "unmasked-ids"), vocabulary, {"_p": "prediction", "_r": "reference"})
    return score(spelt.drop("_p", "_r"), "prediction", "reference")


def label_mask(ids: Column, pad: int = PAD) -> Column:
    """Padding ids become the ignored label."""
    return F.transform(ids, lambda x: F.when(x == pad, F.lit(IGNORED)).otherwise(x))


def label_unmask(labels: Column, pad: int = PAD) -> Column:
    """Ignored labels back to padding, then padding dropped, as before decoding."""
    restored = F.transform(labels, lambda x: F.when(x == IGNORED, F.lit(pad)).otherwise(x))
    return F.filter(restored, lambda x: x != pad)


def prediction_unmask(ids: Column, pad: int = PAD) -> Column:
    """Any negative predicted id counts as padding; padding is dropped."""
    restored = F.transform(ids, lambda x: F.when(x < 0, F.lit(pad)).otherwise(x))
    return F.filter(restored, lambda x: x != pad)


def _padded(ids: Column, width: Column, fill: int) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(fill), width - F.size(ids)))


def pad_batches(
    encoded: DataFrame, batch_size: int = 4, multiple: int = 8, seed: int = 42
) -> DataFrame:
    """Seeded batches of ``batch_size`` rows, padded to their longest member.

    Widths are rounded up to ``multiple``. The batch number comes from the
    distributed permutation, never from a global sort.
    """
    placed = shuffle_rows(encoded, seed).withColumn(
        "batch", F.floor((F.col("position") - 1) / batch_size).cast("long")
    )
    batch = Window.partitionBy("batch")

    def width(c: str) -> Column:
        longest = F.max(F.size(c)).over(batch)
        return (F.ceil(longest / multiple) * multiple).cast("int")

    return (
        placed.withColumns({"iw": width("input_ids"), "lw": width("labels")})
        .select(
            "batch",
            ID,
            _padded(F.col("input_ids"), F.col("iw"), PAD).alias("input_ids"),
            _padded(F.col("attention_mask"), F.col("iw"), 0).alias("attention_mask"),
            _padded(F.col("labels"), F.col("lw"), IGNORED).alias("labels"),
        )
    )
