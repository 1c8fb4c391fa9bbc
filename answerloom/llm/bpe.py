"""Byte-level BPE by recursive SQL: DuckDB contracts token-position rows per task."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.llm.frames import fresh
from answerloom.sources.staging import small_batches

#: Bytes of different words that one recursive query contracts together.
WORD_BYTES = 200_000
#: Rows that one recursive query may pile up; longer words go through several queries.
PILE = 2_000_000
#: Different words that a worker remembers; the longest unused go and are computed anew.
REMEMBERED = 400_000
#: Tokens that one query decodes together.
DECODE_TOKENS = 250_000

# Each round pairs every token with its right neighbour, joins the merge table, takes the
# leftmost of each word's pairs of lowest rank and contracts it: the left row gets the
# merged token, the right row goes.  A word without a pair is done.  Ranks are the ids.
_CONTRACT = """
with recursive state as (
  select 0::int as turn, false as done, word, pos, id from source
  union all
  (with pairs as materialized (
     select turn, word, pos, id, last_pos, merged
     from (
       select turn, word, pos, id, lead(id) over here as next_id,
              lead(word) over here as next_word, lag(pos) over here as last_pos
       from state where not done and turn < $turns window here as (order by pos)
     ) left join merges on id = left_id and next_id = right_id and next_word = word
   ), best as materialized (
     select word, min(merged::bigint << 32 | pos) as chosen
     from pairs where merged is not null group by word
   )
   select turn + 1, chosen is null, p.word, pos,
          case when pos = (chosen & 4294967295) then (chosen >> 32)::int else id end
   from pairs p left join best b on p.word = b.word
   where chosen is null or last_pos is distinct from (chosen & 4294967295))
)
select word, pos, id, done from state where done or turn = $turns order by pos
"""

_DECODE = """
select doc, string_agg(piece, '' order by pos) as bytes
from source join vocabulary using (id) group by doc
"""


def parse_ranks(blob: bytes) -> dict[bytes, int]:
    """Ranks of a file of lines ``base64 rank``."""
    return {
        base64.b64decode(token): int(rank)
        for token, rank in (line.split() for line in blob.splitlines() if line)
    }


class Codec:
    """Merge table, vocabulary and remembered words of one worker process."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.find = regex.compile(pattern).findall
        self.ranks = ranks
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.sql = duckdb.connect()
        self.sql.execute("set threads = 1")
        self.made: set[str] = set()

    def _merges(self) -> None:
        ranks = self.ranks
        splits = [
            (ranks[t[:i]], ranks[t[i:]], r)
            for t, r in ranks.items()
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        ]
        left, right, rank = (np.array(x, dtype=np.int32) for x in zip(*splits, strict=True))
        self._table("merges", left_id=left, right_id=right, merged=rank)

    def _vocabulary(self) -> None:
        # bytes as the characters of the same numbers, so that they aggregate as text
        self._table(
            "vocabulary",
            id=np.array(list(self.ranks.values()), dtype=np.int32),
            piece=[t.decode("latin-1") for t in self.ranks],
        )

    def _table(self, name: str, **columns) -> None:
        self.sql.register("given", pa.table(columns))
        self.sql.execute(f"create table {name} as select * from given")
        self.sql.unregister("given")
        self.made.add(name)

    def _query(self, query: str, **columns) -> pa.Table:
        self.sql.register("source", pa.table(columns))
        found = self.sql.sql(query).to_arrow_table()
        self.sql.unregister("source")
        return found

    def _learn(self, words: list[str]) -> None:
        """Encode words that are not remembered."""
        if "merges" not in self.made:
            self._merges()
        todo = []
        for w in words:
            b = w.encode()
            if b in self.ranks:
                self.words[w] = np.uint32(self.ranks[b]).tobytes()
            else:
                todo.append((w, b))
        todo.sort(key=lambda x: len(x[1]))
        first = 0
        while first < len(todo):
            last, size = first, 0
            while last < len(todo) and (last == first or size + len(todo[last][1]) <= WORD_BYTES):
                size += len(todo[last][1])
                last += 1
            self._contract(todo[first:last])
            first = last

    def _contract(self, batch: list[tuple[str, bytes]]) -> None:
        lengths = np.array([len(b) for _, b in batch])
        ids = self.byte_ids[np.frombuffer(b"".join(b for _, b in batch), dtype=np.uint8)]
        word = np.repeat(np.arange(len(batch)), lengths)
        while len(word):
            turns = max(8, PILE // len(word))
            got = self._query(
                _CONTRACT.replace("$turns", str(turns)),
                word=word.astype(np.int32), pos=np.arange(len(word), dtype=np.int32), id=ids
            )
            word, ids, done = (got[c].to_numpy() for c in ("word", "id", "done"))
            own = word[done]
            data = ids[done].astype("<u4")
            starts = np.flatnonzero(np.diff(own, prepend=-1))
            ends = np.append(starts[1:], len(own))[: len(starts)]
            for a, b in zip(starts, ends, strict=True):
                self.words[batch[own[a]][0]] = data[a:b].tobytes()
            word, ids = word[~done], ids[~done]

    def encode(self, texts: list[str]) -> list[bytes]:
        found = [self.find(t) for t in texts]
        used = {w for words in found for w in words}
        if len(self.words) + len(used) > REMEMBERED // 2:
            self.words, self.older = {}, self.words
        unknown = []
        for w in used - self.words.keys():
            if w in self.older:
                self.words[w] = self.older[w]
            else:
                unknown.append(w)
        self._learn(unknown)
        get = self.words.__getitem__
        return [b"".join(map(get, words)) for words in found]

    def decode(self, packed: list[bytes]) -> list[bytes]:
        if "vocabulary" not in self.made:
            self._vocabulary()
        out = [b""] * len(packed)
        first = 0
        while first < len(packed):
            last, size = first, 0
            while last < len(packed) and (last == first or size + len(packed[last]) <= 4 * DECODE_TOKENS):
                size += len(packed[last])
                last += 1
            ids = np.frombuffer(b"".join(packed[first:last]), dtype="<u4").astype(np.int32)
            if len(ids):
                counts = [len(p) // 4 for p in packed[first:last]]
                got = self._query(
                    _DECODE,
                    doc=np.repeat(np.arange(first, last, dtype=np.int32), counts),
                    pos=np.arange(len(ids), dtype=np.int32),
                    id=ids,
                )
                for doc, text in zip(got["doc"].to_pylist(), got["bytes"].to_pylist(), strict=True):
                    out[doc] = text.encode("latin-1")
            first = last
        return out


_CODECS: dict[tuple[bytes, str], Codec] = {}


def codec(blob: bytes, pattern: str) -> Codec:
    """The worker's codec for a rank file; built once a process."""
    key = (blob, pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(parse_ranks(blob), pattern)
    return _CODECS[key]


def _groups(texts: Iterable, limit: int = 1_000_000) -> Iterator[list]:
    """Parts of a batch of about ``limit`` characters or bytes."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > limit:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def encoder(blob: bytes, pattern: str):
    """Column -> Column: token ids of a text as little-endian unsigned 32-bit integers.

    ``blob`` is the content of the rank file, ``pattern`` splits the text first; each
    match is encoded by itself, a match that is a token gives that token.  Null is
    empty text.  No special tokens.  Texts and words may have any length.
    """

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(blob, pattern)
        for texts in batches:
            for part in _groups(texts.fillna("")):
                yield pd.Series(own.encode(part), dtype=object)

    return encode


def decoder(blob: bytes, pattern: str):
    """Column -> Column: bytes of packed token ids; null gives no bytes."""

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(blob, pattern)
        for ids in batches:
            for part in _groups(x if x is not None else b"" for x in ids):
                yield pd.Series(own.decode(part), dtype=object)

    return decode


def coder(blob: bytes, pattern: str):
    """Column -> Column: struct of a text's packed token ids, as of ``encoder``, and the ``decoded`` bytes
    of these ids.  One worker process does both, where the two functions above take one each."""

    @F.pandas_udf("ids binary, decoded binary")
    def code(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(blob, pattern)
        for texts in batches:
            for part in _groups(texts.fillna("")):
                ids = own.encode(part)
                yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series(own.decode(ids), dtype=object)})

    return code


def encode_texts(docs: DataFrame, blob: bytes, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with its texts' packed token ids as last column, ``token_ids``.

    A name that is taken gets a leading underscore.
    """
    (ids,) = fresh(docs, "token_ids")
    return small_batches(docs).withColumn(ids, encoder(blob, pattern)(F.col(text).cast("string")))


def decode_ids(docs: DataFrame, blob: bytes, pattern: str, ids: str = "token_ids") -> DataFrame:
    """``docs`` with the bytes of its packed token ids as last column, ``decoded``.

    A name that is taken gets a leading underscore.
    """
    (out,) = fresh(docs, "decoded")
    return small_batches(docs).withColumn(out, decoder(blob, pattern)(F.col(ids)))


def round_trip(docs: DataFrame, blob: bytes, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with the packed token ids of its texts, ``token_ids``, and what they decode to, ``decoded``.

    The same as ``decode_ids`` over ``encode_texts`` with half the worker processes.
    Names that are taken get a leading underscore.
    """
    ids, out, both = fresh(docs, "token_ids", "decoded", "both")
    coded = small_batches(docs).withColumn(both, coder(blob, pattern)(F.col(text).cast("string")))
    return coded.withColumns({ids: F.col(f"{both}.ids"), out: F.col(f"{both}.decoded")}).drop(both)


def token_count(ids: str) -> Column:
    return (F.octet_length(ids) / 4).cast("bigint")
