"""Conversation structure repair: the cheapest edit script by iterative-deepening A*.

A legal conversation is empty, or an optional system turn and then user and assistant in turn.
The automaton of that language has four states: nothing yet, after the system turn, after a
user, after an assistant.  Conversations of any length are cut into segments of ``SEGMENT``
turns.  For each way from a state before a segment to a state behind it the search gives the
cheapest edits, the least in ASCII order among equals; a forward pass over the segments
then chains them.  So neither a task nor the search ever holds a whole long conversation.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerloom.sources.staging import stage

#: Turns that are searched at once.
SEGMENT = 32
#: Turns of a window of the lower bound.
WINDOW = 4
#: Costs of an edit, and of a truncated turn that is not deleted.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: White space in the sense of faults.
BLANKS = " \t\n\x0b\x0c\r"

_NEVER = 1 << 60
#: The role that comes next after a state, and the state behind it.
_NEXT = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
#: States that end a conversation, and what must be inserted from the others.
_TAIL = {0: 0, 1: 2, 2: 1, 3: 0}


def _kept(kind: str, state: int) -> int | None:
    """The state behind a turn that is kept, None where it cannot stand."""
    if kind == "s":
        return 1 if state == 0 else None
    if kind == "u":
        return 2 if state != 2 else None
    return 3 if kind == "a" and state == 2 else None


@lru_cache(maxsize=1 << 16)
def _moves(token: str, state: int) -> tuple[tuple[str, int, int, int], ...]:
    """(letter, cost, turns passed, state) in ASCII order of the letters.

    A token is the role's initial (x: any other), upper case if truncated; d must go.
    """
    out = [("D", DELETE, 1, state), ("I", INSERT, 0, _NEXT[state][1])]
    if token != "d":
        extra = TRUNCATED if token.isupper() else 0
        to = _kept(token.lower(), state)
        if to is not None:
            out.append(("K", extra, 1, to))
        out.append(("R", REROLE + extra, 1, _NEXT[state][1]))
    return tuple(out)


@lru_cache(maxsize=1 << 16)
def _window_cost(tokens: str) -> int:
    """The least cost of passing these turns from any state to any state."""
    costs = dict.fromkeys(range(4), 0)
    for token in tokens:
        for _ in range(2):  # insertions before the turn
            for state in range(4):
                to = _NEXT[state][1]
                costs[to] = min(costs.get(to, _NEVER), costs.get(state, _NEVER) + INSERT)
        after: dict[int, int] = {}
        for state, cost in costs.items():
            for _, price, passed, to in _moves(token, state):
                if passed:
                    after[to] = min(after.get(to, _NEVER), cost + price)
        costs = after
    return min(costs.values())


def _bounds(tokens: str) -> list[int]:
    """For each position a cost that the turns from there on need at least: windows add up,
    as each starts in the state that suits it best."""
    n = len(tokens)
    out = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        out[i] = _window_cost(tokens[i : i + WINDOW]) + out[min(n, i + WINDOW)]
    return out


@lru_cache(maxsize=1 << 14)
def search(tokens: str, entry: int, exit_: int) -> tuple[int, str] | None:
    """(cost, letters) of the cheapest, then ASCII-least edits from state to state.

    Iterative deepening: a depth-first search in ASCII order that gives up beyond a cost; the
    next cost is the least that was cut off.  ``needs`` remembers for failed states what
    they proved to need at least, so no state is searched again with too little.  Insertions
    stand before a turn, never behind the last one.
    """
    if exit_ < entry and exit_ < 2 or not tokens and entry != exit_:
        return None  # no way back to the start
    if exit_ == 1 and entry == 0 and not set(tokens) & {"s", "S"}:
        return None
    n, bounds = len(tokens), _bounds(tokens)
    needs: dict[tuple[int, int], int] = {}
    letters: list[str] = []

    def need(i: int, state: int) -> int:
        if i == n:
            return 0 if state == exit_ else _NEVER
        if exit_ < 2 and state > exit_:
            return _NEVER
        return needs.get((i, state), bounds[i])

    def accepts(i: int, state: int, left: int) -> bool:
        if i == n:
            return state == exit_
        least = _NEVER
        for letter, cost, passed, to in _moves(tokens[i], state):
            rest = need(i + passed, to)
            if cost + rest <= left:
                if accepts(i + passed, to, left - cost):
                    letters.append(letter)
                    return True
                rest = need(i + passed, to)
            least = min(least, cost + rest)
        needs[i, state] = least
        return False

    limit = need(0, entry)
    while not accepts(0, entry, limit):
        limit = need(0, entry)
    return limit, "".join(reversed(letters))


def _replay(tokens: str, roles: list, texts: list, entry: int, letters: str, tail: int) -> list[dict]:
    """The edits of a segment with the turns that they give; a deleted turn keeps its text."""
    out, i, state = [], 0, entry
    for letter in letters + "I" * tail:
        role, to = _NEXT[state]
        text = ""
        if letter != "I":
            text = texts[i]
            if letter in "KD":
                role = roles[i]
            if letter == "D":
                to = state
            elif letter == "K":
                to = _kept(tokens[i].lower(), state)
            i += 1
        out.append({"edit": letter, "role": role, "text": text})
        state = to
    return out


_SEGMENT = T.StructType(
    [T.StructField("part", T.IntegerType()), T.StructField("piece", T.LongType())]
    + [T.StructField(n, T.ArrayType(T.StringType())) for n in ("roles", "texts", "letters")]
    + [T.StructField("costs", T.ArrayType(T.LongType())), T.StructField("tokens", T.StringType())]
    + [T.StructField(n, T.LongType()) for n in ("blank", "duplicate", "truncated", "illegal", "turns")]
    + [T.StructField(n, T.LongType()) for n in ("first_turn", "last_turn")]
    + [T.StructField(n, T.StringType()) for n in ("first_role", "last_role")]
)
_STATS = _SEGMENT.names[_SEGMENT.names.index("blank") :]


def _follows(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


def _segment(conv, rows: list[tuple], entries: tuple, part: int, piece: int) -> dict:
    """One segment: its turns, its statistics and the edits for all its ways."""
    turns = [r[0] for r in rows if r[0] is not None]
    initials = [r[1][:1] for r in rows]
    faults = [r[3] for r in rows]
    tokens = "".join(
        "d" if fault in (1, 2) else (k if k and k in "sua" else "x").upper() if fault == 3 else k if k and k in "sua" else "x"
        for k, fault in zip(initials, faults, strict=True)
    )
    ways = [search(tokens, e, x) if e in entries else None for e in range(4) for x in range(4)]
    return {
        "conv": conv, "part": part, "piece": piece,
        "roles": [r[1] for r in rows], "texts": [r[2] for r in rows],
        "letters": [w and w[1] for w in ways], "costs": [w and w[0] for w in ways], "tokens": tokens,
        "blank": faults.count(1), "duplicate": faults.count(2), "truncated": faults.count(3),
        "illegal": sum(not _follows(a, b) for a, b in zip(initials, initials[1:], strict=False)),
        "turns": len(set(turns)),
        "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
        "first_role": initials[0] if rows else None, "last_role": initials[-1] if rows else None,
    }


def _tables(records: Iterator[dict], schema: pa.Schema, weigh) -> Iterator[pa.RecordBatch]:
    """Batches of records, cut where their texts get large."""
    held, weight = [], 0
    for r in records:
        held.append(r)
        weight += weigh(r)
        if weight > 1 << 22 or len(held) >= 2048:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _cut(schema: pa.Schema):
    """Turns in order -> segments.  Only the first conversation of a partition may have
    begun in the one before, so only its segments, and those after a first one, need more ways
    than from the start."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part, piece = TaskContext.get().partitionId(), 0
        conv, rows, entries = None, None, (0, 1, 2, 3)
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(6)], strict=True):
                new = rows is not None and row[0] != conv
                if new or rows is not None and len(rows) == SEGMENT:
                    yield _segment(conv, rows, entries, part, piece)
                    piece += 1
                    rows, entries = [], (0,) if new else (0, 1, 2, 3)
                conv, rows = row[0], [] if rows is None else rows
                if not row[5]:
                    rows.append(row[1:5])
        if rows is not None:
            yield _segment(conv, rows, entries, part, piece)

    return lambda batches: _tables(segments(batches), schema, lambda r: sum(map(len, r["texts"])))


def _chain(schema: pa.Schema):
    """Segments of each conversation in order -> the way that is taken through each.

    Held for a conversation are 20 bytes a segment.  Scripts of different states never are
    prefixes of each other, so the rank of the earlier letters settles ties.
    """

    def choose(conv, places: array, back: bytearray, best: dict) -> Iterator[dict]:
        state = min(best, key=lambda q: (best[q][0] + INSERT * _TAIL[q], best[q][1]))
        tail, ways = _TAIL[state], []
        for k in range(len(back) // 4 - 1, -1, -1):
            before = back[4 * k + state]
            ways.append((before, state))
            state = before
        for k, (entry, exit_) in enumerate(reversed(ways)):
            last = k == len(ways) - 1
            yield {"part": places[2 * k], "piece": places[2 * k + 1], "entry": entry, "leave": exit_, "tail": tail if last else 0}

    def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        conv, places, back, best = None, None, None, None
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                if places is None or row[0] != conv:
                    if places is not None:
                        yield from choose(conv, places, back, best)
                    conv, places, back, best = row[0], array("q"), bytearray(), {0: (0, 0)}
                places.extend(row[1:3])
                found: dict[int, tuple] = {}
                for e, (cost, rank) in best.items():
                    for x in range(4):
                        price, letters = row[3][4 * e + x], row[4][4 * e + x]
                        if price is not None:
                            found.setdefault(x, []).append((cost + price, rank, letters, e))
                picked = {x: min(options) for x, options in found.items()}
                order = sorted(picked, key=lambda x: picked[x][1:3])
                back.extend(picked[x][3] if x in picked else 0 for x in range(4))
                best = {x: (picked[x][0], order.index(x)) for x in picked}
        if places is not None:
            yield from choose(conv, places, back, best)

    return lambda batches: _tables(ways(batches), schema, lambda r: 1)


def _apply(schema: pa.Schema):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for r in batch.to_pylist():
                way = 4 * r["entry"] + r["leave"]
                edits = _replay(r["tokens"], r["roles"], r["texts"], r["entry"], r["letters"][way], r["tail"])
                yield {k: r[k] for k in ("conv", "part", "piece", *_STATS)} | {
                    "cost": r["costs"][way] + INSERT * r["tail"], "edits": edits
                }

    return lambda batches: _tables(pieces(batches), schema, lambda r: sum(len(e["text"]) for e in r["edits"]))


def _typed(conv: T.DataType, fields: list[T.StructField]) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    full = T.StructType([T.StructField("conv", conv), *fields])
    return full, to_arrow_schema(full)


def repair_conversations(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    absent: str | None = None,
) -> DataFrame:
    """Pieces of repaired conversations, in order of (conv, part, piece).

    A piece has ``edits``, an array of (edit, role, text): K keeps a turn, R gives it the other
    role, I inserts an empty one, D (with the turn as it was) deletes it.  Further: the cost, the
    numbers of ``blank``, ``duplicate`` and ``truncated`` turns by their first fault, ``illegal``
    neighbours and what the ends of a piece need to be joined to the next.  Blank and
    duplicate turns are always deleted.  Turns are taken by ``turn`` (nulls first), equal ones
    by the digest of role and text.  A null role or text is one space, an empty role is none of the
    legal ones, null ids are one conversation.  Rows marked ``absent`` are no turns; they only
    make sure that their conversation is returned.  Other columns are not read.
    """
    gone = F.col(absent) if absent else F.lit(False)
    said = F.when(gone, F.lit("")).otherwise(F.coalesce(F.col(text).cast("string"), F.lit(" ")))
    by = F.when(gone, F.lit("")).otherwise(F.coalesce(F.col(role).cast("string"), F.lit(" ")))
    slim = rows.select(
        F.col(conv_id).alias("conv"),
        F.when(~gone, F.col(turn).cast("bigint")).alias("turn"),
        by.alias("role"),
        said.alias("text"),
        gone.alias("gone"),
    ).withColumn("tie", F.md5(F.concat_ws("\n", F.length("role").cast("string"), "role", "text").cast("binary")))
    again = Window.partitionBy("conv", "gone", "tie").orderBy(F.asc_nulls_first("turn"))
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (
        F.when(end == "", 1)
        .when(F.col("nth") > 1, 2)
        .when(~F.right(end, F.lit(1)).isin(".", "!", "?"), 3)
        .otherwise(0)
    )
    judged = stage(
        slim.withColumn("nth", F.row_number().over(again)).withColumn("fault", fault), "judged-turns"
    )
    order = [F.asc_nulls_first(c) for c in ("conv", "turn", "tie", "nth")]
    dealt = judged.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = judged.schema["conv"].dataType
    full, arrow = _typed(kind, _SEGMENT.fields)
    parts = stage(
        dealt.select("conv", "turn", "role", "text", "fault", "gone").mapInArrow(_cut(arrow), full),
        "segments",
    )
    way = [T.StructField(n, t()) for n, t in (("part", T.IntegerType), ("piece", T.LongType), ("entry", T.IntegerType), ("leave", T.IntegerType), ("tail", T.IntegerType))]
    _, arrow = _typed(kind, way)
    slim = parts.select("conv", "part", "piece", "costs", "letters")
    ways = (
        slim.repartition("conv")
        .sortWithinPartitions("conv", "part", "piece")
        .mapInArrow(_chain(arrow.remove(0)), T.StructType(way))
    )
    edit = T.StructType([T.StructField(n, T.StringType()) for n in ("edit", "role", "text")])
    out = [f for f in _SEGMENT.fields if f.name in ("part", "piece", *_STATS)]
    out += [T.StructField("cost", T.LongType()), T.StructField("edits", T.ArrayType(edit))]
    full, arrow = _typed(kind, out)
    return parts.join(ways, ["part", "piece"]).mapInArrow(_apply(arrow), full)


_SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _summary(schema: pa.Schema):
    """Pieces in order -> one row a conversation; texts go into the digest one by one."""

    def close(conv, s: dict) -> dict:
        span = 0 if s["first"] is None else s["last"] - s["first"] + 1 - s["turns"]
        return {"conv": conv, "gaps": span, **{k: s[k] for k in _SUMMARY[1:]},
                "audit": "".join(s["audit"]), "repaired_sha256": s["hash"].hexdigest()}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        conv, s = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if s is None or r["conv"] != conv:
                    if s is not None:
                        yield close(conv, s)
                    conv = r["conv"]
                    s = dict.fromkeys(_SUMMARY, 0) | {"first": None, "last": None, "turns": 0, "role": None}
                    s |= {"audit": [], "hash": hashlib.sha256(), "some": False}
                for k in _SUMMARY[1:]:
                    s[k] += r[k]
                if r["first_turn"] is not None:
                    s["turns"] += r["turns"] - (s["last"] == r["first_turn"])
                    s["first"] = r["first_turn"] if s["first"] is None else s["first"]
                    s["last"] = r["last_turn"]
                if r["first_role"] is not None:
                    s["illegal"] += s["role"] is not None and not _follows(s["role"], r["first_role"])
                    s["role"] = r["last_role"]
                for e in r["edits"]:
                    s["audit"].append(e["edit"])
                    if e["edit"] != "D":
                        s["hash"].update((("\n" if s["some"] else "") + f"{e['role']}:{e['text']}").encode())
                        s["some"] = True
        if s is not None:
            yield close(conv, s)

    return lambda batches: _tables(rows(batches), schema, lambda r: len(r["audit"]))


def summarise(pieces: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each
    conversation of :func:`repair_conversations`.

    A digest of a whole conversation has to see its turns one after the other, so the pieces of
    one conversation pass through one task; they are streamed, never gathered.
    """
    fields = [T.StructField(n, T.LongType()) for n in _SUMMARY]
    fields += [T.StructField(n, T.StringType()) for n in ("audit", "repaired_sha256")]
    full, arrow = _typed(pieces.schema["conv"].dataType, fields)
    return (
        pieces.repartition("conv")
        .sortWithinPartitions("conv", "part", "piece")
        .mapInArrow(_summary(arrow), full)
    )


def damaged(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, turn, role, text, absent): turns with faults that the CRC-32 of their key decides.

    Of 20 values 0 marks a turn as absent, 1 empties its text, 2 takes its ends of sentences, 3
    repeats it, 4 makes it the user's.  A null is one space, also in the key.
    """

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    code = F.pmod(F.crc32(F.concat(plain(conv_id), F.lit(":"), plain(turn)).cast("binary")), F.lit(20))
    said = (
        F.when(code == 1, F.lit(""))
        .when(code == 2, F.translate(plain(text), ".!?", ""))
        .otherwise(plain(text))
    )
    return rows.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.when(code == 4, F.lit("user")).otherwise(plain(role)).alias("role"),
        said.alias("text"),
        (code == 0).alias("absent"),
        F.explode(F.array_repeat(F.lit(0), F.when(code == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
