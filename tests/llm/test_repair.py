"""Repair against dynamic programming over whole scripts, and the damage against zlib."""

import hashlib
import itertools
import random
import zlib

import pytest
from answerloom.llm.repair import damaged, repair_conversations, search, summarise

TURNS = "conv_id bigint, turn bigint, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def faults(rows):
    """First fault of each (role, text) in order."""
    out, seen = [], set()
    for role, text in rows:
        end = text.rstrip(BLANK)
        if not end:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if end[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, turns) by keeping the best whole script of every prefix and state."""
    after = {"": "user", "s": "user", "u": "assistant", "a": "user"}
    best = {"": (0, "", ())}

    def offer(table, state, script):
        if state not in table or script[:2] < table[state][:2]:
            table[state] = script

    def with_inserts(table):
        for _ in range(3):
            for state, (c, audit, turns) in list(table.items()):
                role = after[state]
                offer(table, role[0], (c + 3, audit + "I", (*turns, (role, ""))))
        return table

    for (role, text), fault in zip(rows, faults(rows), strict=True):
        new = {}
        for state, (c, audit, turns) in with_inserts(best).items():
            offer(new, state, (c + 4, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault else 0
            offer(new, after[state][0], (c + 3 + extra, audit + "R", (*turns, (after[state], text))))
            if role[:1] == after[state][0] or role[:1] == "s" and state == "":
                offer(new, role[:1], (c + extra, audit + "K", (*turns, (role, text))))
        best = new
    ends = [v for k, v in with_inserts(best).items() if k in ("", "a")]
    return min(ends)


def expected(rows):
    """Every column of the summary for (turn, role, text) rows in order."""
    said = [(r, t) for _, r, t in rows]
    kinds = faults(said)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[0][:1] + b[0][:1] for a, b in itertools.pairwise(said)]
    cost, audit, out = cheapest(said)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        "blank": kinds.count("blank"), "duplicate": kinds.count("duplicate"), "truncated": kinds.count("truncated"),
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
        "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    }


def random_rows(rng, n):
    texts = ["Yes.", "No!", "cut", " ", "", "why?", "ends here.\t", "né."]
    return [
        (i * 2 if rng.random() < 0.1 else i, rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]),
         rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}.")
        for i in range(n)
    ]


def got(spark, rows, schema=TURNS):
    out = summarise(repair_conversations(spark.createDataFrame(rows, schema)))
    return {r["conv"]: {k: v for k, v in r.asDict().items() if k != "conv"} for r in out.collect()}


def test_search_is_cheapest_and_least():
    """Every way through every script of three tokens, by all edits with two insertions at most."""
    kinds = {"u": "user", "a": "assistant", "s": "system", "x": "tool"}
    for tokens in itertools.product("uasxUd", repeat=3):
        rows = [(kinds.get(t.lower(), "user"), "" if t == "d" else f"t{i}" + ("" if t.isupper() else ".")) for i, t in enumerate(tokens)]
        cost, audit, _ = cheapest(rows)
        ends = []
        for state, tail in ((0, ""), (1, "II"), (2, "I"), (3, "")):
            found = search("".join(tokens), 0, state)
            if found:
                ends.append((found[0] + 3 * len(tail), found[1] + tail))
        assert min(ends) == (cost, audit), tokens


def test_random_conversations(spark):
    rng = random.Random(5)
    cases = {i: random_rows(rng, rng.choice([1, 2, 5, 8, 31, 32, 33, 70, 150])) for i in range(60)}
    rows = [(i, *r) for i, c in cases.items() for r in c]
    rng.shuffle(rows)
    found = got(spark, rows)
    for i, case in cases.items():
        ordered = sorted(case, key=lambda r: r[0])
        if len({r[0] for r in ordered}) == len(ordered):
            assert found[i] == expected(ordered), i
    assert found.keys() == cases.keys()


def test_long_clean_conversation(spark):
    rows = [(7, i, ["user", "assistant"][i % 2], f"turn {i}.") for i in range(2000)]
    found = got(spark, rows)[7]
    assert (found["cost"], found["audit"]) == (0, "K" * 2000)
    assert found == expected([r[1:] for r in rows])


def test_edge_cases(spark):
    rows = [
        (1, None, "user", "a."), (1, None, None, "b."), (1, 3, "assistant", None),  # nulls
        (2, 0, "user", "x."), (2, 0, "user", "x."), (2, 1, "assistant", "y."),  # repeated rows
        (None, 0, "assistant", "z"), (None, 4, "user", "w" * 100_000 + "."),  # null id, long text
        (3, 0, "", "empty role."),
    ]
    found = got(spark, rows)
    assert found.keys() == {1, 2, 3, None}
    assert found[2] == expected([(0, "user", "x."), (0, "user", "x."), (1, "assistant", "y.")])
    assert found[2]["audit"] == "KDK"
    assert found[None] == expected([(0, "assistant", "z"), (4, "user", "w" * 100_000 + ".")])
    assert (found[1]["gaps"], found[1]["blank"]) == (0, 1)
    assert (found[3]["audit"], found[3]["cost"]) == ("D", 4)
    empty = spark.createDataFrame([], TURNS)
    assert summarise(repair_conversations(empty)).collect() == []


def test_damage_and_absent(spark):
    rng = random.Random(9)
    rows = [(c, t, ["user", "assistant"][t % 2], f"said {c} {t}. Well?") for c in range(80) for t in range(rng.choice([1, 1, 4]))]
    rows += [(None, 0, None, None), (5000, None, "user", "x")]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], f"{TURNS}, code string, copy int")
    want = {}
    for c, t, role, text in rows:
        role, text = role or " ", " " if text is None else text
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        kind = zlib.crc32(key.encode()) % 20
        mine = want.setdefault(c, [])
        if kind == 4:
            role = "user"
        if kind in (1, 2):
            text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?"))
        mine += [(t, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    found = {r["conv"]: r.asDict() for r in summarise(repair_conversations(damaged(df), absent="absent")).collect()}
    assert found.keys() == want.keys()
    gone = [c for c, mine in want.items() if not mine]
    assert gone
    for c, mine in want.items():
        assert {k: v for k, v in found[c].items() if k != "conv"} == expected(sorted(mine, key=lambda r: (r[0] is not None, r[0] or 0)))
    assert found[gone[0]]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_pieces_hold_the_edited_turns(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "a."), (1, 1, "user", "b."), (1, 2, "user", " ")], TURNS)
    (piece,) = repair_conversations(df).collect()
    assert [(e["edit"], e["role"], e["text"]) for e in piece["edits"]] == [
        ("I", "user", ""), ("K", "assistant", "a."), ("K", "user", "b."), ("D", "user", " "), ("I", "assistant", ""),
    ]
    assert piece["cost"] == 10


@pytest.mark.parametrize("roles", ["uu", "aa", "ss", "sa", "us"])
def test_short(spark, roles):
    names = {"u": "user", "a": "assistant", "s": "system"}
    rows = [(i, names[r], f"text {i}.") for i, r in enumerate(roles)]
    assert got(spark, [(1, *r) for r in rows])[1] == expected(rows)
