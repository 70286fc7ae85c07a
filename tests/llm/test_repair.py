"""Conversation repair: the auction against a plain dynamic program, whole and in chunks."""

import hashlib
import random
import re
import zlib

import pandas as pd
import pytest
import xxhash

import __spark_entry__ as contract
from opsledger.llm import repair
from opsledger.llm.ship import ship

SCHEMA = "conv_id long, turn long, role string, text string, `group` string, fault int, tie string"
AFTER = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
FILL = [("user", 2), ("user", 2), ("assistant", 3), ("user", 2)]


def cheapest(signature):
    """Forward over the rows: for each state the least (cost, letters)."""

    def with_inserts(best):
        for _ in range(3):
            for state, (cost, letters) in list(best.items()):
                best[FILL[state][1]] = min(best.get(FILL[state][1], (10**9, "")), (cost + 3, letters + "I"))
        return best

    best = with_inserts({0: (0, "")})
    for sign in signature:
        ahead = {}
        for state, (cost, letters) in best.items():
            steps = [(state, 4, "D")]
            if sign != "x":
                extra = 3 * sign.isupper()
                steps.append((FILL[state][1], 3 + extra, "R"))
                if sign.lower() in AFTER[state]:
                    steps.append((AFTER[state][sign.lower()], extra, "K"))
            for to, more, letter in steps:
                ahead[to] = min(ahead.get(to, (10**9, "")), (cost + more, letters + letter))
        best = with_inserts(ahead)
    return min(best[s] for s in (0, 3) if s in best)


def tie(role, text):
    mark = xxhash.xxh64_intdigest(text.encode(), xxhash.xxh64_intdigest(role.encode(), 42))
    return mark - (1 << 64) * (mark >> 63)


def plain_repair(conv, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1], r[2])))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        words = text.strip(" \t\n\x0b\x0c\r")
        fault = "b" if not words else "d" if (role, text) in seen else "." if words[-1] in ".!?" else "t"
        seen.add((role, text))
        faults.append(fault)
    signs = []
    for (_, role, _), fault in zip(rows, faults):
        initial = role[:1] if role[:1] and role[0] in "sua" else "o"
        signs.append("x" if fault in "bd" else initial.upper() if fault == "t" else initial)
    cost, audit = cheapest(signs)
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    lines, state, left = [], 0, list(rows)
    for letter in audit:
        _, role, text = left.pop(0) if letter != "I" else (None, "", "")
        if letter == "K":
            state = AFTER[state][role[0]]
        elif letter != "D":
            role, state = FILL[state]
        if letter != "D":
            lines.append(f"{role}:{text}")
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (conv, gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, sha)


def plain_digests(rows):
    by = {}
    for conv, turn, role, text in rows:
        kept = by.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        mark = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if mark == 1 else re.sub("[.!?]", "", text) if mark == 2 else text
        kept += [(turn, "user" if mark == 4 else role, text)] * {0: 0, 3: 2}.get(mark, 1)
    return sorted((plain_repair(c, r) for c, r in by.items()), key=str)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_auction_equals_dynamic_program():
    rng = random.Random(7)
    for i in range(1500):
        letters = rng.choice(["uasoUASOx", "uaUAx", "uauauauasx", "uuaaUAo"])
        signature = "".join(rng.choices(letters, k=rng.randint(0, 12) if i < 1400 else rng.randint(50, 150)))
        assert repair.solve(signature) == cheapest(signature)


def test_chunks_compose():
    rng = random.Random(8)
    for _ in range(150):
        whole = "".join(rng.choices("uasoUASOx", k=rng.randint(3, 60)))
        cuts = [0, *sorted(rng.sample(range(1, len(whole)), 2)), len(whole)]
        parts = [whole[a:b] for a, b in zip(cuts, cuts[1:])] + ["$"]
        after, exits = [0.0] * 4, []
        for part in reversed(parts):
            exits.insert(0, after)
            table = repair.passage(part)
            after = [min(c + a for c, a in zip(table[s], after)) for s in range(4)]
        state, letters = 0, ""
        for part, costs in zip(parts, exits):
            piece, state = repair.pieces(part, costs)[state]
            letters += piece
        assert (after[0], letters) == cheapest(whole)


def random_rows(rng):
    texts = ["Yes.", "no", "", " \t", "Why?!", "é.\n", "a b. ", None, "x" * 50_000]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "umpire"]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.choice([1, 3, 8, 30])):
            fresh = f"turn {rng.randrange(40)}."
            role = rng.choice(roles[:4]) if rng.random() < 0.7 else rng.choice(roles)
            row = (conv, rng.choice([turn, turn, turn + 3, None]), role, fresh if rng.random() < 0.7 else rng.choice(texts))
            rows += [row] * rng.choice([1, 1, 1, 2])
    return rows


@pytest.mark.parametrize("long_rows,long_bytes", [(4096, 1 << 26), (5, 1 << 26), (4096, 60_000), (0, 0)])
def test_odd_rows_whole_and_split(spark, monkeypatch, long_rows, long_bytes):
    ship(spark)
    monkeypatch.setattr(repair, "CHUNK", 4)
    rows = random_rows(random.Random(9))
    frame = spark.createDataFrame([(*r, "g", 1, "t") for r in rows], SCHEMA)
    found = repair.repair(repair.damaged(frame), False, long_rows, long_bytes)
    assert collected(found) == plain_digests(rows)


def test_repaired_texts_and_empty_table(spark):
    ship(spark)
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi"), (1, 2, "assistant", "Well.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for bound in (10, 1):
        (row,) = repair.repair(frame, long_rows=bound).collect()
        assert (row["audit"], row["cost"]) == ("IKKK", 6)
        assert [tuple(r) for r in row["repaired"]] == [("user", ""), *((r[2], r[3]) for r in rows)]
    assert repair.digests(frame.limit(0)).count() == 0


def test_a_dropped_conversation_stays(spark):
    ship(spark)
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 0, "user", "Hi.")] * 3, "conv_id long, turn long, role string, text string")
    empty = hashlib.sha256(b"").hexdigest()
    assert collected(repair.digests(frame)) == [(gone, 0, 0, 0, 0, 0, 0, "", empty)]


def test_query_equals_plain_version(spark):
    sf = "/root/testdata/sf0.01"
    table = pd.read_parquet(f"{sf}/conversations.parquet").astype(object)
    rows = list(table[["conv_id", "turn", "role", "text"]].itertuples(index=False, name=None))
    assert collected(contract.queries()["op12_repair"](spark, sf)) == plain_digests(rows)
