"""Periodic runs: the suffix array against a search of every period, and odd rows."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as contract
from opsledger.llm import runs
from opsledger.llm.ship import ship
from tests.conftest import SF


def plain_runs(words):
    """Every period in turn: stretches of words that equal the word one period on."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((start, length, q) for (start, length), q in found.items())


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def collected(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_several_texts_together_equal_every_period():
    rng = random.Random(5)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 4)):
            text = [rng.randrange(rng.choice([1, 2, 3, 20])) for _ in range(rng.randint(0, 60))]
            if text and rng.random() < 0.6:
                a, p = rng.randrange(len(text)), rng.randint(1, 12)
                text[a:] = [text[a + i % min(p, len(text) - a)] for i in range(len(text) - a)]
            texts.append(text)
        sizes = [len(t) for t in texts]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.array([w for t in texts for w in t], np.int64)
        found = runs.find_runs(flat, np.repeat(offsets[:-1], sizes))
        expected = [(o + s, n, q) for t, o in zip(texts, offsets.tolist()) for s, n, q in plain_runs(t)]
        assert [tuple(r) for r in found.tolist()] == sorted(expected, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("period", [1, 2, 700, 20_000])
def test_long_periodic_text(period):
    words = np.random.default_rng(0).permutation(100_000)[np.arange(100_000) % period]
    assert runs.find_runs(words, np.zeros(len(words), np.int64)).tolist() == [[0, 100_000, period]]


def test_odd_rows(spark):
    ship(spark)
    looped_id = next(i for i in range(100, 1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    cycle = "a b\tc\n" * 9
    rows = [
        (1, None), (2, ""), (3, " \n\x0b"), (4, "x " * 6), (5, "x " * 5), (None, "a b c d e f g h i j"), (None, None),
        (6, cycle), (6, cycle), (6, "é " * 7 + cycle), (looped_id, "w1 w2 w3 w4 w5 w6 w7 w8 w9"), (looped_id, ""),
        (7, "z " + "p q " * 300 + "p p p p p p p"), (8, " ".join(map(str, range(2_000)))), (9, "A a " * 3),
    ]
    frame = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, runs string, start long, period int")
    assert collected(runs.digests(frame)) == sorted((plain_row(i, t) for i, t in rows), key=str)
    assert runs.digests(frame.limit(0)).count() == 0
    own = {tuple(r["runs"][0]) for r in runs.runs_of(frame.filter("doc_id = 6")).collect()}
    assert own == {(0, 27, 3), (0, 7, 1)}


def test_small_parts_give_the_same(spark, monkeypatch):
    rows = [(i, "a b " * (i % 7) + "c") for i in range(60)]
    monkeypatch.setattr(runs, "BATCH_WORDS", 5)
    monkeypatch.setattr(runs, "BATCH_BYTES", 40)
    batch = spark.createDataFrame(rows, "doc_id long, text string").toArrow().to_batches()
    texts = [t for _, part in runs._parts(batch) for t in part]
    assert texts == [t.encode().split() for _, t in rows]


def test_query_equals_every_period(spark):
    documents = pd.read_parquet(f"{SF}/documents.parquet")
    expected = [plain_row(i, t) for i, t in zip(documents.doc_id, documents.text)]
    found = collected(contract.queries()["op13_runs"](spark, SF))
    assert found == sorted(expected, key=str)
    assert sum(r[1] > 0 for r in found) > 5
