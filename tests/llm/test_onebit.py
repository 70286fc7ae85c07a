"""One-bit codes: against a plain search, with copies, ties, nulls and small blocks."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from opsledger.llm import onebit
from opsledger.llm.ship import ship
from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<double>, q long, list int, score string, label int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def frame(spark, rows):
    """Rows with (vec_id, vector); the other columns clash with names used inside."""
    return spark.createDataFrame([(i, v, 1, 2, "s", 3) for i, v in rows], SCHEMA)


def plain_search(rows, every=100, k=10):
    fine = {
        (i, tuple(float(x) + 0.0 for x in v)) for i, v in rows
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    out = []
    for i, v in sorted((r for r in fine if r[0] is not None and r[0] % every == 0)):
        found = []
        for j, w in fine:
            if j != i:
                total = 0.0
                for t in range(max(len(v), len(w))):
                    d = (w[t] if t < len(w) else 0.0) - (v[t] if t < len(v) else 0.0)
                    total += d * d
                found.append((math.sqrt(total), j is not None, j or 0, j))
        found.sort()
        out += [(i, r + 1, j, score) for r, (score, _, _, j) in enumerate(found[:k])]
    return sorted(out, key=str)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    near = rng.standard_normal((30, 5)).tolist()
    rows = [(i, v) for i, v in enumerate(near, 1)] + [(100, near[3]), (200, [1.0]), (300, [2.0, -0.0, 0.0])]
    rows += [(400, None), (500, []), (600, [0.0, -0.0]), (700, [1.0, None]), (800, [math.nan, 1.0]), (900, [math.inf])]
    rows += [(None, near[0]), (None, near[3]), (None, [2.0]), (100, near[5]), (100, near[5]), (40, near[3]), (41, near[3])]
    rows += [(1000 + i, [2.0, 0.0]) for i in range(25)] + [(1100, [2.0])]
    assert collected(onebit.search(frame(spark, rows))) == plain_search(rows)


def test_empty_table_and_few_candidates(spark):
    assert onebit.search(frame(spark, [])).count() == 0
    assert onebit.search(frame(spark, [(100, [1.0, 2.0])])).count() == 0
    few = [(100, [1.0, 2.0]), (101, [1.0, 5.0]), (200, [3.0, 2.0])]
    assert collected(onebit.search(frame(spark, few))) == plain_search(few)


def test_large_values_do_not_break(spark):
    rows = [(100, [1e200, 0.0]), (101, [-1e200, 1.0]), (102, [1e200, 5.0]), (103, [1.0, 1.0])]
    found = onebit.search(frame(spark, rows)).collect()
    assert [(r["rank"], r["vec_id"]) for r in found] == [(1, 102), (2, 101), (3, 103)]


@pytest.mark.parametrize("block", [7, 64])
def test_many_lists_and_blocks_with_a_hot_vector(spark, monkeypatch, block):
    monkeypatch.setattr(onebit, "ROWS_PER_LIST", 20)
    monkeypatch.setattr(onebit, "BLOCK", block)
    monkeypatch.setattr(onebit, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 16)) * 4
    rows = [(i, (centres[i % 6] + rng.standard_normal(16)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)]
    found = onebit.search(frame(spark, rows), F.col("id") % 20 == 0)
    assert collected(found) == plain_search(rows, 20)


def test_bounds_hold_and_skip_most_rows():
    rng = np.random.default_rng(4)
    x, queries = rng.standard_normal((2000, 64)), rng.standard_normal((50, 64))
    index = onebit.Index(x, 1, 64)
    codes, size, own = index.encode(x, np.zeros(len(x), int))
    assert codes.shape == (2000, 8)
    guess, least = index.bounds(codes, size, own, index.centres[0], queries, onebit.SIGMAS)
    true = ((queries[:, None] - x) ** 2).sum(2)
    assert (least > true).mean() < 0.005
    assert np.abs(guess - true).mean() < 0.15 * true.mean()
    limit = np.partition(true, 9, axis=1)[:, 9:10]
    assert (least <= limit).mean() < 0.5


def test_recall_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.1"
    table = pq.read_table(f"{sf}/embeddings.parquet").to_pydict()
    x = np.array(table["embedding"], float)
    ids = np.array(table["vec_id"])
    found = contract.queries()["op11_neighbours"](spark, sf).collect()
    hits = 0
    for q in ids[ids % 100 == 0]:
        far = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        order = [int(i) for i in ids[np.lexsort((ids, far))] if i != q][:10]
        own = sorted((r["rank"], r["vec_id"]) for r in found if r["query_id"] == q)
        assert [r for r, _ in own] == list(range(1, 11))
        hits += len({v for _, v in own} & set(order))
    assert hits >= 0.9 * len(found) and len(found) == 10 * (ids % 100 == 0).sum()


def test_a_table_of_floats(spark):
    found = contract.queries()["op11_neighbours"](spark, SF).collect()
    assert found and all(r["score"] >= 0 for r in found)
