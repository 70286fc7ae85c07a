"""Exact top-k search by inner product, by aggregation without random access.

Vectors become integers (floor of ``SCALE`` times a component). Candidates lie in
blocks, and queries in blocks; each pair of blocks is one group of a
Spark job. In a block every dimension is a sorted list. All lists are read from the end
that helps the query, to a depth that doubles. What has been read bounds
each score from below and above: an unread component lies between the list's far
end and the place that reading has come to. Reading stops for a query when few
candidates can still reach its k-th lower bound; their scores are then resolved. The
bounds of all queries of a block are computed together as matrix products.

Vectors that are null or hold null or non-finite components take no part. Missing
components of shorter vectors count 0. A query's own row is each row with its id;
rows with null ids are candidates, never queries. Repeated queries count once. Ties
go to the smaller id, null first. With fewer than k candidates all are returned; an
empty table gives no rows. Other columns are ignored. Scores beyond the range of a
long stop at its ends.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K = 5
SCALE = 256
BLOCK = 1024
QUERY_BLOCK = 512
_FEW = 4


def finite(vector: Column) -> Column:
    """True for vectors without null and non-finite components."""
    fine = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    return F.coalesce(fine, F.lit(False))


def search(
    vectors: DataFrame,
    queries: Column | None = None,
    k: int = K,
    key: str = "vec_id",
    vector: str = "embedding",
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k best rows for each query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    ``queries`` says which rows are queries; by default those whose id 50 divides.
    """
    is_query = (F.col("id") % 50 == 0) if queries is None else queries
    numbers = F.transform(
        vector, lambda x: F.floor(x.cast("double") * float(SCALE)).cast("long")
    )
    rows = vectors.filter(finite(F.col(vector))).select(F.col(key).alias("id"), numbers.alias("x"))
    wanted = F.col("id").isNotNull() & F.coalesce(is_query, F.lit(False))
    asked = rows.filter(wanted).distinct()
    sizes = rows.agg(F.count("*").alias("n"), F.count_if(wanted).alias("q")).first()
    blocks = max(1, -(-sizes["n"] // block))
    query_blocks = max(1, -(-sizes["q"] // query_block))
    place = F.xxhash64("id", "x")
    left = rows.select(
        F.pmod(place, F.lit(blocks)).cast("int").alias("cb"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"),
        "id", "x",
    )
    right = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("cb"),
        F.pmod(F.shiftright(place, 20), F.lit(query_blocks)).cast("int").alias("qb"),
        "id", "x",
    )

    def run(candidates: pa.Table, wanted: pa.Table) -> pa.Table:
        found = {"query": [], "place": [], "id": [], "score": []}
        if candidates.num_rows and wanted.num_rows:
            ids, qids = candidates.column("id").to_pylist(), wanted.column("id").to_pylist()
            x, q = _matrices(candidates.column("x"), wanted.column("x"))
            marks = [xxhash.xxh3_64_intdigest(row.tobytes()) >> 1 for row in q]
            for i, best in enumerate(best_in_block(x, ids, q, qids, k)):
                for j, score in best:
                    found["query"].append(qids[i])
                    found["place"].append(marks[i])
                    found["id"].append(ids[j])
                    found["score"].append(score)
        return pa.table(
            [pa.array(v, pa.int64()) for v in found.values()], list(found)
        )

    local = (
        left.groupBy("cb", "qb")
        .cogroup(right.groupBy("cb", "qb"))
        .applyInArrow(run, "query long, place long, id long, score long")
    )
    order = Window.partitionBy("query", "place").orderBy(F.col("score").desc(), F.col("id").asc_nulls_first())
    ranked = local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(
        F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"
    )


def _matrices(*columns: pa.ChunkedArray) -> list[np.ndarray]:
    """Integer matrices of equal width, filled with zeros on the right."""
    lists = [column.combine_chunks() for column in columns]
    lists = [c if isinstance(c, pa.ListArray) else pa.concat_arrays(c.chunks) for c in lists]
    sizes = [np.diff(c.offsets.to_numpy()) for c in lists]
    width = max([1, *(int(s.max()) for s in sizes if len(s))])
    out = []
    for column, size in zip(lists, sizes):
        table = np.zeros((len(column), width), np.int64)
        table[np.arange(width) < size[:, None]] = column.flatten().to_numpy()
        out.append(table)
    return out


def best_in_block(x: np.ndarray, ids: list, q: np.ndarray, qids: list, k: int) -> list[list[tuple]]:
    """For each query the k best rows of a block, as (row, score)."""
    limit = float(np.abs(x.astype(float)).max()) * float(np.abs(q.astype(float)).max()) * x.shape[1]
    id_rank = np.argsort(np.argsort([(-(2**63) - 1 if i is None else i) for i in ids], kind="stable"))
    own = np.array([[i == a for i in ids] for a in qids]) if len(set(qids) & set(ids)) else None
    if limit >= 2**53:  # beyond exact floating point: plain integers
        scores = x.astype(object) @ q.astype(object).T
        scores = np.clip(scores, -(2**63), 2**63 - 1).T
        keep = np.ones(scores.shape, bool) if own is None else ~own
        return [_top(np.flatnonzero(keep[i]), scores[i], id_rank, k) for i in range(len(q))]
    kind = np.float32 if limit < 2**24 else np.float64
    values, asked = x.astype(kind), q.astype(kind)
    plus, minus = np.maximum(asked, 0), np.minimum(asked, 0)
    order = np.argsort(values, axis=0)
    rank = np.empty(order.shape, np.int32)
    np.put_along_axis(rank, order, np.arange(len(values), dtype=np.int32)[:, None], 0)
    ordered = np.take_along_axis(values, order, 0)
    low, high = ordered[0], ordered[-1]
    size = len(values)
    out = [None] * len(q)
    active = np.arange(len(q))
    depth = max(k, size // 8)
    while len(active):
        depth = min(depth, size)
        from_top, from_end = rank >= size - depth, rank < depth
        up = np.hstack([
            np.where(from_top, values, ordered[size - depth]),
            np.where(from_end, values, ordered[depth - 1]),
        ])
        down = np.hstack([np.where(from_top, values, low), np.where(from_end, values, high)])
        both = np.hstack([plus[active], minus[active]])
        upper, lower = both @ up.T, both @ down.T
        if own is not None:
            upper[own[active]] = lower[own[active]] = -np.inf
        if size > k:
            least = np.partition(lower, size - k, axis=1)[:, size - k]
        else:
            least = np.full(len(active), -np.inf)
        alive = (upper >= least[:, None]) & (upper > -np.inf)
        done = (alive.sum(1) <= _FEW * k) | (depth == size)
        for row in np.flatnonzero(done):
            i = active[row]
            rows = np.flatnonzero(alive[row])
            scores = (values[rows] @ asked[i]).astype(np.int64)
            out[i] = _top(np.arange(len(rows)), scores, id_rank[rows], k, rows)
        active = active[~done]
        depth *= 2
    return out


def _top(places, scores, id_rank, k, rows=None) -> list[tuple]:
    chosen = sorted(places.tolist(), key=lambda j: (-int(scores[j]), int(id_rank[j])))[:k]
    return [(j if rows is None else int(rows[j]), int(scores[j])) for j in chosen]
