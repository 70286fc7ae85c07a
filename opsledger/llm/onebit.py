"""Nearest neighbours by randomly rotated one-bit codes with error bounds.

1. Rows with equal vectors are one class, known by its ``k + 1`` smallest ids, one of which may
   be the query's own; a list of k neighbours needs no more of it.
2. Centres are fitted to a hash sample of at most ``SAMPLE_VALUES`` components. Each class goes to the
   list of its nearest centre. What is left of it, scaled to length 1, is rotated at random,
   and the signs are its code. The code's inner product with the vector itself is its correction.
3. A code estimates the inner product with a rotated query; the error stays within ``SIGMAS``
   standard deviations of a random rotation. So each row has a least distance.
4. Each query first meets all of its own list, then every other list that can still
   hold something nearer: the distance to its centre less its radius is within the
   query's bound. In a block of a list the best estimates are scored first; then all rows whose least
   distance is within the bound. Scores come from the original vectors.

Every vector is in the index and no list or candidate is capped. The result is exact unless an error
exceeds ``SIGMAS`` standard deviations; tests measure recall against brute force. Lists and
the queries that meet them are cut into blocks, so a list may hold any share of the rows.

Vectors that are null, empty, zero or hold null or non-finite components take no part. Missing
components of shorter vectors count 0. Rows equal in id and vector count once; rows with
the id of a query are not its candidates. Null ids are candidates, never queries, and go first
among ties. With fewer than k candidates all are returned; an empty table gives no rows. Other
columns are ignored. Distances beyond the range of a double are infinite and tie.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opsledger.functions.joins import lookup_join
from opsledger.functions.workspace import stored
from opsledger.llm.topk import finite

K = 10
SIGMAS = 3.0
SEED = 11
ROWS_PER_LIST = 1024
MAX_LISTS = 1024
SAMPLE_VALUES = 1 << 21
SAMPLE_PER_LIST = 32
BLOCK = 2048
QUERY_BLOCK = 512
_SLICE = 1 << 20


class Index:
    """Centres of the lists and the rotation that the codes share."""

    def __init__(self, sample: np.ndarray, lists: int, width: int, seed: int = SEED):
        random = np.random.default_rng(seed)
        self.width = width
        self.rotation = np.linalg.qr(random.standard_normal((width, width)))[0]
        with np.errstate(all="ignore"):
            self.centres = _centres(sample if len(sample) else np.zeros((1, width)), lists, random)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List of each vector, and its distance to all centres."""
        far = np.sqrt(np.maximum(_squared(x, self.centres), 0))
        return np.argmin(np.where(np.isnan(far), np.inf, far), 1), far

    def encode(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed signs, distance to the centre, and inner product of code and vector."""
        left = x - self.centres[lists]
        size = np.sqrt((left**2).sum(1))
        unit = np.divide(left, size[:, None], out=np.zeros_like(left), where=size[:, None] > 0)
        turned = unit @ self.rotation
        own = np.abs(turned).sum(1) / np.sqrt(self.width)
        return np.packbits(turned >= 0, axis=1), size, own

    def bounds(self, codes, size, own, centre: np.ndarray, queries: np.ndarray, sigmas: float):
        """Estimated and least squared distance of each query (row) to each coded vector."""
        left = queries - centre
        far = np.sqrt((left**2).sum(1))[:, None]
        unit = np.divide(left, far, out=np.zeros_like(left), where=far > 0)
        signs = np.unpackbits(codes, axis=1, count=self.width).astype(np.float64)
        signs = (2 * signs - 1) / np.sqrt(self.width)
        seen = (unit @ self.rotation) @ signs.T
        safe = np.where(own > 0, own, 1.0)
        # what the code leaves out of the vector is at a right angle to it, in a random direction
        rest = np.sqrt(np.maximum(1 - seen**2, 0))
        error = np.minimum(sigmas / np.sqrt(max(self.width - 1, 1)), rest)
        error = error * (np.sqrt(np.maximum(1 - own**2, 0)) / safe)
        both = 2 * far * size
        base = far**2 + size**2
        guess = seen / safe
        slack = 1e-9 * (base + both)
        return base - both * guess, base - both * (guess + error) - slack


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x**2).sum(1)[:, None] - 2 * (x @ centres.T) + (centres**2).sum(1)


def _centres(sample: np.ndarray, lists: int, random, rounds: int = 8) -> np.ndarray:
    """A few rounds of k-means, from distinct starting points."""
    centres = sample[random.choice(len(sample), min(lists, len(sample)), replace=False)]
    for _ in range(rounds):
        near = np.argmin(_squared(sample, centres), 1)
        order = np.argsort(near, kind="stable")
        found, begin = np.unique(near[order], return_index=True)
        counts = np.diff(np.append(begin, len(near)))
        centres = centres.copy()
        centres[found] = np.add.reduceat(sample[order], begin, axis=0) / counts[:, None]
    return centres


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles, filled with zeros on the right."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    sizes = column.value_lengths().to_numpy(False).astype(np.int64)
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(False)
    return out


def _distances(x: np.ndarray, q: np.ndarray, rows: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Distance of row ``rows[i]`` to query ``of[i]``, components added up in order."""
    out = np.empty(len(rows))
    step = max(1, _SLICE // max(1, x.shape[1]))
    for at in range(0, len(rows), step):
        cut = slice(at, at + step)
        out[cut] = np.add.accumulate((x[rows[cut]] - q[of[cut]]) ** 2, axis=1)[:, -1]
    return np.sqrt(out)


def best_of_block(
    index: Index, part: dict, queries: np.ndarray, limits: np.ndarray, needs: np.ndarray, sigmas: float
):
    """(query, row, distance) of all rows of a block that are among a query's nearest in it.

    ``limits`` are distances that the query's neighbours do not exceed, ``needs`` how many it asks
    for. Rows as far as the last of them are all given.
    """
    with np.errstate(all="ignore"):
        guess, least = index.bounds(
            part["code"], part["size"], part["own"], index.centres[part["list"]], queries, sigmas
        )
        n = len(part["x"])
        take = min(int(needs.max()), n)
        first = np.argpartition(np.where(np.isnan(guess), np.inf, guess), take - 1, axis=1)[:, :take]
        of = np.repeat(np.arange(len(queries)), take)
        seen = _distances(part["x"], queries, first.ravel(), of).reshape(-1, take)
        last = np.sort(seen, axis=1)[np.arange(len(queries)), np.minimum(needs, take) - 1]
        limits = np.where(needs <= take, np.fmin(limits, last), limits)
        # not "<=": what cannot be told apart is scored
        open_ = ~(least > (limits**2 * (1 + 1e-9))[:, None])
        of, rows = np.nonzero(open_)
        score = _distances(part["x"], queries, rows, of)
        keep = ~(score > limits[of])
    return of[keep], rows[keep], score[keep]


def _fit(classes: DataFrame, count: int, width: int, seed: int) -> Index:
    lists = max(1, min(count // ROWS_PER_LIST, MAX_LISTS, SAMPLE_VALUES // (SAMPLE_PER_LIST * width)))
    rows = min(max(1, SAMPLE_VALUES // width), lists * SAMPLE_PER_LIST)
    chosen = classes.orderBy(F.xxhash64("x"), "x").limit(rows).select("x").toArrow()
    return Index(_matrix(chosen.column("x"), width), lists, width, seed)


def _encoded(classes: DataFrame, index: Index) -> DataFrame:
    """Each class with its list, code and corrections."""

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("x"), index.width)
            with np.errstate(all="ignore"):
                lists, _ = index.nearest(x)
                codes, size, own = index.encode(x, lists)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array(size), pa.array(own), batch.column("x"), batch.column("ids")],
                ["list", "code", "size", "own", "x", "ids"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    return stored(
        classes.select("x", "ids").mapInArrow(
            run, f"list int, code binary, size double, own double, x {kinds['x']}, ids {kinds['ids']}"
        ),
        "onebit-index",
    )


def _met(asked: DataFrame, index: Index, radii: np.ndarray, own: bool) -> DataFrame:
    """(query, list) pairs: the query's own list, or each other one within its limit."""

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("x"), index.width)
            limits = batch.column("limit").to_numpy(False)
            with np.errstate(all="ignore"):
                lists, far = index.nearest(x)
                home = np.arange(len(radii)) == lists[:, None]
                # not "<=", so that lists that cannot be told apart are met
                slack = 1e-6 * (np.sqrt((x**2).sum(1))[:, None] + far + radii)
                near = ~(far - radii - slack > limits[:, None])
            of, found = np.nonzero(home if own else near & ~home & (radii >= 0))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name).take(pa.array(of)) for name in ("q", "x", "need")),
                 pa.array(found, pa.int32()), pa.array(limits[of])],
                ["q", "x", "need", "list", "limit"],
            )

    kind = asked.schema["x"].dataType.simpleString()
    return asked.select("q", "x", "need", "limit").mapInArrow(
        run, f"q long, x {kind}, need long, list int, limit double"
    )


def _scored(rows: DataFrame, pairs: DataFrame, sizes: DataFrame, index: Index, sigmas: float) -> DataFrame:
    """``q``, ``need``, ``id``, ``score``: for each pair the best ids of each block of the list."""
    pairs = stored(pairs, "onebit-pairs")
    asked = pairs.groupBy("list").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("groups"))
    # one row per list, MAX_LISTS at most
    cuts = F.broadcast(sizes.select("list", "blocks").join(F.broadcast(asked), "list"))
    part = F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int")
    group = F.pmod(F.xxhash64("q"), F.col("groups")).cast("int")
    count_up = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.join(cuts, "list").select(
        "list", part.alias("block"), count_up("groups").alias("group"), "code", "size", "own", "x", "ids"
    )
    right = pairs.join(cuts, "list").select(
        "list", count_up("blocks").alias("block"), group.alias("group"), "q", "x", "need", "limit"
    )

    def run(block: pa.Table, wanted: pa.Table) -> pa.Table:
        out = {"q": [], "need": [], "id": [], "score": []}
        if block.num_rows and wanted.num_rows:
            codes = np.frombuffer(b"".join(block.column("code").to_pylist()), np.uint8)
            held = {
                "code": codes.reshape(block.num_rows, -1),
                "size": block.column("size").to_numpy(),
                "own": block.column("own").to_numpy(),
                "x": _matrix(block.column("x"), index.width),
                "list": block.column("list")[0].as_py(),
            }
            queries, limits = _matrix(wanted.column("x"), index.width), wanted.column("limit").to_numpy()
            needs = wanted.column("need").to_numpy()
            of, rows, score = best_of_block(index, held, queries, limits, needs, sigmas)
            ids, names = block.column("ids").to_pylist(), wanted.column("q").to_numpy()
            order = np.lexsort((score, of))
            begin = np.searchsorted(of[order], np.arange(len(queries) + 1))
            for i in range(len(queries)):
                near = order[begin[i] : begin[i + 1]]
                least = sorted(
                    ((s, a is not None, a) for r, s in zip(rows[near], score[near]) for a in ids[r]),
                    key=lambda e: e if e[1] else (e[0], False, 0),
                )[: needs[i]]
                out["q"] += [names[i]] * len(least)
                out["need"] += [needs[i]] * len(least)
                out["id"] += [a for _, _, a in least]
                out["score"] += [s for s, _, _ in least]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), kinds)], list(out))

    return (
        left.groupBy("list", "block", "group")
        .cogroup(right.groupBy("list", "block", "group"))
        .applyInArrow(run, "q long, need long, id long, score double")
    )


def _ranked(found: DataFrame, by: list[str], k: int | Column) -> DataFrame:
    order = Window.partitionBy(*by).orderBy("score", F.col("id").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _asked(wanted: DataFrame, k: int) -> DataFrame:
    """Distinct query vectors ``x``, numbered ``q``, and how many neighbours they ``need``.

    The rows with a query's id, mostly one, are found beside the k that count.
    """
    often = wanted.groupBy("id").agg(F.count("*").alias("own")).filter("own > 1")
    own = F.coalesce("own", F.lit(1))
    needs = lookup_join(wanted, often, ["id"], "left").groupBy("x").agg((F.max(own) + k).alias("need"))
    return stored(needs.withColumn("q", F.monotonically_increasing_id()), "onebit-queries")


def search(
    vectors: DataFrame,
    queries: Column | None = None,
    k: int = K,
    key: str = "vec_id",
    vector: str = "embedding",
    sigmas: float = SIGMAS,
    seed: int = SEED,
) -> DataFrame:
    """The k nearest rows for each query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    ``queries`` is a condition on ``id``; by default the ids that 100 divides.
    """
    is_query = (F.col("id") % 100 == 0) if queries is None else queries
    wanted = F.col("id").isNotNull() & F.coalesce(is_query, F.lit(False))
    # -0.0 becomes 0.0, so that equal vectors are equal bytes
    plain = F.transform(vector, lambda x: x.cast("double") + F.lit(0.0))
    rows = (
        vectors.filter(finite(F.col(vector)) & F.exists(vector, lambda x: x != 0))
        .select(F.col(key).cast("long").alias("id"), plain.alias("x"))
        .distinct()
    )
    rows = stored(rows, "onebit-rows")
    same = Window.partitionBy("x").orderBy(F.col("id").asc_nulls_first())
    few = rows.withColumn("place", F.row_number().over(same)).filter(F.col("place") <= k + 1)
    classes = stored(few.groupBy("x").agg(F.collect_list("id").alias("ids"), F.count("*").alias("n")), "onebit-classes")
    total = rows.agg(F.max(F.size("x")).alias("width")).first()
    width = total["width"] or 1
    # collect_list leaves null ids out; they come first
    nulls = F.when(F.col("n") > F.size("ids"), F.array(F.lit(None).cast("long"))).otherwise(F.array().cast("array<long>"))
    classes = classes.select("x", F.concat(nulls, "ids").alias("ids"))
    index = _fit(classes, classes.count(), width, seed)
    coded = _encoded(classes, index)
    sizes = stored(
        coded.groupBy("list").agg(
            F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.max("size").alias("radius")
        ),
        "onebit-lists",
    )
    radii = np.full(max(1, len(index.centres)), -1.0)
    for row in sizes.collect():  # one row per list
        radii[row["list"]] = row["radius"]
    asked = _asked(rows.filter(wanted), k)
    open_ = asked.withColumn("limit", F.lit(float("inf")))
    at_home = stored(_scored(coded, _met(open_, index, radii, True), sizes, index, sigmas), "onebit-home")
    last = F.when(F.count("*") >= F.max("need"), F.max("score")).otherwise(F.lit(float("inf")))
    limits = _ranked(at_home, ["q"], F.col("need")).groupBy("q").agg(last.alias("limit"))
    bounded = asked.join(limits, "q", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
    away = _scored(coded, _met(bounded, index, radii, False), sizes, index, sigmas)
    nearest = stored(_ranked(at_home.unionByName(away), ["q"], F.col("need")).drop("rank"), "onebit-nearest")
    ids = lookup_join(rows.filter(wanted).withColumnRenamed("id", "query_id"), asked.select("x", "q"), ["x"]).select("query_id", "q")
    pairs = lookup_join(ids, nearest.groupBy("q").agg(F.collect_list(F.struct("id", "score")).alias("near")), ["q"])
    each = pairs.select("query_id", "q", F.explode("near").alias("n")).select("query_id", "q", "n.*")
    others = each.filter(~F.col("id").eqNullSafe(F.col("query_id")))
    return _ranked(others, ["query_id", "q"], k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score"
    )
