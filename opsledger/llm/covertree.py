"""Near-duplicate vectors by cover trees and dual traversal.

Vectors are compared within a label, by cosine in double precision. On unit
vectors a cosine is a distance, so a cover tree applies: nested levels of centres with
halving radii, each centre with the measured distance to its farthest
descendant. A pair of nodes is dropped when the distance of their centres exceeds both
covering radii and the wanted distance together; pairs that reach single points are checked
by cosine, so the links are exact.

Equal vectors of a label are one class first. Spark holds the upper levels: a few centres per
label from a sample of at most ``SAMPLE`` classes by hash (any centres give exact results), all
classes dealt to their nearest centre, and blocks of about ``BLOCK`` classes with measured radii.
Surviving pairs of nodes, then of blocks, are joined, and one task builds the lower
levels of two blocks and walks them together. A task returns link counts per class and
a spanning forest of its links, never all pairs, so a large group stays linear.

Vectors that are null, empty, zero, or hold null or non-finite components, and those
without a label link with nothing. Vectors of other length in a label link with
nothing of that length. Rows with equal ids count as rows of their own. Null ids
do not count for the smallest id; a component of null ids only has id null and keeps
its rows. Other columns are ignored, an empty table gives no rows.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opsledger.functions.joins import lookup_join
from opsledger.functions.workspace import stored
from opsledger.llm.components import components
from opsledger.llm.topk import finite

COSINE = 0.93
SAMPLE = 256
CENTRES = 32
BLOCK = 1024
_SLACK = 1e-7


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1))[:, None]


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of unit vectors, by row and column."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


class CoverTree:
    """Nested levels of centres over unit vectors, radii 2, 1, 1/2, ... until all are centres.

    ``levels`` holds (centres, parents, radii): indices of points, for each centre the
    place of its parent in the level above, and the distance of its farthest descendant.
    """

    def __init__(self, points: np.ndarray, least: float):
        self.points = points
        chosen = np.zeros(1, np.int64)
        nearest = np.zeros(len(points), np.int64)  # place of the centre that holds a point
        gap = distance(points, points[:1])[:, 0]
        self.levels = [(chosen, np.zeros(1, np.int64), np.array([gap.max()]))]
        gap[0] = 0.0  # rounding may put a point apart from itself
        radius = 1.0
        while len(chosen) < len(points):
            new = self._net(np.flatnonzero(gap > radius), radius)
            # finer levels prune nothing, or only points equal to a centre are left: the rest become centres
            if radius < least or not gap.any():
                others = np.ones(len(points), bool)
                others[chosen] = False
                new = np.flatnonzero(others)
            if len(new):
                centres = np.concatenate([chosen, new])
                parents = np.concatenate([np.arange(len(chosen)), nearest[new]])
                apart = distance(points, points[new])
                # a point moves to a new centre only under the same parent, so levels nest
                apart[nearest[:, None] != nearest[new][None, :]] = np.inf
                best = apart.argmin(1)
                closer = apart[np.arange(len(points)), best] < gap
                gap = np.where(closer, apart[np.arange(len(points)), best], gap)
                nearest = np.where(closer, len(chosen) + best, nearest)
                nearest[new], gap[new] = len(chosen) + np.arange(len(new)), 0.0
                chosen = centres
                radii = np.zeros(len(chosen))
                np.maximum.at(radii, nearest, gap)
                self.levels.append((chosen, parents, radii))
            radius /= 2

    def _net(self, open_points: np.ndarray, radius: float) -> np.ndarray:
        """Greedy choice, by index, of points farther apart than ``radius``."""
        if not len(open_points):
            return open_points
        near = distance(self.points[open_points], self.points[open_points]) <= radius
        covered = np.zeros(len(open_points), bool)
        picked = []
        for i in range(len(open_points)):
            if not covered[i]:
                picked.append(i)
                covered |= near[i]
        return open_points[picked]


def links(one: CoverTree, two: CoverTree, cosine: float = COSINE) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (point of one, point of two) with cosine or more, by dual traversal."""
    wanted = np.sqrt(2 - 2 * cosine) + _SLACK
    alive = np.ones((1, 1), bool)
    for level in range(max(len(one.levels), len(two.levels))):
        a, a_parent, a_radius = one.levels[min(level, len(one.levels) - 1)]
        b, b_parent, b_radius = two.levels[min(level, len(two.levels) - 1)]
        if level:
            if level < len(one.levels):
                alive = alive[a_parent]
            if level < len(two.levels):
                alive = alive[:, b_parent]
        rows, columns = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
        if not len(rows):
            return rows, rows
        apart = distance(one.points[a[rows]], two.points[b[columns]])
        near = apart <= a_radius[rows][:, None] + b_radius[columns][None, :] + wanted
        kept = np.zeros_like(alive)
        kept[np.ix_(rows, columns)] = near
        alive &= kept
    i, j = np.nonzero(alive)
    i, j = a[i], b[j]
    exact = np.einsum("ij,ij->i", one.points[i], two.points[j]) >= cosine
    return i[exact], j[exact]


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def classes(vectors: DataFrame) -> DataFrame:
    """``class`` (null where a vector takes no part) added to ``vec_id``, ``label``, ``x``."""
    x = F.col("embedding")
    fine = finite(x) & F.exists(x, lambda v: v != 0) & F.col("label").isNotNull()
    name = F.md5(F.concat_ws(",", F.col("label").cast("string"), F.transform(x, lambda v: v.cast("string"))))
    # large or tiny components: scale by the largest before squaring
    largest = F.array_max(F.transform(x, lambda v: F.abs(v.cast("double"))))
    scaled = F.transform(x, lambda v: v.cast("double") / largest)
    fine = F.coalesce(fine, F.lit(False))
    return vectors.select(
        "vec_id", "label", F.when(fine, scaled).alias("x"), F.when(fine, name).alias("class")
    )


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of each row."""
    marked = classes(vectors.select("vec_id", "label", "embedding"))
    # vectors of one label and length form a space of their own
    space = F.concat_ws(":", F.col("label").cast("string"), F.size("x").cast("string"))
    points = stored(
        marked.filter("class IS NOT NULL")
        .groupBy("class")
        .agg(F.first("x").alias("x"), F.first(space).alias("space"),
             F.min("vec_id").alias("least"), F.count("*").alias("members")),
        "vector-classes",
    )
    blocks = _blocks(points, block)
    pairs = _block_pairs(blocks, cosine)
    found = stored(_links(blocks, pairs, cosine), "vector-links")
    degrees = found.filter("b IS NULL").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("links"))
    roots = components(found.filter("b IS NOT NULL").select("a", "b"))
    joined = points.select("class", "least", "members").join(degrees, "class", "left")
    joined = joined.join(roots.withColumnRenamed("node", "class"), "class", "left")
    joined = joined.withColumn("root", F.coalesce("root", "class"))
    smallest = joined.groupBy("root").agg(F.min("least").alias("component"))
    per_class = joined.join(smallest, "root").select(
        "class", "component", (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("links")
    )
    out = marked.drop("x").join(per_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _blocks(points: DataFrame, block: int) -> DataFrame:
    """Rows (space, node, chunk, block, centre, radius, classes, members, x), one for each block."""
    sizes = points.groupBy("space").agg(F.count("*").alias("size"))
    order = Window.partitionBy("space").orderBy(F.xxhash64("class"), "class")
    sample = points.select("space", "class", "x").withColumn("place", F.row_number().over(order))
    sample = sample.filter(F.col("place") <= SAMPLE).join(sizes, "space")

    def centres(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place")
        found = unit(_matrix(frame["x"]))
        most = int(min(CENTRES, max(1, frame["size"].iloc[0] // block)))
        # the first centres in level order of a tree over the sample
        chosen = CoverTree(found, 0.0).levels[-1][0][:most]
        return pd.DataFrame({"space": [key[0]], "centres": [found[chosen].ravel().tolist()]})

    nodes = sample.groupBy("space").applyInPandas(centres, "space string, centres array<double>")
    nodes = stored(nodes, "vector-centres")

    def deal(frames):
        for frame in frames:
            at, far, held = [], [], []
            for x, centre in zip(frame["x"], frame["centres"]):
                x = np.asarray(x, np.float64)
                table = np.asarray(centre, np.float64).reshape(-1, len(x))
                gaps = distance(unit(x[None]), table)[0]
                i = int(gaps.argmin())
                at.append(i)
                far.append(float(gaps[i]))
                held.append(table[i].tolist())
            yield frame[["space", "class", "members", "x"]].assign(node=at, gap=far, centre=held)

    dealt = stored(
        lookup_join(points.select("space", "class", "members", "x"), nodes, ["space"]).mapInPandas(
            deal,
            "space string, class string, members long, x array<double>, node long, gap double, centre array<double>",
        ),
        "vector-nodes",
    )
    counts = dealt.groupBy("space", "node").agg(F.count("*").alias("size"))
    chunk = F.pmod(F.xxhash64("class"), F.ceil(F.col("size") / block).cast("long"))
    chunked = lookup_join(dealt, counts, ["space", "node"]).withColumn("chunk", chunk)

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("class")
        x = unit(_matrix(table.column("x").to_pylist()))
        return pa.table({
            "space": [key[0].as_py()], "node": [key[1].as_py()], "chunk": [key[2].as_py()],
            "radius": [max(table.column("gap").to_pylist())],
            "centre": [table.column("centre")[0].as_py()],
            "classes": [table.column("class").to_pylist()],
            "members": [table.column("members").to_pylist()],
            "x": [x.tobytes()],
        })

    packed = chunked.drop("size").groupBy("space", "node", "chunk").applyInArrow(
        pack,
        "space string, node long, chunk long, radius double, centre array<double>, "
        "classes array<string>, members array<long>, x binary",
    )
    name = F.concat_ws("/", "space", F.col("node").cast("string"), F.col("chunk").cast("string"))
    return stored(packed.withColumn("block", name), "vector-blocks")


def _block_pairs(blocks: DataFrame, cosine: float) -> DataFrame:
    """Pairs of blocks that their centres and radii do not rule out: nodes first."""
    wanted = float(np.sqrt(2 - 2 * cosine) + _SLACK)
    nodes = blocks.groupBy("space", "node").agg(F.max("radius").alias("radius"), F.first("centre").alias("centre"))

    def sides(df, *names):
        return (
            df.select("space", *(F.col(n).alias(f"{n}1") for n in names)),
            df.select("space", *(F.col(n).alias(f"{n}2") for n in names)),
        )

    one, two = sides(nodes, "node", "radius", "centre")
    squares = F.zip_with("centre1", "centre2", lambda a, b: (a - b) * (a - b))
    apart = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, v: s + v))
    near = apart <= F.col("radius1") + F.col("radius2") + wanted
    kept = one.join(two, "space").filter("node1 <= node2").filter(near).select("space", "node1", "node2", apart.alias("apart"))
    one, two = sides(blocks, "node", "block", "radius")
    pairs = kept.join(one, ["space", "node1"]).join(two, ["space", "node2"])
    pairs = pairs.filter("node1 < node2 OR block1 <= block2")
    return pairs.filter(F.col("apart") <= F.col("radius1") + F.col("radius2") + wanted).select("block1", "block2")


def _links(blocks: DataFrame, pairs: DataFrame, cosine: float) -> DataFrame:
    """Rows (a, null, n): class a has n links more; rows (a, b, null): a and b are linked."""

    def side(k):
        return blocks.select(
            F.col("block").alias(f"block{k}"), F.col("classes").alias(f"classes{k}"),
            F.col("members").alias(f"members{k}"), F.col("x").alias(f"x{k}"),
        )

    joined = pairs.repartition("block1", "block2").join(side(1), "block1").join(side(2), "block2")

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                yield _pair_links(batch.slice(row, 1).to_pylist()[0], cosine)

    return joined.mapInArrow(run, "a string, b string, n long")


def _pair_links(row: dict, cosine: float) -> pa.RecordBatch:
    same = row["block1"] == row["block2"]
    names = [row["classes1"], row["classes2"]]
    trees = []
    for k in (1, 2) if not same else (1,):
        x = np.frombuffer(row[f"x{k}"], np.float64).reshape(len(row[f"classes{k}"]), -1)
        trees.append(CoverTree(x, float(np.sqrt(2 - 2 * cosine)) / 4))
    i, j = links(trees[0], trees[-1], cosine)
    if same:
        i, j = i[i < j], j[i < j]
        offset = 0
    else:
        offset = len(names[0])
    total = len(names[0]) + (0 if same else len(names[1]))
    j = j + offset
    weights = np.array(row["members1"] + ([] if same else row["members2"]), np.int64)
    degree = np.bincount(i, weights[j], total) + np.bincount(j, weights[i], total)
    root = np.arange(total)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    every = names[0] + ([] if same else names[1])
    hit, child = np.flatnonzero(degree), np.flatnonzero(root != np.arange(total))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([every[k] for k in hit] + [every[k] for k in child], pa.string()),
            pa.array([None] * len(hit) + [every[k] for k in root[child]], pa.string()),
            pa.array([int(n) for n in degree[hit]] + [None] * len(child), pa.int64()),
        ],
        ["a", "b", "n"],
    )
