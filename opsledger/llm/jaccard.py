"""Near-duplicate texts by Jaccard similarity of word shingles: a prefix join with exact counts.

Texts are lower-cased (A-Z) and cut into words; a set holds the distinct runs of
``WIDTH`` words. Two sets link when 100 * intersection >= ``PERCENT`` * union.

1. Equal sets are one class. Classes, not copies, are joined.
2. A fixed part of all shingles (by hash) is looked up in all texts. A text whose
   shingles of that part are unique more often than a link allows can have no
   partner and leaves.
3. The shingles of the others are counted, all of them. No intersection is larger than the number
   of shingles that a set shares with any other; sets with too few leave. Shingles are ordered by
   rising count, unique ones first. Any two that link share a shingle in their prefixes, which hold
   one more than the shingles that a partner may lack; unique ones take room there but need no
   posting. Place and number shared tell each posting's reach: how large a set may be to link with it.
4. In each posting list the sets are compared to one pivot, the one with the largest shared part
   (of a group of near copies, the text that they are copies of), then those still apart to another
   one in each of ``TURNS`` - 1 turns; candidates are verified on whole sets. This joins large groups
   of near copies in a number of pairs linear in their size.
5. Between turns, and ``ROUNDS`` times each, postings leave whose list has one component only, or
   none of another component that is in reach. Pairs that are left in the end, in a list, in different
   components and in each other's reach, are all the candidates that remain and are verified.
   So every link between components is found.

Null and empty texts and texts without words have no set and link with nothing; a text
of fewer words is one shingle. Repeated rows and equal ids are rows of their own;
null ids do not count for a component's smallest id, and stay null without one. Other
columns are ignored; an empty table gives no rows. Shingles and sets are compared
by 64-bit hashes.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsledger.functions.joins import lookup_join
from opsledger.functions.workspace import stored
from opsledger.llm.components import components
from opsledger.llm.words import WordHashes, shingle_set, split_words

WIDTH = 5
PERCENT = 75
TURNS = 2
ROUNDS = 2
_PART, _PARTS = 8, 16  # the part of all shingles that is looked up; must exceed 1 - PERCENT / 100


def _counted(tokens: np.ndarray) -> np.ndarray:
    return tokens[(tokens & np.uint64(_PARTS - 1)) < _PART]


def _key(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def _sets(batches, width):
    """Batches with the shingle set of each text."""
    hashes = WordHashes()
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            texts = part.column("text").to_pylist()
            yield part, [shingle_set(hashes.of(split_words(t, lower=True)), width) for t in texts]


def _longs(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _each(lists: pa.ListArray) -> list[np.ndarray]:
    ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    return [flat[a:b] for a, b in zip(ends, ends[1:])]


def rows_with_keys(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``row``, a hash of both that names a row."""
    return documents.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id", "text").alias("row")
    )


def _signatures(rows: DataFrame, width: int) -> DataFrame:
    """``doc_id``, ``row``, set size ``n`` and ``key``, the hash of the set."""

    def run(batches):
        for part, sets in _sets(batches, width):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("row"),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array([_key(s) for s in sets], pa.int64())],
                ["doc_id", "row", "n", "key"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, row long, n long, key long")


def _unshared(rows: DataFrame, width: int) -> DataFrame:
    """``key`` of sets with counted shingles that no other set has, and how many, ``unshared``."""

    def run(batches):
        for _, sets in _sets(batches, width):
            yield pa.RecordBatch.from_arrays(
                [pa.array([_key(s) for s in sets], pa.int64()), _longs([_counted(s) for s in sets])], ["key", "tokens"]
            )

    tokens = rows.select("text").mapInArrow(run, "key long, tokens array<long>")
    each = tokens.select("key", F.explode("tokens").alias("token"))
    owners = each.groupBy("token").agg(F.min("key").alias("key"), F.max("key").alias("last"))
    return owners.filter("key = last").groupBy("key").agg(F.count("*").alias("unshared"))


def _full_sets(rows: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """``key``, ``n`` and the whole set ``tokens`` of each class."""

    def run(batches):
        for part, sets in _sets(batches, width):
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array([len(s) for s in sets], pa.int64()), _longs(sets)], ["key", "n", "tokens"]
            )

    chosen = lookup_join(rows.select("row", "text"), classes.select("row", "key"), ["row"])
    sets = stored(chosen.select("key", "text").mapInArrow(run, "key long, n long, tokens array<long>"), "shingle-sets")
    # rows equal in id and text gave their set several times
    if not sets.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").isEmpty():
        sets = stored(sets.dropDuplicates(["key"]), "shingle-sets")
    return sets


def _postings(sets: DataFrame) -> DataFrame:
    """``token``, ``key``, ``root``, ``n``, ``most`` and ``reach`` of the shared shingles in each prefix.

    ``most`` is how many shingles a set shares with any other, ``reach`` the largest set that it may
    link with if this is their first common shingle: the intersection is then at most what lies behind
    it, and must reach PERCENT / (100 + PERCENT) of both sizes together.
    """
    each = sets.select("key", "n", F.explode("tokens").alias("token"))
    shared = each.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1")
    own = Window.partitionBy("key")
    placed = each.join(shared, "token").select(
        "token", "key", "n",
        F.count("*").over(own).alias("most"),
        F.row_number().over(own.orderBy("c", "token")).alias("place"),
    )
    # unique shingles come first; places count them
    at = F.col("n") - F.col("most") + F.col("place") - 1
    kept = placed.filter(F.expr(f"100 * most >= {PERCENT} * n")).withColumn("at", at)
    kept = kept.filter(F.expr(f"at < n - ((n * {PERCENT} + 99) div 100) + 1"))
    reach = F.expr(f"({100 + PERCENT} * least(n - at, most)) div {PERCENT} - n")
    return stored(
        kept.select("token", "key", F.col("key").alias("root"), "n", "most", reach.alias("reach")), "shingle-postings"
    )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a``, ``b`` and whether they are ``linked``."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    narrow = lookup_join(sets, wanted, ["key"], "left_semi")
    one = narrow.toDF("a", "na", "ta")
    two = narrow.toDF("b", "nb", "tb")

    def run(batches):
        for batch in batches:
            shared = [
                len(np.intersect1d(x, y, assume_unique=True))
                for x, y in zip(_each(batch.column("ta")), _each(batch.column("tb")))
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("a", "b", "na", "nb")), pa.array(shared, pa.int64())],
                ["a", "b", "na", "nb", "shared"],
            )

    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "ta", "tb")
    checked = joined.mapInArrow(run, "a long, b long, na long, nb long, shared long")
    union = F.col("na") + F.col("nb") - F.col("shared")
    return checked.select("a", "b", (100 * F.col("shared") >= PERCENT * union).alias("linked"))


def _star_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """Each set with the pivot of its lists, unless they are in one component or out of reach."""
    first = F.xxhash64("key", "token", F.lit(turn)) if turn else F.col("most") / F.col("n")
    order = F.struct(first.alias("first"), "key", "root", "n", "reach")
    pivots = rows.groupBy("token").agg(F.max(order).alias("p"), F.min("root").alias("x"), F.max("root").alias("y"))
    pivots = pivots.filter("x <> y").select(
        "token", F.col("p.key").alias("b"), F.col("p.root").alias("root_b"),
        F.col("p.n").alias("n_b"), F.col("p.reach").alias("reach_b"),
    )
    pivots = stored(pivots, "shingle-pivots")  # so that a join can deal out a long list
    near = rows.join(pivots, "token").filter("root <> root_b AND n <= reach_b AND n_b <= reach")
    return near.select(F.least("key", "b").alias("a"), F.greatest("key", "b").alias("b")).distinct()


def _apart(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Postings, with their components, that may meet one of another component in their list."""
    rows = rows.drop("root").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    for _ in range(ROUNDS):
        best = rows.groupBy("token").agg(
            F.min(F.struct("n", "root")).alias("low"), F.max(F.struct("reach", "root")).alias("high"),
            F.min("root").alias("x"), F.max("root").alias("y"),
        )
        best = stored(best.filter("x <> y"), "shingle-best")
        met = rows.join(best, "token").filter("root = low.root OR low.n <= reach")
        rows = stored(
            met.filter("root = high.root OR n <= high.reach").select("token", "key", "root", "n", "most", "reach"),
            "shingle-apart",
        )
    return rows


def _other_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of a list that lie in different components and in each other's reach."""
    parts = rows.groupBy("token", "root").agg(
        F.count("*").alias("size"), F.min("n").alias("n"), F.max("reach").alias("reach")
    )
    rows = rows.select("token", "root", "key", "n", "reach")

    def side(df, k):
        return df.select("token", *(F.col(c).alias(f"{c}{k}") for c in df.columns if c != "token"))

    # the smaller part of a list is spelt out first
    meet = side(parts, 1).join(side(parts, 2), "token").filter(
        "root1 <> root2 AND (size1, root1) < (size2, root2) AND n1 <= reach2 AND n2 <= reach1"
    )
    meet = meet.select("token", "root1", "root2", F.col("n2").alias("least"), F.col("reach2").alias("furthest"))
    spelt = meet.join(side(rows, 1), ["token", "root1"]).filter("n1 <= furthest AND least <= reach1")
    pairs = spelt.join(side(rows, 2), ["token", "root2"]).filter("n1 <= reach2 AND n2 <= reach1")
    return pairs.select(F.least("key1", "key2").alias("a"), F.greatest("key1", "key2").alias("b")).distinct()


def _roots(links: DataFrame) -> DataFrame:
    return stored(components(links).select(F.col("node").alias("key"), "root"), "shingle-roots")


def near_duplicates(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id``, ``row``, ``n_shingles``, ``component_id`` and ``group`` of each row.

    ``group`` names the component and is null for rows without a set.
    """
    rows = rows_with_keys(documents)
    signed = stored(_signatures(rows, width), "shingle-rows")
    classes = (
        signed.filter("n > 0")
        .groupBy("key", "n")
        .agg(F.min("doc_id").alias("least"), F.min("row").alias("row"))
    )
    open_classes = classes.join(_unshared(rows, width), "key", "left").filter(
        F.coalesce("unshared", F.lit(0)) < F.expr(f"n - ((n * {PERCENT} + 99) div 100) + 1")
    )
    sets = _full_sets(rows, stored(open_classes.select("row", "key"), "shingle-open"), width)
    postings = _postings(sets)
    roots = None
    for turn in range(TURNS + 1):
        pairs = stored(_star_pairs(postings, turn) if turn < TURNS else _other_pairs(postings), "shingle-candidates")
        links = _verified(pairs, sets).filter("linked").select("a", "b")
        if roots is not None:
            links = links.unionByName(roots.select(F.col("key").alias("a"), F.col("root").alias("b")))
        roots = _roots(links)
        if turn < TURNS:
            postings = _apart(postings, roots)
            if postings.isEmpty():
                break
    joined = classes.select("key", "least").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    smallest = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = joined.join(smallest, "root").select("key", "component_id", F.col("root").alias("group"))
    out = signed.withColumn("key", F.when(F.col("n") > 0, F.col("key"))).join(named, "key", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "row", F.col("n").alias("n_shingles"), component.alias("component_id"), "group"
    )


def one_of_each_group(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """``documents`` with one row of each group of near-duplicates: the smallest id, null last.

    Rows without a set stay. Of rows equal in id and text any one stays.
    """
    found = stored(near_duplicates(documents, width), "shingle-found")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    leads = found.filter("group IS NOT NULL").groupBy("group").agg(F.min(order).alias("lead"))
    marked = found.join(leads, "group")
    late = marked.filter("row <> lead.row").select(F.col("row").alias("__row")).distinct()
    again = (
        marked.filter("row = lead.row")
        .groupBy(F.col("row").alias("__row"))
        .agg(F.count("*").alias("__n"))
        .filter("__n > 1")
        .drop("__n")
    )
    name = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    kept = lookup_join(documents.withColumn("__row", name), late, ["__row"], "left_anti")
    if not again.isEmpty():
        repeated = lookup_join(kept, again, ["__row"], "left_semi").dropDuplicates(["__row"])
        kept = lookup_join(kept, again, ["__row"], "left_anti").unionByName(repeated)
    return kept.drop("__row").select(documents.columns)
