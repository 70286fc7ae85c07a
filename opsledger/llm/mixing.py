"""Mix sources to target weights by systematic sampling of whole documents.

Each source gets a share of all words by weight. A share stops at ``cap`` times
the words of its source; the excess goes to the others by weight until none is
above. Each document of a source is expected ``target / source size`` times. The
expected copies are summed along the source, sorted by size so that the words taken
come near the target; one random offset is added, and a document is taken once
per integer that its stretch of the sum crosses.

Null or empty texts have size 0. Null sources are one source, the last in order.
Null ids sort first; rows equal in every column are interchangeable. Input columns
travel in the struct ``row``, so their names cannot clash. An empty table gives
no rows. Sums are integers in units of 2**-32 copies, so reruns agree exactly.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from opsledger.functions.workspace import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix"
_UNIT = 1 << 32


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Never null; sorts as the source does by code point, with null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def with_positions(df: DataFrame, group: str | None, order: list[Column], name: str) -> DataFrame:
    """Number the rows of each group from 0 in ``order``, which starts with the group.

    Rows are sorted by range, so a hot group spreads over many tasks; a table with
    one row per (task, group) carries the numbers across tasks.
    """
    ranked = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__seq", F.monotonically_increasing_id()),
        name,
    ).withColumn("__task", F.shiftright("__seq", 33))
    if group is None:
        group = "__all"
        ranked = ranked.withColumn(group, F.lit("0"))
    before = Window.partitionBy(group).orderBy("__task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        ranked.groupBy("__task", group)
        .agg(F.count("*").alias("__n"), F.min("__seq").alias("__first"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    return (
        ranked.join(starts, ["__task", group])
        .withColumn("__pos", F.col("__before") + F.col("__seq") - F.col("__first"))
        .drop("__task", "__seq", "__first", "__before", "__all")
    )


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP
) -> DataFrame:
    """Targets from (``__source``, ``__words``): adds ``source_size`` and ``target``."""
    totals = sizes.groupBy("__source").agg(F.sum("__words").alias("source_size"))
    numbered = with_positions(totals, None, [F.col("__source").asc()], "mix-sources")
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.col("__pos") % len(weights) + 1).cast("int")
    )
    sources = stored(numbered.withColumn("__weight", weight.cast("long")).drop("__pos"), "mix-weights")
    level, stopped = None, -1
    while True:
        full = F.lit(False)
        if level is not None:
            full = F.col("__weight") * F.lit(level) > cap * F.col("source_size")
        sums = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, cap * F.col("source_size"))).alias("stopped"),
            F.sum(F.when(~full, F.col("__weight"))).alias("weight"),
            F.count(F.when(full, 1)).alias("n"),
        ).first()
        if sums["n"] == stopped or not sums["weight"]:
            break
        stopped = sums["n"]
        level = (sums["all"] - (sums["stopped"] or 0)) / sums["weight"]
    share = F.col("__weight") * F.lit(float(level or 0.0))
    limit = (cap * F.col("source_size")).cast("double")
    return sources.withColumn("target", F.least(share, limit)).drop("__weight")


def mix(
    df: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = CAP,
    seed: str = SEED,
) -> DataFrame:
    """``row``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` of each row."""
    rows = df.select(
        F.struct("*").alias("row"),
        source_key(F.col(source)).alias("__source"),
        word_count(F.col(text)).alias("size"),
    )
    return sample(rows, F.col(f"row.`{key}`"), weights, cap, seed)


def sample(rows: DataFrame, key: Column, weights, cap, seed) -> DataFrame:
    """As ``mix``, for rows that already hold ``row``, ``__source`` and ``size``."""
    sizes = rows.select("__source", F.col("size").alias("__words"))
    targets = source_targets(sizes, weights, cap)
    order = [F.col("__source"), F.col("size"), key, F.xxhash64(*_plain(rows))]
    numbered = with_positions(rows, "__source", order, "mix-rows")
    rate = F.when(
        F.col("source_size") > 0,
        F.floor(F.col("target") / F.col("source_size") * F.lit(float(_UNIT))),
    ).otherwise(F.lit(0)).cast(T.DecimalType(17, 0))
    digest = F.md5(F.concat(F.lit(seed), F.col("__source")))
    offset = F.conv(F.substring(digest, 1, 8), 16, 10).cast(T.DecimalType(10, 0))
    joined = (
        numbered.join(targets, "__source")
        .withColumn("__rate", rate)
        .withColumn("__offset", offset)
        .withColumn("__at", F.col("__pos").cast(T.DecimalType(20, 0)))
    )
    crossed = F.expr(
        f"(((__at + 1) * __rate + __offset) div {_UNIT}) - ((__at * __rate + __offset) div {_UNIT})"
    )
    return joined.withColumn("copies", F.least(crossed, F.lit(cap)).cast("int")).select(
        "row",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed_rows(df: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` that the mix takes, each as often as it is taken."""
    taken = mix(df, **options).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def _plain(rows: DataFrame) -> list[Column]:
    """Columns of ``row`` that can be hashed, to order rows that share a key."""
    fields = rows.schema["row"].dataType.fields
    odd = (T.MapType, T.VariantType)
    return [F.col(f"row.`{f.name}`") for f in fields if not isinstance(f.dataType, odd)] or [F.lit(0)]
