"""Log search that opens only files that may hold a match: a filter of trigrams per file.

The index says for each file which runs of three characters occur in its lines, as one bit of ``BITS``
per hash, A-Z as a-z. A text can only be in a file that has all its trigrams; of a regular
expression the literals that every match must hold are found, alternatives apart. Where a
pattern promises no three characters in a row, all files are read.

Filters err on the side of reading. A file that is new, or whose size or time has changed
since it was indexed, is read too, so results always equal those of a full scan.
"""

import re
import warnings
from functools import reduce
from operator import and_, or_
from re import _parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.operators.logs import line_contains, line_matches

BITS = 1 << 18
_PART_BITS = 32_768
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FILE = ["path", "length", "modified"]
# constructs that other regex dialects read in another way, so nothing is concluded from them
_UNSURE = re.compile(r"\(\?[a-zA-Z]*[xuUdDL]|\\[0QEkgGXRhHvVNpPzZ]|&&|\[[^\]]*\[")


def _files(spark: SparkSession, glob: str | list[str]) -> DataFrame:
    """Each file as the index names it, and as ``name`` to open it by; contents are not read."""
    return spark.read.format("binaryFile").load(glob).select(*_file(), F.col("path").alias("name"))


def _file() -> list[Column]:
    """The same for every kind of scan, escaped characters of the path included."""
    return [
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
    ]


def build_index(spark: SparkSession, glob: str | list[str]) -> DataFrame:
    """Rows (path, length, modified, part, bits), and one with ``part`` -1 for each file."""
    lines = spark.read.text(glob).select(*_file(), F.translate("value", _UPPER, _LOWER).alias("line"))
    starts = F.sequence(F.lit(1), F.length("line") - 2)
    bits = F.transform(starts, lambda i: F.pmod(F.xxhash64(F.substring(F.col("line"), i, F.lit(3))), F.lit(BITS)))
    each = lines.where(F.length("line") >= 3).select(*_FILE, F.explode(F.array_distinct(bits)).alias("place"))
    # each bit of a file once, by hashing, before bitmaps are built, which sorts all rows that come in
    each = each.distinct()
    filters = (
        each.select(
            *_FILE,
            F.floor(F.col("place") / _PART_BITS).cast("int").alias("part"),
            (F.col("place") % _PART_BITS).alias("bit"),
        )
        .groupBy(*_FILE, "part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    marks = _files(spark, glob).select(*_FILE, F.lit(-1).alias("part"), F.lit(b"").alias("bits"))
    return marks.unionByName(filters)


def update_index(spark: SparkSession, glob: str, path: str) -> None:
    """Index the files that are new or have changed; each run adds to the table at ``path``."""
    known = spark.read.parquet(path).where("part = -1").select(*_FILE)
    fresh = [r["name"] for r in _files(spark, glob).join(known, _FILE, "left_anti").collect()]
    if fresh:
        build_index(spark, fresh).write.mode("append").parquet(path)


def _grams(text: str) -> list:
    text = text.translate(str.maketrans(_UPPER, _LOWER))
    return [text[i : i + 3] for i in range(len(text) - 2)]


def _walk(parsed) -> tuple:
    """What every match holds: ("all" or "any", parts); a part is a trigram or such a pair."""
    found, run = [], []

    def flush():
        found.extend(_grams("".join(run)))
        run.clear()

    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            run.append(chr(value))
            continue
        flush()
        if name == "SUBPATTERN":
            found.append(_walk(value[-1]))
        elif name == "ATOMIC_GROUP":
            found.append(_walk(value))
        elif name == "BRANCH":
            found.append(("any", [_walk(branch) for branch in value[1]]))
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and value[0] >= 1:
            found.append(_walk(value[2]))
    flush()
    return "all", found


def _settled(tree):
    """Without parts that promise nothing; None if nothing is left."""
    if isinstance(tree, str):
        return tree
    kind, parts = tree
    parts = [_settled(p) for p in parts]
    if kind == "any":
        return None if any(p is None for p in parts) else (kind, parts)
    parts = [q for p in parts if p is not None for q in (p[1] if p[0] == "all" else [p])]
    return (kind, parts) if len(parts) > 1 else parts[0] if parts else None


def needed_of_text(text: str):
    """Trigrams that a line with ``text`` holds; None if there is none."""
    return _settled(("all", _grams(text)))


def needed_of_regex(pattern: str):
    """Trigrams that each match of ``pattern`` holds, with alternatives; None if none is sure."""
    if _UNSURE.search(pattern):
        return None
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("error")
            return _settled(_walk(_parser.parse(pattern)))
    except (re.error, Warning, OverflowError):
        return None


def _leaves(tree) -> set:
    return {tree} if isinstance(tree, str) else set().union(*[_leaves(p) for p in tree[1]])


def matching_files(spark: SparkSession, glob: str, index: DataFrame, needed) -> DataFrame:
    """Names of the files that may hold a match, of those that are there now."""
    files = _files(spark, glob)
    if needed is None:
        return files.select("name")
    grams = sorted(_leaves(needed))
    names = {gram: f"g{i}" for i, gram in enumerate(grams)}
    places = spark.createDataFrame([(g,) for g in grams], "gram string")
    bits = {r["gram"]: r["bit"] for r in places.select("gram", F.pmod(F.xxhash64("gram"), F.lit(BITS)).alias("bit")).collect()}

    def seen(gram: str) -> Column:
        part, bit = divmod(bits[gram], _PART_BITS)
        byte = F.conv(F.hex(F.substring("bits", bit // 8 + 1, 1)), 16, 10).cast("int")
        return F.coalesce(F.bool_or((F.col("part") == part) & (F.getbit(byte, F.lit(bit % 8)) == 1)), F.lit(False))

    def holds(tree) -> Column:
        if isinstance(tree, str):
            return F.col(names[tree])
        return reduce(and_ if tree[0] == "all" else or_, [holds(p) for p in tree[1]])

    parts = sorted({bits[g] // _PART_BITS for g in grams} | {-1})
    flags = index.where(F.col("part").isin(parts)).groupBy(*_FILE).agg(*[seen(g).alias(names[g]) for g in grams])
    judged = files.join(flags.select(*_FILE, holds(needed).alias("may")), _FILE, "left")
    return judged.where(F.coalesce("may", F.lit(True))).select("name")


def search(
    spark: SparkSession, glob: str, index: DataFrame, text: str | None = None, regex: str | None = None
) -> DataFrame:
    """``path`` and ``line`` of the lines that hold ``text`` or match ``regex`` (or both, if both are given)."""
    wanted, needed = [], []
    if text is not None:
        wanted.append(line_contains(text))
        needed.append(needed_of_text(text))
    if regex is not None:
        wanted.append(line_matches(regex))
        needed.append(needed_of_regex(regex))
    if not wanted:
        raise ValueError("search for a text or a regex")
    sure = [n for n in needed if n is not None]
    # file names are held by the driver as in any scan
    paths = [r["name"] for r in matching_files(spark, glob, index, ("all", sure) if sure else None).collect()]
    if not paths:
        return spark.createDataFrame([], "path string, line string")
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))
    return lines.where(reduce(and_, wanted))
