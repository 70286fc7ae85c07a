"""Metric samples in the text exposition format."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.functions.timegrid import check_utc

# The shape of a sample line, `name{a="x",b="y"} 42 [timestamp]`.
SAMPLE_LINE = r'^([a-zA-Z_:][a-zA-Z0-9_:]*)(\{.*\})?\s+(\S+)(?:\s+(-?\d+))?\s*$'
LABEL = r'([a-zA-Z_][a-zA-Z0-9_]*)="((?:[^"\\]|\\.)*)"'
_PLAIN_LABEL = r'[a-zA-Z_][a-zA-Z0-9_]*="(?:[^"\\]|\\.)*"'
LABELS = rf'^(?:\{{\s*(?:{_PLAIN_LABEL}\s*(?:,\s*{_PLAIN_LABEL}\s*)*,?\s*)?\}})?$'


def read_scrapes(spark: SparkSession, path: str) -> DataFrame:
    """Lines of stored scrapes, each file being one scrape at the time it was written."""
    return spark.read.text(path).select(
        F.col("_metadata.file_modification_time").alias("ts"), F.col("value").alias("line")
    )


def _unescape(text: Column) -> Column:
    """Undo escapes; cutting at double backslashes keeps them apart from the others."""
    parts = F.transform(
        F.split(text, r"\\\\"),
        lambda part: F.replace(
            F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit('\\"'), F.lit('"')
        ),
    )
    return F.array_join(parts, "\\")


def _pieces(line: str) -> Column:
    """Name, value, time and labels of a sample line; null or another number of pieces for others.

    One replacement writes all pieces with a mark between them, so the line is matched once. Lines
    that hold the mark themselves are matched piece by piece.
    """
    mark = "\x01"
    packed = F.regexp_replace(line, SAMPLE_LINE, f"$1{mark}$3{mark}$4{mark}$2")
    each = F.array(*[F.regexp_extract(line, SAMPLE_LINE, group) for group in (1, 3, 4, 2)])
    return F.when(
        F.contains(F.col(line), F.lit(mark)), F.when(F.col(line).rlike(SAMPLE_LINE), each)
    ).otherwise(F.split(packed, mark, 4))


def _samples(lines: DataFrame, line: str) -> DataFrame:
    """Add ``__sample``: whether the line is one, and its pieces; computed once per line.

    A sample's labels are well formed and differ, and its value is a number.
    """

    def fields(found: Column) -> Column:
        pieces, names = found["pieces"], found["names"]
        good = (
            (F.size(pieces) == 4)
            & pieces[3].rlike(LABELS)
            & (F.size(F.array_distinct(names)) == F.size(names))
            & pieces[1].try_cast("double").isNotNull()
        )
        return F.struct(F.coalesce(good, F.lit(False)).alias("good"), pieces.alias("pieces"), names.alias("names"))

    def with_names(pieces: Column) -> Column:
        return F.struct(pieces.alias("pieces"), F.regexp_extract_all(F.get(pieces, F.lit(3)), F.lit(LABEL), 1).alias("names"))

    once = F.transform(F.transform(F.array(_pieces(line)), with_names), fields)
    # generated columns are computed once; filters on them do not repeat the match
    return lines.select("*", F.explode(once).alias("__sample"))


def parse_samples(lines: DataFrame, line: str = "line", ts: str = "ts") -> DataFrame:
    """Replace ``line`` by ``metric``, ``labels`` and ``value``.

    A sample's own time, in milliseconds, replaces ``ts``. Comment and blank lines are
    dropped; for what else is no sample see ``malformed_samples``. Escapes in label values
    are undone.
    """
    found = _samples(lines, line)
    good, pieces = F.col("__sample.good"), F.col("__sample.pieces")
    piece = lambda n: F.get(pieces, F.lit(n))
    # Rows may be parsed before they are filtered, so a bad line must not fail.
    names = F.when(good, F.col("__sample.names"))
    values = F.transform(F.regexp_extract_all(piece(3), F.lit(LABEL), 2), _unescape)
    parsed = (
        found.where(good)
        .withColumn("metric", piece(0))
        .withColumn("labels", F.map_from_arrays(names, values))
        .withColumn("value", piece(1).try_cast("double"))
    )
    if ts in lines.columns:
        check_utc(lines)
        own = F.timestamp_millis(piece(2).try_cast("long"))
        kind = lines.schema[ts].dataType
        parsed = parsed.withColumn(ts, F.coalesce(own.cast(kind), F.col(ts)))
    return parsed.drop(line, "__sample")


def malformed_samples(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lines that are neither samples nor blank nor comments, for a table of their own."""
    silent = F.col(line).isNull() | F.col(line).rlike(r"^\s*(?:#.*)?$")
    return _samples(lines.where(~silent), line).where(~F.col("__sample.good")).drop("__sample")
