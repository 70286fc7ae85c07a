"""Lookup joins that stay balanced when one key holds much of the big side."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 32 * 1024 * 1024
SALTS = 32
_SALT = "__salt"


def fits_broadcast(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """Measure whether ``df`` is small: counted where its rows are, one row per task."""
    size = df.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes"),
    ).first()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def row_salt(df: DataFrame, salts: int = SALTS):
    """Salt that a retried task reproduces, whatever order its rows arrive in.

    The partition id spreads rows that are equal in every column.
    """
    hashable = [f.name for f in df.schema if _hashable(f.dataType)]
    return F.pmod(F.xxhash64(*hashable) + F.spark_partition_id(), F.lit(salts)).cast("int")


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys in which null equals null; the keys come from the left."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys], F.lit(True))
    return left.join(renamed, same, how).drop(*[f"__r_{k}" for k in keys])


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    *,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
    salts: int = SALTS,
    is_small: bool | None = None,
    nulls_match: bool = False,
) -> DataFrame:
    """Join ``big`` to a dimension: broadcast if measured small, salted otherwise.

    Null keys match nothing, or each other with ``nulls_match``.

    The measurement runs a job over ``small``; a caller that joins the same
    dimension many times passes its earlier result as ``is_small``.

    The salted form replicates the dimension ``salts`` times and spreads each
    key of ``big`` over as many tasks. ``how`` must keep the left side whole
    (inner, left, left_semi, left_anti), so that replicas on the right can
    neither repeat nor lose a row.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"lookup_join cannot salt a {how} join")
    if is_small is None:
        is_small = fits_broadcast(small, max_rows, max_bytes)
    join = join_same if nulls_match else DataFrame.join
    if is_small:
        return join(big, F.broadcast(small), on, how)
    salted = big.withColumn(_SALT, row_salt(big, salts))
    copies = small.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # Spark's estimate does not count the copies, and would broadcast all of them through the driver
    copies = copies.hint("merge")
    return join(salted, copies, [*on, _SALT], how).drop(_SALT)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _hashable(data_type: T.DataType) -> bool:
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return False
    if isinstance(data_type, T.ArrayType):
        return _hashable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_hashable(f.dataType) for f in data_type)
    return True
