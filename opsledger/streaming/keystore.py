"""Keys a stream has seen, for duplicate removal without a time limit.

A micro-batch asks which of its keys came in an earlier one. Keys lie in tiers of parts (``Parts``), each
cut into folders by ``scope`` and by hash. Beside them each part has a Bloom filter in blocks: a
key sets ``PROBES`` bits in one block of 32,768, so a lookup is an equality join with the
blocks, tested by built-in expressions. Only folders that some key may be in are opened, and
only keys that may be in them are joined; a filter errs on that side alone, so the answer is exact.

The number of parts, and so of filters to ask, grows with the logarithm of the micro-batches. Filters hold
``BITS`` bits a key. With a scope, such as the date of an event's own time, only the filters of the
scopes in the micro-batch are read.

Keys carry the micro-batch that brought them: a replayed one is not taken for its own copy.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.functions.joins import union_all
from opsledger.functions.workspace import stored
from opsledger.streaming.parts import FAN_IN, Parts

BUCKETS = 16
BITS = 16
PROBES = 6
_BLOCK_BITS = 32_768


def _hashes() -> list[Column]:
    return [F.xxhash64("key").alias("h"), F.xxhash64("key", F.lit(1)).alias("h1"), F.xxhash64("key", F.lit(2)).alias("h2")]


def _probe(place: int) -> Column:
    """Bit number ``place`` of a key in its block."""
    return F.pmod(F.pmod(F.col("h1"), F.lit(_BLOCK_BITS)) + place * F.pmod(F.col("h2"), F.lit(_BLOCK_BITS)), F.lit(_BLOCK_BITS))


def _block(blocks: Column) -> Column:
    return F.pmod(F.shiftright("h", 16), blocks)


class KeyStore(Parts):
    """The keys of a stream with this ``checkpoint``, by ``key`` and ``scope`` (both texts)."""

    def __init__(self, spark: SparkSession, path: str, checkpoint: str, buckets: int = BUCKETS, fan_in: int = FAN_IN):
        super().__init__(spark, path, checkpoint, None, fan_in)
        self.buckets = buckets

    def read(self, parts: list[dict] | None = None) -> DataFrame:
        parts = self.live() if parts is None else parts
        if not parts:
            raise FileNotFoundError(f"no key is stored under {self.folder}")
        folders = [f"{self.folder}/{p['name']}/keys" for p in parts]
        return union_all([self.spark.read.schema(_KEYS).parquet(f) for f in folders])

    def write(self, rows: DataFrame, folder: str) -> dict:
        keys = rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int"))
        keys.hint("rebalance", "scope", "bucket").write.partitionBy("scope", "bucket").mode("overwrite").parquet(f"{folder}/keys")
        written = self.spark.read.schema(_KEYS).parquet(f"{folder}/keys")
        largest = written.groupBy("scope", "bucket").count().agg(F.max("count")).first()[0] or 0
        blocks = max(1, -(-largest * BITS // _BLOCK_BITS))
        bits = written.select("scope", "bucket", *_hashes()).select(
            "scope",
            "bucket",
            _block(F.lit(blocks)).alias("block"),
            F.explode(F.array(*[_probe(i) for i in range(PROBES)])).alias("bit"),
        )
        filters = bits.groupBy("scope", "bucket", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))
        filters.write.partitionBy("scope").mode("overwrite").parquet(f"{folder}/filters")
        return {"blocks": blocks}

    def maybe(self, keys: DataFrame) -> DataFrame:
        """(key, scope, bucket, part): the parts whose filters do not rule a key out."""
        parts = self.live()
        bucket = F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int").alias("bucket")
        places = [
            F.struct(F.lit(i).alias("part"), F.lit(p["note"]["blocks"]).cast("long").alias("blocks"))
            for i, p in enumerate(parts)
        ]
        asked = keys.select("key", "scope", bucket, *_hashes(), F.inline(F.array(*places)))
        asked = asked.withColumn("block", _block(F.col("blocks")))
        scopes = [r["scope"] for r in keys.select("scope").distinct().collect()]
        filters = union_all([
            self.spark.read.schema(_FILTERS).parquet(f"{self.folder}/{p['name']}/filters").withColumn("part", F.lit(i))
            for i, p in enumerate(parts)
        ]).where(F.col("scope").isin(scopes))
        joined = asked.join(filters, ["part", "scope", "bucket", "block"])
        held = reduce(lambda a, b: a & b, [_is_set(_probe(i)) for i in range(PROBES)])
        return joined.where(held).select("key", "scope", "bucket", "part")

    def known(self, keys: DataFrame, before: int) -> DataFrame:
        """Those of the distinct (key, scope) that a micro-batch earlier than ``before`` has brought."""
        parts = self.live()
        if not parts:
            return keys.limit(0)
        hits = stored(self.maybe(keys), "dedup-maybe")
        # at most one row per folder: scopes of the micro-batch x buckets x parts
        folders = {}
        for r in hits.select("part", "scope", "bucket").distinct().collect():
            base = f"{self.folder}/{parts[r['part']]['name']}/keys"
            folders.setdefault(base, []).append(f"{base}/scope={_escaped(r['scope'])}/bucket={r['bucket']}")
        self.opened = sum(map(len, folders.values()))
        if not folders:
            return keys.limit(0)
        read = self.spark.read.schema(_KEYS)
        held = union_all([read.option("basePath", base).parquet(*paths) for base, paths in folders.items()])
        old = held.where(F.col("batch") < before).select("key", "scope")
        return hits.select("key", "scope").distinct().join(old, ["key", "scope"], "left_semi")


_KEYS = "key string, batch long, scope string, bucket int"
_FILTERS = "bucket int, block long, bits binary, scope string"


def _escaped(scope: str) -> str:
    if any(not (c.isalnum() or c in "-_.") for c in scope):
        raise ValueError(f"a scope names a folder: {scope!r}")
    return scope


def _is_set(bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1
