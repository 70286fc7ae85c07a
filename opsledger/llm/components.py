"""Connected components of a table of links, by alternating stars.

Each round points every node's larger neighbours, then its smaller ones, at its
smallest neighbour, until the links form stars. The number of rounds grows with the logarithm
of the component size. Rounds are written to the shared folder, minima are
aggregated before the shuffle, and only sums of hashes reach the driver.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.functions.workspace import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, its component's smallest node, from links (``a``, ``b``).

    Nodes with links to others only; links with null, loops and repeats do no harm.
    """
    edges = stored(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        mark = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if mark == before:
            break
        before = mark
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = large.unionByName(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = stored(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .filter("u > v")
            .distinct(),
            "links",
        )
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
