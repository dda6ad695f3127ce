"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import compact


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that is not the smallest of its component; ``edges`` has bigint a, b.

    Each round replaces a node's links by links to the smallest node it sees. Rounds are stored; the driver sees a
    count and a checksum. The number of rounds grows with the logarithm of a component's size.
    """
    links = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = compact(edges.where("a <> b").select(*links).distinct())
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        rest = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = compact(rest.unionByName(least.withColumnRenamed("m", "b")).distinct())
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
