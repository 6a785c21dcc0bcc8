"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.session import written


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, component): every node of an edge with the smallest node it is joined to.

    Each round links the neighbours of a node to the smallest of them. Rounds are
    written to the shared folder; only a count and a checksum reach the driver. Nulls
    and self loops are ignored. Minima are combined before the shuffle, and the join
    back meets one row per node, so a node with very many links is no hot group.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    links = written(links, "links")
    before = _fingerprint(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        links = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        after = _fingerprint(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
