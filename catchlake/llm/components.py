"""Connected components by large-star and small-star steps, each an aggregation and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchlake.session import materialize


def _fingerprint(edges: DataFrame):
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(links: DataFrame) -> DataFrame:
    """node and component, the least node that can be reached, for every node of links (a, b).

    A node with very many links is met by sums with map-side parts and by joins that adaptive execution can split; nothing is
    gathered by node. Each step is written to the shared folder, so the lineage stays short. Steps grow with the logarithm of
    the longest path. Links of a node to itself, repeated links and links with a null end make no component; nodes without a link are not
    among the rows.
    """
    pair = F.struct(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = materialize(links.filter(F.col("a") != F.col("b")).select(pair.alias("e")).select("e.*").distinct(), "edges")
    before = None
    while (now := _fingerprint(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).withColumn("m", F.least("m", "w"))
        # large star: every larger neighbour is linked to the least of the neighbourhood
        large = both.filter(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "large-star")
        # small star: the smaller neighbours, and the node itself, are linked to their least
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        small = large.join(least, F.col("u") == F.col("w"))
        small = small.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("w").alias("u"), F.col("m").alias("v")))
        edges = materialize(small.distinct(), "small-star")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
