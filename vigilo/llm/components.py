"""Connected components by alternating star contractions, as DataFrame joins.

Each round replaces a node's links by links to its smallest neighbour (large
star: neighbours above the node; small star: those below), until every link
goes from a node to the smallest node of its component.  Links stay in tables
on the executors; a round is written under ``spark.checkpoint.dir`` so lineage
does not grow.  Minima are pre-aggregated, and no list of neighbours is built,
so a node with very many links is just many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vigilo.llm.common import stored


def _state(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (u, v); a component is
    named by its smallest node."""
    links = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "links")
    before = None
    while (now := _state(links)) != before:
        before = now
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        links = stored(down.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct(), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
