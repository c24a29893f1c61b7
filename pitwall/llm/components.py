"""Connected components of links between long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pitwall.sources.scratch import remove_path, scratch_path


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns (node, root): each id that occurs in the columns a and b of `edges`, with the smallest id of its component.

    Alternates large and small star contractions: neighbours of a node are linked to its smallest neighbour instead, until every link leads
    straight to a root. Only minima per node are grouped, never neighbour lists. Each round is written to the shared folder, and the one
    before it is removed.
    """
    spark = edges.sparkSession
    links = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).filter("u <> v").distinct()
    path = scratch_path(spark, "links")
    links.write.parquet(path)
    links, before = spark.read.schema(links.schema).parquet(path), None
    while True:
        both = links.union(links.select("u", "v").toDF("v", "u"))
        low = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        # large star: every larger neighbour of a node is linked to the least of the node's neighbourhood
        large = both.filter("u > v").join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).union(
            low.filter("v <> m").select("v", F.col("m").alias("u"))).filter("u <> v").distinct()
        # small star: every smaller neighbour of a node, and the node, is linked to the least of them
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").filter("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u")).union(least.select("v", F.col("m").alias("u"))).distinct()
        new_path = scratch_path(spark, "links")
        small.write.parquet(new_path)
        links = spark.read.schema(small.schema).parquet(new_path)
        remove_path(spark, path)
        path = new_path
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        if now == before:
            return _with_roots(links)
        before = now


def _with_roots(links: DataFrame) -> DataFrame:
    return links.select(F.col("v").alias("node"), F.col("u").alias("root")).union(links.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
