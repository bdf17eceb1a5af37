"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marginfold.sources.scratch import discard, scratch_folder, written


def _digest(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("high", "low")).alias("mix"),
        F.sum(F.xxhash64("low", "high").cast("decimal(38,0)")).alias("total"),
    ).first()
    return tuple(row)


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    """(node, other) to (node, least): the least of a node and its neighbours."""
    return pairs.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("least"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b), root being the least node reachable.

    Large-star and small-star rounds alternate until the links no longer change; they then form one
    star per component around its root, after a number of rounds logarithmic in the longest path.
    Each round joins the links with one row per node, so a node with many links is a skewed join key
    that adaptive execution splits; rounds are written to the shared folder. Self links and nulls
    are ignored: a node without other links is not in the result.
    """
    spark = links.sparkSession
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")
    ).distinct()
    path = scratch_folder(spark)
    edges = written(edges, path)
    digest = _digest(edges)
    while digest[0]:
        both = edges.select(F.col("high").alias("node"), F.col("low").alias("other")).union(
            edges.select(F.col("low").alias("node"), F.col("high").alias("other"))
        )
        large = (
            both.where("other > node")
            .join(_least_neighbour(both), "node")
            .select(F.col("other").alias("node"), F.col("least").alias("other"))
            .distinct()
        )
        large_path = scratch_folder(spark)
        large = written(large, large_path)
        least = _least_neighbour(large)
        small = (
            large.join(least, "node")
            .select(F.col("other").alias("high"), F.col("least").alias("low"))
            .union(least.select(F.col("node").alias("high"), F.col("least").alias("low")))
            .where("high <> low")
            .distinct()
        )
        next_path = scratch_folder(spark)
        edges = written(small, next_path)
        discard(spark, large_path)
        discard(spark, path)
        path, before, digest = next_path, digest, _digest(edges)
        if digest == before:
            break
    roots = edges.select(F.col("low").alias("node")).distinct()
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
