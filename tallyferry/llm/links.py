"""Posting lists of entries, and components of links between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyferry.llm.shared import durable


def posting_lists(posted: DataFrame, block: int) -> DataFrame:
    """Posting lists of two entries or more, cut into pairs of blocks, each pair sorted in one task."""
    # lists of one entry have no pairs
    sizes = posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    cuts = F.ceil(F.col("n") / block).cast("int")
    lists = posted.join(sizes, "key").withColumn("cuts", cuts).withColumn("own", F.pmod(F.hash("node"), F.col("cuts")))
    spread = F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda o: F.struct(F.least(o, F.col("own")).alias("a"), F.greatest(o, F.col("own")).alias("b")))
    rest = [c for c in posted.columns if c not in ("key", "node")]
    lists = lists.select("key", "node", *rest, F.inline(spread))
    return lists.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b").select("key", "a", "b", "node", *rest)


def components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """node, root for every node of ``links`` (u < v): root is the smallest node it reaches.

    Alternates two steps until nothing changes: larger neighbours of a node are hung below its
    smallest neighbour, then smaller ones are. Rounds grow with the logarithm of the longest chain;
    each is kept in the shared folder, and only two numbers of a round reach the driver.
    """
    edges = durable(links)
    sign = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = sign(edges)
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("m").alias("u"), "v").where("u < v").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        hung = large.join(low, "v")
        small = hung.select(F.col("m").alias("u"), F.col("u").alias("v")).where("u < v").unionByName(hung.select(F.col("m").alias("u"), "v"))
        edges = durable(small.distinct())
        now = sign(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.groupBy("v").agg(F.min("u").alias("root")).withColumnRenamed("v", "node")
