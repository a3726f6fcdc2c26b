"""Sharding by size: longest-processing-time scheduling of groups that must stay together.

Rows of one text form a group. Group sizes are summed with map-side partial sums, so a text that
fills a third of the table is one number. Groups over ``total / (shards * heavy_per_shard)`` bytes
(at most ``shards * heavy_per_shard`` of them, whatever the input) are scheduled one by one; the
rest are pooled by hash into ``bundles`` items. That bounded list, largest first, goes through a
heap of shard loads on the driver. Rows find their shard by their own group hash: no join on text.

Slots are dense within a shard: rows are numbered inside ``salts`` slices of a shard and moved
behind the slices before; no task holds a shard. Rows are ordered by id and text hash, so a task that
is run again gives the same slots (rows alike in both are alike in all).
A null text has no bytes and belongs with the empty text; repeated rows get slots of their own; a
null id is an ordinary row; an empty table gives no rows; extra columns are ignored. Groups of equal
size are scheduled in the order of their keys, and equal loads take the lower shard; texts of any
length count by their bytes alone.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyferry.llm.shared import durable, text_or_empty

ROW_BYTES = 16


def lpt(items: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """key -> shard for (key, size) items: largest first, each to the least loaded shard."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for key, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        out[key] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def assign_shards(docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text: str = "text", bundles: int = 16384, heavy_per_shard: int = 64, salts: int = 64) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per row of ``docs``."""
    spark = docs.sparkSession
    t = text_or_empty(text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(t) + ROW_BYTES).cast("long").alias("size"), F.crc32(t).alias("text_crc32"), F.xxhash64(t).alias("grp"))
    rows = rows.withColumn("bundle", F.pmod(F.hash("grp"), F.lit(bundles)))
    groups = durable(rows.groupBy("grp", "bundle").agg(F.sum("size").alias("bytes")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    heavy = F.col("bytes") > total / (shards * heavy_per_shard)
    alone = [(r["grp"], r["bytes"]) for r in groups.where(heavy).select("grp", "bytes").collect()]  # fewer than shards * heavy_per_shard rows
    pooled = [(r["bundle"], r["bytes"]) for r in groups.where(~heavy).groupBy("bundle").agg(F.sum("bytes").alias("bytes")).collect()]  # at most `bundles` rows
    plan = lpt([((0, k), v) for k, v in alone] + [((1, k), v) for k, v in pooled], shards)
    of_group = spark.createDataFrame([(k, s) for (kind, k), s in plan.items() if kind == 0], "grp long, own_shard int")
    of_bundle = spark.createDataFrame([(k, s) for (kind, k), s in plan.items() if kind == 1], "bundle int, pool_shard int")
    placed = rows.join(F.broadcast(of_group), "grp", "left").join(F.broadcast(of_bundle), "bundle", "left")
    placed = placed.select("doc_id", "size", "text_crc32", "grp", F.coalesce("own_shard", "pool_shard").alias("shard"), F.pmod(F.hash("doc_id", "text_crc32"), F.lit(salts)).alias("salt"))
    counts = placed.groupBy("shard", "salt").agg(F.count(F.lit(1)).alias("n"))  # at most shards * salts rows
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("salt")) - F.col("n")
    offsets = counts.select("shard", "salt", before.alias("before"))
    within = F.row_number().over(Window.partitionBy("shard", "salt").orderBy("doc_id", "grp")) - 1
    out = placed.withColumn("within", within).join(F.broadcast(offsets), ["shard", "salt"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("within")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
