"""The shared folder, cuts of lineage, and left joins whose null keys do not meet in one task."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Where it is unset a local master gets a temporary folder (tests), a cluster one below the warehouse.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        local = context.master.startswith("local")
        named = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named.rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and kept in the shared folder, without lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table of a known schema; no rows where it does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt out evenly before a step that costs much more than to move them.

    A file of few row groups is read by few tasks, however many cores there are.
    """
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def spread_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "left", by: Sequence[str] | None = None, buckets: int = 4096) -> DataFrame:
    """``left`` and ``right`` joined on one key each (of different names), both kept; how: left or full_outer.

    Rows with a null key match nothing, yet a plain outer join deals them all to one task. Here a
    second join column, 0 for every real key, deals them out by the hash of the columns ``by`` (all
    columns if not given).
    """

    def dealt(df: DataFrame, key: str, by: Sequence[str] | None) -> Column:
        plain = [F.col(f"`{n}`") for n, t in df.dtypes if "map<" not in t and "variant" not in t and (by is None or n in by)]
        # the remainder by 1 is 0, but no constant that the optimizer could take out of the join
        return F.when(F.col(f"`{key}`").isNull(), 1 + F.pmod(F.xxhash64(*plain), F.lit(buckets)).cast("int")).otherwise(F.pmod(F.hash(F.col(f"`{key}`")), F.lit(1)))

    if how == "left":
        right = right.where(F.col(f"`{right_key}`").isNotNull())
    a, b = left.withColumn("__sj_l", dealt(left, left_key, by)), right.withColumn("__sj_r", dealt(right, right_key, None))
    return a.join(b, (F.col(f"`{left_key}`") == F.col(f"`{right_key}`")) & (F.col("__sj_l") == F.col("__sj_r")), how).drop("__sj_l", "__sj_r")
