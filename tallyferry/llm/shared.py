"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as a Java character class body and as a list of characters.
BLANK = r" \t\n\x0B\f\r"
BLANK_CHARS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    ``spark.checkpoint.dir`` names it. Where it is unset, a local master gets a temporary folder
    (tests), anything else a folder below the warehouse.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if context.master.startswith("local"):
            named = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        else:
            named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named.rstrip("/")


#: Bytes of the Arrow batches that Python tasks get (Spark's own limit of 64 MB is more than a task can unpack).
BATCH_BYTES = 4 << 20


def give_back() -> None:
    """Return what the Python worker has freed to the system; workers stay alive between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not the GNU C library
        pass


def in_python(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with batches of BATCH_BYTES at most; a task that ends frees its memory.

    The session's ``spark.sql.execution.arrow.maxBytesPerBatch`` is lowered, never raised.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"([0-9]+)b?", conf.get(name))
    if now is None or int(now[1]) > BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(tidied, schema)


def free_scratch(spark: SparkSession) -> None:
    """Let Spark delete shuffles and checkpoints that no DataFrame refers to any more.

    Spark does so when the driver collects garbage, which may be long after; called between the steps
    of a job that has large ones.
    """
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def durable(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and kept in the shared folder, without lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def split_words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of ``text``; empty for a text without any."""
    trimmed = F.btrim(text, F.lit(BLANK_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{BLANK}]+"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def few(df: DataFrame, most_rows: int = 100_000) -> bool:
    """Whether ``df`` has few enough rows to be sent to every task."""
    return df.limit(most_rows + 1).count() <= most_rows


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df``, kept in the shared folder; marked for broadcast if it has few rows, else joined by shuffle."""
    df = durable(df)
    return F.broadcast(df) if few(df) else df


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def join_counted(left: DataFrame, right: DataFrame, key: str, share: int = 1000) -> DataFrame:
    """``left`` joined to ``right``, which has one row per ``key`` and in ``n`` the rows of ``left`` that have it.

    Keys with more than one row in ``share`` (fewer than ``share`` keys, whatever the input) are
    broadcast, so that their rows stay where they are; all others meet by shuffle.
    """
    right = durable(right)
    total = right.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    values = [c for c in right.columns if c not in (key, "n")]
    hot = right.where(F.col("n") > total / share).select(F.col(key).alias("__hot"), F.struct(*values).alias("__h"))
    rest = right.where(F.col("n") <= total / share).select(F.col(key).alias("__rest"), F.struct(*values).alias("__r"), F.lit(0).alias("__zero"))
    own = left.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
    # hot rows match nothing more: they are dealt out by their other columns
    plain = [F.col(f"`{c}`") for c in left.columns if c != key]
    own = own.withColumn("__salt", F.when(F.col("__hot").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(*plain), F.lit(4096)).cast("int")))
    rest = rest.withColumn("__zero", F.pmod(F.hash("__rest"), F.lit(1)))  # 0, but no constant to take out of the join
    both = own.join(rest, (F.col(key) == F.col("__rest")) & (F.col("__salt") == F.col("__zero")), "left")
    both = both.where(F.col("__hot").isNotNull() | F.col("__rest").isNotNull())
    return both.select(*[F.col(f"`{c}`") for c in left.columns], *[F.coalesce(F.col(f"__h.`{v}`"), F.col(f"__r.`{v}`")).alias(v) for v in values])
