"""Loaders and writers by name: a source is a DataFrame, a sink takes one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Table:
    """Where rows are: ``kind`` names a loader and writer, ``where`` filters, ``options`` are the reader's own."""

    kind: str
    path: str
    where: str | None = None
    schema: str | None = None
    options: dict[str, str] = field(default_factory=dict)


LOADERS: dict[str, Callable[[SparkSession, Table], DataFrame]] = {}
WRITERS: dict[str, Callable[[DataFrame, Table, str], None]] = {}


def loader(kind: str) -> Callable:
    """Register ``fn(spark, table) -> DataFrame``."""
    return lambda fn: LOADERS.setdefault(kind, fn)


def writer(kind: str) -> Callable:
    """Register ``fn(rows, table, mode)``."""
    return lambda fn: WRITERS.setdefault(kind, fn)


def _files(kind: str) -> None:
    def read(spark: SparkSession, t: Table) -> DataFrame:
        reader = spark.read.options(**t.options)
        return (reader.schema(t.schema) if t.schema else reader).format(kind).load(t.path)

    loader(kind)(read)
    writer(kind)(lambda rows, t, mode: rows.write.mode(mode).options(**t.options).format(kind).save(t.path))


for _kind in ("parquet", "json", "csv", "orc"):
    _files(_kind)


@loader("jdbc")
def _jdbc(spark: SparkSession, t: Table) -> DataFrame:
    """``path`` is the address; options name the table and, for a parallel read, partitionColumn and its bounds."""
    return spark.read.format("jdbc").option("url", t.path).options(**{"fetchsize": "10000"} | t.options).load()


@writer("jdbc")
def _to_jdbc(rows: DataFrame, t: Table, mode: str) -> None:
    rows.write.format("jdbc").mode(mode).option("url", t.path).options(**t.options).save()


def load(spark: SparkSession, t: Table, after_key: tuple[str, object] | None = None) -> DataFrame:
    """The table's rows; ``after_key`` (column, last value) goes on behind a key. Filters reach the scan."""
    if t.kind not in LOADERS:
        raise ValueError(f"unknown source kind {t.kind!r}: {sorted(LOADERS)}")
    rows = LOADERS[t.kind](spark, t)
    rows = rows.where(t.where) if t.where else rows
    return rows.where(F.col(after_key[0]) > F.lit(after_key[1])) if after_key else rows


def save(rows: DataFrame, t: Table, mode: str = "errorifexists") -> None:
    if t.kind not in WRITERS:
        raise ValueError(f"unknown sink kind {t.kind!r}: {sorted(WRITERS)}")
    WRITERS[t.kind](rows, t, mode)
