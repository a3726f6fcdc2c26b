"""Structured Streaming: incremental apply, and records that a stream has not shown before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyferry.functions.transforms import shown
from tallyferry.operators.migrate import Store, apply_batch
from tallyferry.plans.mapping import Entity, fingerprint


def start_apply(store: Store, entity: Entity, stream: DataFrame, run_id: str, checkpoint: str, available_now: bool = True, **settings) -> StreamingQuery:
    """Apply a stream of source rows batch by batch.

    Batches are named by (run, entity, batch id): one that is replayed after a crash finds its commit
    and does nothing, and rows that the id map knows are not written twice. The run is refused if it
    was started with another mapping. ``query.stop()`` ends it between batches; the checkpoint folder
    is where the next start goes on.
    """
    spark = stream.sparkSession
    mapping = fingerprint([entity])
    run = store.runs(spark).where(F.col("run_id") == run_id).first()
    if run is not None and run["mapping"] != mapping:
        raise ValueError(f"run {run_id} used another mapping ({run['mapping']}, now {mapping}): start a new run")
    store.set_run(spark, run_id, "apply", mapping, "running")

    def one(rows: DataFrame, batch_id: int) -> None:
        apply_batch(store, entity, rows, run_id, batch_id, **settings)

    writer = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def drain(store: Store, entity: Entity, stream: DataFrame, run_id: str, checkpoint: str, **settings) -> None:
    """Apply what the stream's source holds now, then stop."""
    start_apply(store, entity, stream, run_id, checkpoint, **settings).awaitTermination()
    store.set_run(stream.sparkSession, run_id, "apply", fingerprint([entity]), "completed")


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    """Parquet files of a folder as a stream, in bounded batches."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def fresh_records(stream: DataFrame, time: str, content: list[str], horizon: str | None = "1 day") -> DataFrame:
    """The first record of each content; with a ``horizon`` the watermark bounds what is remembered.

    Without one a content is remembered for good: the stream's state holds 128 bits for each content,
    spread by them, and lives in the checkpoint with the offsets, so a restart forgets nothing. Let it
    lie on disk for large streams (:func:`state_on_disk`).
    """
    types = dict(stream.dtypes)
    texts = [F.coalesce(shown(F.col(c), types[c]), F.lit("\0")) for c in content]
    marked = stream.withColumn("__sig", F.xxhash64(*texts)).withColumn("__sig2", F.xxhash64(F.lit("second"), *texts))
    if horizon is None:
        return marked.dropDuplicates(["__sig", "__sig2"]).drop("__sig", "__sig2")
    return marked.withWatermark(time, horizon).dropDuplicatesWithinWatermark(["__sig", "__sig2"]).drop("__sig", "__sig2")


def state_on_disk(spark: SparkSession) -> None:
    """Keep the state of streams that this session starts from now on in RocksDB, not in the executors' heaps."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
