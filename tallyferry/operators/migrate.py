"""Applying a mapping: versioned writes with journal and id map, resume, verify and rollback.

A :class:`Store` is a folder of Parquet tables. An entity is applied in ranges of its source key,
each as long as all before it; every batch is one version: its errors, its journal, the rows it changes and its ids are written to
folders of that version, and last one row of ``commits``. What has no such row does not count: a
batch that died is written again over its own folders, one that is committed is skipped. A commit
names its last source key, the greatest target key, the columns so far and the buckets written. The
target is the last row of each key over the versions since the last full one; after
``compact_after`` versions :func:`compact` writes a full one.

Rows and ids lie in buckets by a hash of their key's block (neighbouring whole numbers share a
block), so a batch reads only the buckets that its own keys fall in.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyferry.operators import writes as W
from tallyferry.operators.storage import durable, read_or_empty, spread_join
from tallyferry.plans.mapping import HIDDEN, Entity, build_rows, fingerprint, in_order, rejected, structural_problems, type_problems

RUNS = "run_id string, mode string, mapping string, status string, at timestamp_ntz, seq long"
COMMITS = "entity string, run_id string, batch_id long, version int, full boolean, inserted long, updated long, skipped long, failed long, known long"
PLACES = "last_key string, done boolean, max_key long, fields string, n_buckets int, rows_in array<int>, ids_in array<int>"
IDS = "source_id string, target_id string, run_id string"
ERRORS = "source_id string, stage string, message string, run_id string, version int, entity string"
JOURNAL = "target_id string, action string, run_id string"
COUNTS = ("inserted", "updated", "skipped", "failed", "known")


class RowsRejected(ValueError):
    """A row was rejected under ``on_error="abort"``."""


def ddl(schema: StructType | str) -> str:
    return schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def bucket_of(key: Column, n: int) -> Column:
    """The bucket of a key. Whole numbers share one with the others of their block of 1,024."""
    text = key.cast("string")
    number = text.try_cast("long")
    return F.pmod(F.xxhash64(F.coalesce(F.shiftright(number, 10).cast("string"), text)), F.lit(n)).cast("int")


@dataclass(frozen=True)
class Place:
    """Where an entity's commits stand."""

    commits: tuple[Row, ...]

    @property
    def last(self) -> int:
        return max((c["version"] for c in self.commits), default=0)

    @property
    def live(self) -> list[Row]:
        """The last full version and what came after it."""
        full = max((c["version"] for c in self.commits if c["full"]), default=0)
        return [c for c in self.commits if c["version"] >= full]

    @property
    def max_key(self) -> int:
        return max((c["max_key"] or 0 for c in self.commits), default=0)

    @property
    def fields(self) -> str | None:
        known = [c for c in self.commits if c["fields"]]
        return max(known, key=lambda c: c["version"])["fields"] if known else None

    def after(self, *rows: Row) -> Place:
        return Place((*self.commits, *rows))

    def of_run(self, run_id: str) -> list[Row]:
        return [c for c in self.commits if c["run_id"] == run_id]


@dataclass(frozen=True)
class Store:
    root: str
    n_buckets: int = 64
    compact_after: int = 16

    def at(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    def runs(self, spark: SparkSession) -> DataFrame:
        """The last state of every run."""
        return W.last_by_key(read_or_empty(spark, self.at("runs"), RUNS), "run_id", "seq")

    def set_run(self, spark: SparkSession, run_id: str, mode: str, mapping: str, status: str) -> None:
        row = spark.createDataFrame([(run_id, mode, mapping, status)], "run_id string, mode string, mapping string, status string")
        row.withColumn("at", F.current_timestamp().cast("timestamp_ntz")).withColumn("seq", F.lit(time.time_ns()).cast("long")).coalesce(1).write.mode("append").parquet(self.at("runs"))

    def commits(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, self.at("commits"), f"{COMMITS}, {PLACES}")

    def commit(self, spark: SparkSession, row: dict) -> Row:
        names = [c.split()[0] for c in f"{COMMITS}, {PLACES}".split(", ")]
        full = Row(**{n: row.get(n, 0 if n in COUNTS else None) for n in names})
        spark.createDataFrame([tuple(full)], f"{COMMITS}, {PLACES}").coalesce(1).write.mode("append").parquet(self.at("commits"))
        return full

    def place(self, spark: SparkSession, entity: str) -> Place:
        """One row for each batch of the entity so far."""
        return Place(tuple(self.commits(spark).where(F.col("entity") == entity).collect()))

    def versions(self, spark: SparkSession, entity: str) -> tuple[int, int]:
        """(the last full version, the last version); 0 for none."""
        place = self.place(spark, entity)
        return max((c["version"] for c in place.commits if c["full"]), default=0), place.last

    def _read(self, spark: SparkSession, table: str, entity: str, commits: Collection[Row], schema: str, buckets: Collection[int] | None) -> DataFrame:
        """Rows of some versions with ``version``; of ``buckets`` alone where a version's are known."""
        base, column = self.at(table, f"entity={entity}"), f"{table}_in"
        read = spark.read.option("basePath", base)
        placed = [c for c in commits if c[column] is not None]
        n = {c["n_buckets"] for c in placed}
        if buckets is not None and n <= {self.n_buckets}:
            # a version of which all is wanted is named as a whole, as many folders take a job to list
            split = lambda c: [""] if set(c[column]) <= set(buckets) else [f"/bucket={k}" for k in c[column] if k in buckets]
            paths = [f"{base}/version={c['version']}{at}" for c in placed if c[column] for at in split(c)]
        else:
            paths = [f"{base}/version={c['version']}" for c in placed if c[column]]
        out = read.schema(f"{schema}, version int, bucket int").parquet(*paths).drop("bucket") if paths else spark.createDataFrame([], f"{schema}, version int")
        # versions of folders without buckets are read whole
        for c in commits:
            if c[column] is None:
                out = out.unionByName(read_or_empty(spark, f"{base}/version={c['version']}", schema).withColumn("version", F.lit(c["version"])))
        return out

    def target(self, spark: SparkSession, entity: Entity, schema: StructType | str | None = None, buckets: Collection[int] | None = None, place: Place | None = None) -> DataFrame:
        """The entity's current rows (``schema``: other columns than those stored); of some buckets only, if given."""
        place = place or self.place(spark, entity.name)
        fields = ddl(schema) if schema is not None else place.fields
        if fields is None:
            raise ValueError(f"{entity.name}: nothing is stored yet")
        rows = self._read(spark, "rows", entity.name, place.live, f"{fields}, __deleted boolean", buckets)
        return W.last_by_key(rows, entity.target_key, "version").where(~F.col("__deleted")).drop("__deleted", "version")

    def ids(self, spark: SparkSession, entity: str, buckets: Collection[int] | None = None, place: Place | None = None) -> DataFrame:
        """entity, source_id, target_id: the last id of each source row, without runs that were rolled back."""
        gone = self.runs(spark).where("status = 'rolled_back'").select("run_id")
        commits = [c for c in (place or self.place(spark, entity)).commits if c["ids_in"]]
        ids = self._read(spark, "ids", entity, commits, IDS, buckets).join(F.broadcast(gone), "run_id", "left_anti")
        return W.last_by_key(ids, "source_id", "version").select(F.lit(entity).alias("entity"), "source_id", "target_id")

    def id_map(self, spark: SparkSession, entities: Collection[str] | None = None) -> DataFrame:
        """The ids of all entities, or of those given."""
        if entities is None:
            entities = [r["entity"] for r in self.commits(spark).select("entity").distinct().collect()]  # one row per entity
        out = spark.createDataFrame([], "entity string, source_id string, target_id string")
        for e in sorted(entities):
            out = out.unionByName(self.ids(spark, e))
        return out

    def errors(self, spark: SparkSession) -> DataFrame:
        """Rejected rows of committed versions."""
        last = self.commits(spark).groupBy("entity").agg(F.max("version").alias("__last"))  # one row per entity
        return read_or_empty(spark, self.at("errors"), ERRORS).join(F.broadcast(last), "entity").where(F.col("version") <= F.col("__last")).drop("__last")

    def put(self, df: DataFrame, table: str, entity: str, version: int, key: str | None = None) -> None:
        """Write one table of a version; with ``key`` in buckets (large ones in several files)."""
        to = self.at(table, f"entity={entity}", f"version={version}")
        if key is None:
            df.write.mode("overwrite").parquet(to)
        else:
            df.withColumn("bucket", bucket_of(F.col(key), self.n_buckets)).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(to)


def _past(rows: DataFrame, key: str, after: object, upto: object = None, nulls: bool = False) -> DataFrame:
    """Rows behind one key and up to another; rows without a key come first."""
    kind = rows.schema[key].dataType
    test = F.lit(True)
    if after is not None:
        test = F.col(key) > F.lit(after).cast(kind)
    if upto is not None:
        upper = F.col(key) <= F.lit(upto).cast(kind)
        test = test & (upper | F.col(key).isNull() if nulls else upper)
    return rows.where(test)


#: Into how many parts of equal size the keys are dealt at most, to be put together as ranges.
PARTS = 256


def key_ranges(rows: DataFrame, key: str, batch_rows: int) -> list[object]:
    """Upper keys of ranges; the last has none. Equal keys share a range.

    The first range has about ``batch_rows`` rows (one in ``PARTS`` at least), each further one as many as
    all before it. What a batch costs besides its rows, and a look at the whole target, is so paid for
    a number of times that grows with the logarithm of the rows.
    """
    n = min(-(-rows.count() // batch_rows), PARTS)
    if n <= 1:
        return [None]
    dealt = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("k")).repartitionByRange(n, "k")
    tops = [r["k"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.max("k").alias("k")).orderBy("k").collect()]  # at most PARTS rows
    return [*[tops[(1 << k) - 1] for k in range(max(len(tops) - 1, 0).bit_length())], None]


def _limited(entity: Entity, rows: DataFrame, limit: int, after_key: object) -> tuple[DataFrame, object, bool]:
    """The first ``limit`` rows by key, the key behind which the rest begins, and whether there is a rest."""
    key = entity.source_key
    part = durable(rows.orderBy(key, F.col(entity.map_key).cast("string")).limit(limit))
    seen = part.agg(F.max(key).alias("top"), F.count(F.lit(1)).alias("n")).first()
    if seen["n"] < limit:
        return part, seen["top"], False
    same = F.col(key) == F.lit(seen["top"])
    if rows.where(same).count() > part.where(same).count():  # the cut goes through equal keys: they are read again
        before = part.where(~same).agg(F.max(key)).first()[0]
        return part, after_key if before is None else before, True
    return part, seen["top"], rows.where(F.col(key) > F.lit(seen["top"])).limit(1).count() > 0


def _winners(rows: DataFrame, key: str, conflict: str) -> DataFrame:
    """``rows`` with __first: of rows of one batch with equal keys the first counts, the last under ``update``."""
    place = F.struct("__order", "__key")
    best = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__wk")).agg((F.max if conflict == "update" else F.min)(place).alias("__w"))
    return spread_join(rows, best, key, "__wk", by=["__key"]).withColumn("__first", F.col("__w").isNull() | (F.col("__w") == place)).drop("__wk", "__w")


def check_structure(store: Store, entity: Entity, source: DataFrame, grow: bool = False, place: Place | None = None) -> None:
    """Refuse a mapping that the source or the stored target cannot take, before any row is read.

    With ``grow`` new target columns are added, if their names are plain identifiers.
    """
    spark = source.sparkSession
    place = place or store.place(spark, entity.name)
    target = spark.createDataFrame([], place.fields) if place.fields else None
    problems = structural_problems(entity, source, None if grow else target)
    problems += type_problems(entity, source, target)
    if problems:
        raise ValueError(f"{entity.name}: {'; '.join(problems)}")


def _new_rows(built: DataFrame, ids: DataFrame | None) -> DataFrame:
    """``built`` with __known: rows that the id map has, and all but the first of one source id in this batch."""
    built = durable(built.withColumn("__row", F.monotonically_increasing_id()))
    place = F.struct("__order", "__row")
    marks = built.select(F.col("__key").alias("__fk"), place.alias("__p"), F.lit(False).alias("__k"))
    if ids is not None:
        marks = marks.unionByName(ids.select(F.col("source_id").alias("__fk"), F.lit(None).cast(marks.schema["__p"].dataType).alias("__p"), F.lit(True).alias("__k")))
    # the first place of a key in the batch and whether the map has it meet the rows in one join
    seen = marks.groupBy("__fk").agg(F.min("__p").alias("__f"), F.max("__k").alias("__m"))
    rows = spread_join(built, seen, "__key", "__fk", by=["__row"])
    known = F.coalesce("__m", F.lit(False)) | F.coalesce(F.col("__f") != place, F.lit(False))
    return rows.withColumn("__known", known).drop("__fk", "__f", "__m", "__row")


def apply_batch(store: Store, entity: Entity, source: DataFrame, run_id: str, batch_id: int = 0, on_error: str = "record", limit: int = 0, after_key: object = None, run_time: str | None = None, grow: bool = False) -> dict[str, int]:
    """Write one batch of source rows; the counts by outcome. A batch that is committed does nothing.

    The batch is the rows behind ``after_key``, the first ``limit`` of them. Rows that break a
    constraint of the entity are errors of stage ``write``; the others are written.
    """
    place = store.place(source.sparkSession, entity.name)
    for c in place.of_run(run_id):
        if c["batch_id"] == batch_id:
            return {n: c[n] for n in COUNTS}
    check_structure(store, entity, source, grow, place)
    row = _write_batch(store, entity, source, run_id, place, batch_id, on_error, limit, after_key, run_time)
    return {n: row[n] for n in COUNTS}


def _write_batch(
    store: Store, entity: Entity, source: DataFrame, run_id: str, place: Place, batch_id: int, on_error: str = "record", limit: int = 0, after_key: object = None, run_time: str | None = None,
    upto: object = None, done: bool | None = None,
) -> Row:
    """One batch, the rows behind ``after_key`` and up to ``upto``; its commit."""
    spark, key = source.sparkSession, entity.target_key
    version = place.last + 1
    todo = _past(source.where(entity.where) if entity.where else source, entity.source_key, after_key, upto, nulls=after_key is None)
    last_key = upto
    if limit:
        todo, last_key, rest = _limited(entity, todo, limit, after_key)
        done, last_key = (False, last_key) if rest or upto is not None else (done, last_key)
    if last_key is None and done:
        last_key = after_key
    mine = None
    if any(c["ids_in"] for c in place.commits):
        touched = {r[0] for r in todo.select(bucket_of(F.col(entity.map_key), store.n_buckets)).distinct().collect()}
        mine = store.ids(spark, entity.name, touched, place)
    parents = sorted({p["entity"] for _, _, p in entity.lookups()})
    # kept, as the journal, the rows and the ids must come from the same values
    built = durable(_new_rows(build_rows(entity, todo, store.id_map(spark, parents), run_time=run_time, run_id=run_id), mine))
    errors = rejected(built.where(~F.col("__known")), entity.name).drop("entity")
    named = key in built.columns
    asks = [F.count(F.when(F.col("__known"), 1)).alias("known"), F.count(F.when(~F.col("__known") & F.col("__error").isNotNull(), 1)).alias("failed")]
    asks += [F.collect_set(bucket_of(F.col(key), store.n_buckets)).alias("touched"), F.count(F.when(F.col(key).isNull(), 1)).alias("unnamed")] if named else [F.array().cast("array<int>").alias("touched"), F.count(F.lit(1)).alias("unnamed")]
    seen = built.agg(*asks).first()  # at most n_buckets numbers
    if on_error == "abort" and seen["failed"]:
        row = errors.first()
        raise RowsRejected(f"{entity.name}: {row['source_id']}: {row['message']}")
    good = built.where("__error is null and not __known").drop("__error", "__clock", "__unresolved", "__known")
    if not named:
        good = good.withColumn(key, F.lit(None).cast("long"))
    max_key = place.max_key
    if seen["unnamed"]:
        kind = dict(good.dtypes)[key]
        fresh = W.assign_keys(good.where(F.col(key).isNull()).drop(key), "__order", max_key + 1, "__id").withColumn(key, F.col("__id").cast(kind)).drop("__id")
        good = good.where(F.col(key).isNotNull()).unionByName(fresh)
    columns = [c for c in good.columns if c not in HIDDEN]
    mapped = {c for c in built.columns if c not in (*HIDDEN, "__known")}
    stored = dict(spark.createDataFrame([], place.fields).dtypes) if place.fields else {}
    types = stored | {c: t for c, t in good.dtypes if c in columns}
    fields = ", ".join(f"`{c}` {t}" for c, t in types.items())
    target = store.target(spark, entity, fields, set(seen["touched"]), place)
    judged = W.classify(_winners(good, key, entity.conflict), target, key, entity.conflict)
    repeated = {"skip": "skipped", "update": "updated", "error": "failed"}[entity.conflict]
    judged = judged.withColumn("__action", F.when(F.col("__first"), F.col("__action")).otherwise(repeated))
    judged = judged.withColumn("__message", F.when(F.col("__action") == "failed", F.lit("the target has this key")))
    if entity.not_null or entity.unique:
        judged = W.constrained(judged, lambda: store.target(spark, entity, fields, None, place), key, entity.not_null, entity.unique)
    judged = durable(judged)
    changes = F.col("__first") & F.col("__action").isin("inserted", "updated")
    kept_ids = F.col("__action") != "failed"
    refused = judged.where("__action = 'failed'").select(F.col("__key").alias("source_id"), F.lit("write").alias("stage"), F.col("__message").alias("message"))
    changed = judged.where(changes)
    entry = W.journal(changed, run_id, entity.name, key).drop("entity")
    own = lambda c: F.col(f"`{c}`") if c in columns else F.lit(None).cast(types[c])
    keep = lambda c: own(c) if c in mapped else F.when(F.col("__action") == "updated", F.col(f"__prior.`{c}`")).otherwise(own(c))
    ids = judged.where(kept_ids).select(F.col("__key").alias("source_id"), F.col(key).cast("string").alias("target_id"), F.lit(run_id).alias("run_id"))
    summed = judged.agg(
        *[F.count(F.when(F.col("__action") == a, 1)).alias(a) for a in COUNTS[:4]],
        F.collect_set(F.when(changes, bucket_of(F.col(key), store.n_buckets))).alias("rows_in"),
        F.collect_set(F.when(kept_ids, bucket_of(F.col("__key"), store.n_buckets))).alias("ids_in"),
        F.max(F.when(changes, F.col(key).try_cast("long"))).alias("max_key"),
    )
    # the folders of a version depend on the kept rows alone, not on each other
    with ThreadPoolExecutor(4) as pool:
        counting = pool.submit(lambda: summed.first().asDict())
        writing = [
            pool.submit(store.put, errors.unionByName(refused).withColumn("run_id", F.lit(run_id)), "errors", entity.name, version),
            pool.submit(store.put, entry.withColumn("target_id", F.col("target_id").cast("string")), "journal", entity.name, version),
            pool.submit(store.put, changed.select(*[keep(c).alias(c) for c in types], F.lit(False).alias("__deleted")), "rows", entity.name, version, key),
            pool.submit(store.put, ids, "ids", entity.name, version, "source_id"),
        ]
        for w in writing:
            w.result()
        counts = counting.result()
    if on_error == "abort" and counts["failed"]:
        done = False
    counts["failed"] += seen["failed"]
    counts["known"] = seen["known"]
    row = {"entity": entity.name, "run_id": run_id, "batch_id": batch_id, "version": version, "full": False, "last_key": None if last_key is None else str(last_key), "done": done, "fields": fields, "n_buckets": store.n_buckets}
    return store.commit(spark, row | counts | {"max_key": max(max_key, counts["max_key"] or 0)})


def apply_entity(store: Store, entity: Entity, source: DataFrame, run_id: str, batch_rows: int = 1_000_000, limit: int = 0, should_stop: Callable[[], bool] | None = None, **settings) -> str:
    """Apply an entity in ranges of its source key, behind the last one that this run has committed.

    ``limit`` holds over all batches of the run; the outcome is ``done``, ``limited`` or ``stopped``
    (by ``should_stop`` or :func:`request_stop`, between two batches).
    """
    spark = source.sparkSession
    place = store.place(spark, entity.name)
    own = sorted(place.of_run(run_id), key=lambda c: c["batch_id"])
    if own and own[-1]["done"]:
        return "done"
    check_structure(store, entity, source, settings.pop("grow", False), place)
    after, batch = (own[-1]["last_key"], own[-1]["batch_id"] + 1) if own else (None, 0)
    processed = sum(c[n] for c in own for n in COUNTS)
    rows = source.where(entity.where) if entity.where else source
    for upto in key_ranges(_past(rows, entity.source_key, after), entity.source_key, batch_rows):
        if limit and processed >= limit:
            return "limited"
        row = _write_batch(store, entity, source, run_id, place, batch, limit=limit - processed if limit else 0, after_key=after, upto=upto, done=upto is None, **settings)
        place = place.after(row)
        processed += sum(row[n] for n in COUNTS)
        after, batch = upto, batch + 1
        if len(place.live) > store.compact_after:
            place = place.after(compact(store, entity, None, spark, place=place))
        if upto is not None and ((should_stop and should_stop()) or stop_requested(store, spark, run_id)):
            return "stopped"
        if settings.get("on_error") == "abort" and row["failed"]:
            return "failed"
    return "done" if row["done"] else "limited"


def run_history(store: Store, spark: SparkSession) -> DataFrame:
    """run_id, mode, status, entities that are done, and their written and failed rows: one row per run, by the commits."""
    done = F.count_distinct(F.when(F.col("done"), F.col("entity")))
    sums = store.commits(spark).groupBy("run_id").agg(done.alias("entities"), F.sum(F.col("inserted") + F.col("updated")).alias("written"), F.sum("failed").alias("failed"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return store.runs(spark).join(sums, "run_id", "left").select("run_id", "mode", "status", zero("entities"), zero("written"), zero("failed"))


def request_stop(store: Store, spark: SparkSession, run_id: str) -> None:
    """Ask a running run, from any session, to stop after its present batch."""
    run = store.runs(spark).where(F.col("run_id") == run_id).first()
    if run is None:
        raise ValueError(f"no such run: {run_id}")
    store.set_run(spark, run_id, run["mode"], run["mapping"], "stopping")


def stop_requested(store: Store, spark: SparkSession, run_id: str) -> bool:
    return not store.runs(spark).where((F.col("run_id") == run_id) & (F.col("status") == "stopping")).isEmpty()


def apply(store: Store, entities: Sequence[Entity], sources: Mapping[str, DataFrame], run_id: str | None = None, resume: bool = False, **settings) -> str:
    """Apply entities, parents first; the run's id. A resumed run must have the same mapping.

    The run ends as ``completed``, or as ``stopped`` (limit included), ``failed``; the latter two go
    on with ``resume``, behind the last key of each entity. ``settings`` are those of
    :func:`apply_entity` and :func:`apply_batch`.
    """
    spark = next(iter(sources.values())).sparkSession
    mapping = fingerprint(entities)
    if resume:
        run = store.runs(spark).where(F.col("run_id") == run_id).first()
        if run is None:
            raise ValueError(f"no such run: {run_id}")
        if run["mapping"] != mapping:
            raise ValueError(f"run {run_id} used another mapping ({run['mapping']}, now {mapping}): start a new run")
    run_id = run_id or uuid.uuid4().hex
    ordered = in_order(entities)
    for e in ordered:  # all of them before the first row
        check_structure(store, e, sources[e.name], settings.get("grow", False))
    store.set_run(spark, run_id, "apply", mapping, "running")
    status = "completed"
    try:
        for e in ordered:
            outcome = apply_entity(store, e, sources[e.name], run_id, **settings)
            if outcome in ("stopped", "failed"):
                status = outcome
                break
            status = "stopped" if outcome == "limited" else status
    except Exception:
        store.set_run(spark, run_id, "apply", mapping, "failed")
        raise
    store.set_run(spark, run_id, "apply", mapping, status)
    return run_id


def compact(store: Store, entity: Entity, schema: StructType | str | None, spark: SparkSession, run_id: str = "compact", place: Place | None = None) -> Row:
    """Write the current rows as one full version; older ones are no longer read."""
    place = place or store.place(spark, entity.name)
    version = place.last + 1
    return _put_version(store, entity, store.target(spark, entity, schema, None, place).withColumn("__deleted", F.lit(False)), version, {"run_id": run_id, "batch_id": version, "full": True}, place)


def _put_version(store: Store, entity: Entity, rows: DataFrame, version: int, row: dict, place: Place) -> Row:
    spark = rows.sparkSession
    store.put(rows, "rows", entity.name, version, entity.target_key)
    written = rows.select(bucket_of(F.col(entity.target_key), store.n_buckets).alias("b")).distinct().collect()  # at most n_buckets rows
    fields = place.fields or ddl(rows.drop("__deleted").schema)
    return store.commit(spark, {"entity": entity.name, "version": version, "max_key": place.max_key, "fields": fields, "n_buckets": store.n_buckets, "rows_in": [r["b"] for r in written], "ids_in": []} | row)


def _journal(store: Store, entity: Entity, schema: StructType, spark: SparkSession, run_id: str) -> DataFrame:
    fields = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in schema)
    rows = read_or_empty(spark, store.at("journal", f"entity={entity.name}"), f"{JOURNAL}, prior_row struct<{fields}>, version int")
    return rows.where((F.col("run_id") == run_id) & (F.col("version") <= store.versions(spark, entity.name)[1]))


def rollback(store: Store, entities: Sequence[Entity], schemas: Mapping[str, StructType], spark: SparkSession, run_id: str) -> dict[str, object]:
    """Take a run back, children first: inserted rows go, updated ones get their oldest row.

    The run's ids are forgotten only if the target held every row that the journal names; else
    everything stays on record and the run is marked as incomplete.
    """
    run = store.runs(spark).where(F.col("run_id") == run_id).first()
    if run is None or run["mode"] != "apply":
        raise ValueError(f"no such run to take back: {run_id}")
    undone = journalled = 0
    for e in reversed(in_order(entities)):
        entries = _journal(store, e, schemas[e.name], spark, run_id)
        oldest = entries.groupBy("target_id").agg(F.min_by("action", "version").alias("__a"), F.min_by("prior_row", "version").alias("__o"))
        n = oldest.count()
        if not n:
            continue
        target = store.target(spark, e, schemas[e.name])
        # an earlier version than the run's own may be all that is left: it says what the key was
        touched = durable(target.withColumn("__t", F.col(e.target_key).cast("string")).join(oldest, F.col("__t") == F.col("target_id")))
        gone = F.col("__a") == "inserted"
        back = touched.select(*[F.when(gone, F.col(c)).otherwise(F.col(f"__o.{c}")).alias(c) for c in target.columns], gone.alias("__deleted"))
        place = store.place(spark, e.name)
        _put_version(store, e, durable(back), place.last + 1, {"run_id": f"undo {run_id}", "batch_id": 0, "full": False}, place)
        journalled, undone = journalled + n, undone + touched.count()
    complete = journalled > 0 and undone >= journalled
    store.set_run(spark, run_id, "apply", run["mapping"], "rolled_back" if complete else "rollback_incomplete")
    return {"rows_undone": undone, "rows_journalled": journalled, "complete": complete}


def verify_entity(entity: Entity, source: DataFrame, id_map: DataFrame, target: DataFrame, sample: int = 0, seed: int = 0) -> DataFrame:
    """kind, source_id, field, expected, actual of everything that does not hold after a run.

    ``count``: source rows without a recorded id; ``source_vanished``, ``missing``: recorded rows that
    the source or the target no longer has; ``transform``: rows that the mapping now rejects;
    ``mismatch``: values that differ from what the mapping gives. Values made by the clock are not
    compared, nor is the target's own key. ``lookup``: an entity that a field looks up and that has no
    rows. All rows are compared; ``sample`` takes that many id pairs, the same at every run with a seed.
    """
    own = source.where(entity.where) if entity.where else source
    mine = id_map.where(F.col("entity") == entity.name).select("source_id", "target_id")
    pairs = mine.orderBy(F.xxhash64("source_id", F.lit(seed)), "source_id").limit(sample) if sample else mine
    rows = build_rows(entity, own, id_map)
    columns = [c for c in rows.columns if c not in HIDDEN and c in target.columns and c != entity.target_key]
    kinds, there = dict(rows.dtypes), dict(target.dtypes)
    e = rows.select(F.col("__key").alias("__ek"), F.col("__error").alias("__ee"), F.col("__clock").alias("__ec"), F.struct(*[F.col(c) for c in columns]).alias("__e"))
    t = target.select(F.col(entity.target_key).cast("string").alias("__tk"), F.struct(*[F.col(c) for c in columns]).alias("__t"))
    both = spread_join(spread_join(pairs, e, "source_id", "__ek"), t, "target_id", "__tk", by=["source_id"])
    skip = F.array_union(F.coalesce("__ec", F.array().cast("array<string>")), F.array(*[F.lit(c) for c in sorted(entity.clock_made())]).cast("array<string>"))
    none = F.lit(None).cast("string")
    one = lambda kind, detail: F.array(F.struct(F.lit(kind).alias("kind"), none.alias("field"), detail.alias("expected"), none.alias("actual")))
    wrong = F.transform(W.differences(columns, kinds, there, "__e", "__t", skip), lambda d: F.struct(F.lit("mismatch").alias("kind"), d["column"].alias("field"), d["expected"].alias("expected"), d["actual"].alias("actual")))
    found = F.when(F.col("__ek").isNull(), one("source_vanished", none)).when(F.col("__tk").isNull(), one("missing", none)).when(F.col("__ee").isNotNull(), one("transform", F.col("__ee"))).otherwise(wrong)
    out = both.select("source_id", F.inline(found)).select("kind", "source_id", "field", "expected", "actual")
    sizes = W.verify_counts(entity.name, own, id_map, target).where("recorded_ids < source_rows")
    out = out.unionByName(sizes.select(F.lit("count").alias("kind"), none.alias("source_id"), none.alias("field"), F.col("source_rows").cast("string").alias("expected"), F.col("recorded_ids").cast("string").alias("actual")))
    asked = sorted({(str(entity.fields[i].to), p["entity"]) for i, _, p in entity.lookups()})
    if asked:
        known = id_map.select(F.col("entity").alias("ref")).distinct()
        wanted = source.sparkSession.createDataFrame(asked, "field string, ref string")
        lost = wanted.join(known, "ref", "left_anti")
        out = out.unionByName(lost.select(F.lit("lookup").alias("kind"), none.alias("source_id"), "field", F.col("ref").alias("expected"), none.alias("actual")))
    return out
