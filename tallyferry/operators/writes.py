"""Keyed writes as new snapshots: classify, merge, journal, roll back, verify.

Every function gives a DataFrame. A write joins the incoming rows to the target once, on the key;
the journal comes from the same classified rows and is stored before the snapshot.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyferry.functions.transforms import same_value, shown
from tallyferry.operators.storage import durable, spread_join


def classify(incoming: DataFrame, target: DataFrame, key: str, conflict: str) -> DataFrame:
    """``incoming`` with ``__action`` (inserted, skipped, updated, failed) and ``__prior`` (the target's row).

    A null key is a new row. ``__prior`` is a struct of the target's columns, so no value changes its type.
    """
    prior = target.select(F.col(key).alias("__k"), F.struct(*[F.col(c) for c in target.columns]).alias("__prior"))
    joined = spread_join(incoming, prior, key, "__k").drop("__k")
    exists = {"skip": "skipped", "update": "updated", "error": "failed"}[conflict]
    return joined.withColumn("__action", F.when(F.col("__prior").isNull(), "inserted").otherwise(exists))


def merged(incoming: DataFrame, target: DataFrame, key: str, conflict: str) -> DataFrame:
    """The target after the write; an update changes the mapped columns only.

    Old rows and incoming rows meet in one full join on the key; null keys stay apart.
    """
    own = target.select(F.col(key).alias("__ok"), F.struct(*[F.col(c) for c in target.columns]).alias("o"))
    new = incoming.select(F.col(key).alias("__nk"), F.struct(*[F.col(c) for c in incoming.columns]).alias("n"))
    both = spread_join(own, new, "__ok", "__nk", "full_outer")
    take_new = F.col("n").isNotNull() & (F.col("o").isNull() if conflict != "update" else F.lit(True))

    def column(c: str) -> Column:
        if c not in incoming.columns:
            return F.col(f"o.{c}")
        return F.when(take_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))

    return both.select(*[column(c).alias(c) for c in target.columns])


def journal(classified: DataFrame, run_id: str, entity: str, key: str) -> DataFrame:
    """Rows for inserted and updated keys, with what stood there before (a struct, null for inserted)."""
    written = classified.where(F.col("__action").isin("inserted", "updated"))
    return written.select(F.lit(run_id).alias("run_id"), F.lit(entity).alias("entity"), F.col(key).alias("target_id"), F.col("__action").alias("action"), F.when(F.col("__action") == "updated", F.col("__prior")).alias("prior_row"))


def rolled_back(target: DataFrame, entries: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """The target before the journalled run: inserted keys go, updated ones get their oldest row."""
    oldest = entries.groupBy("target_id").agg(F.min_by("action", seq).alias("__a"), F.min_by("prior_row", seq).alias("__o"))
    touched = spread_join(target, oldest, key, "target_id")
    kept = touched.where(F.col("__a").isNull() | (F.col("__a") == "updated"))
    return kept.select(*[F.when(F.col("__a").isNotNull(), F.col(f"__o.{c}")).otherwise(F.col(c)).alias(c) for c in target.columns])


def tally(classified: DataFrame) -> DataFrame:
    return classified.agg(*[F.count(F.when(F.col("__action") == a, 1)).alias(a) for a in ("inserted", "updated", "skipped", "failed")])


def assign_keys(rows: DataFrame, order: str, first: int, key: str = "id", slices: int | None = None) -> DataFrame:
    """Dense ids from ``first`` on in the order of ``order``, without one task that holds all rows.

    Rows are dealt to ranges of the order (``slices``, or as many as shuffles have); ranges are counted,
    and a row's id is what stands before its range plus its place in it. The dealt rows are kept, as a
    repeated task may cut its ranges anew.
    """
    slices = slices or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = durable(rows.repartitionByRange(slices, order).withColumn("__p", F.spark_partition_id()))
    counts = parts.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))  # one row for each range
    before = counts.withColumn("__b", F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).select("__p", "__b")
    place = F.row_number().over(Window.partitionBy("__p").orderBy(order))
    return parts.withColumn("__r", place).join(F.broadcast(before), "__p").withColumn(key, (F.lit(first) + F.col("__b") + F.col("__r") - 1).cast("long")).drop("__p", "__r", "__b")


def constraint_errors(rows: DataFrame, key: str, not_null: Sequence[str] = (), unique: Sequence[str] = ()) -> DataFrame:
    """key and message of rows that a write would refuse: null where not allowed, repeated where unique."""
    out = rows
    tests = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in not_null]
    for c in unique:
        counts = rows.where(F.col(c).isNotNull()).groupBy(F.col(c).alias(f"__c_{c}")).agg(F.count(F.lit(1)).alias(f"__n_{c}")).where(F.col(f"__n_{c}") > 1)
        out = spread_join(out, counts, c, f"__c_{c}", by=[key])
        tests.append(F.when(F.col(f"__n_{c}").isNotNull(), F.lit(f"{c} is not unique")))
    return out.select(F.col(key), F.coalesce(*tests).alias("message")).where("message is not null")


def constrained(judged: DataFrame, target: Callable[[], DataFrame], key: str, not_null: Sequence[str] = (), unique: Sequence[str] = ()) -> DataFrame:
    """Classified rows, those that break a constraint as ``failed`` with ``__message``.

    A value that must be unique belongs to the target row that has it (under another key), else to the
    first row of the batch, by ``__order``; nulls never clash. Rows that have failed claim no value.
    """
    live = lambda: F.col("__action").isin("inserted", "updated") & F.col("__first")

    def fail(rows: DataFrame, test: Column, message: str) -> DataFrame:
        rows = rows.withColumn("__bad", live() & F.coalesce(test, F.lit(False)))
        return rows.withColumn("__message", F.when(F.col("__bad"), F.lit(message)).otherwise(F.col("__message"))).withColumn("__action", F.when(F.col("__bad"), "failed").otherwise(F.col("__action"))).drop("__bad")

    for c in not_null:
        judged = fail(judged, F.col(c).isNull(), f"{c} is null")
    for c in unique:
        place = F.struct("__order", "__key", F.col(key).cast("string"))
        claims = judged.where(live() & F.col(c).isNotNull()).groupBy(F.col(c).alias("__uv")).agg(F.min(place).alias("__uf"))
        # a row of the target that this batch changes claims what it has after the batch
        changed = judged.where(live()).select(F.col(key).alias("__ck"))
        held = target().select(F.col(key).alias("__uk"), F.col(c).alias("__hv")).where(F.col("__hv").isNotNull())
        held = held.join(changed, F.col("__uk") == F.col("__ck"), "left_anti").groupBy("__hv").agg(F.lit(True).alias("__held"))
        judged = spread_join(judged, claims, c, "__uv", by=["__key"])
        judged = spread_join(judged, held, c, "__hv", by=["__key"])
        judged = fail(judged, F.coalesce(F.col("__held"), F.lit(False)) | (F.col("__uf") != place), f"{c} is not unique").drop("__uv", "__uf", "__hv", "__held")
    return judged


def last_by_key(rows: DataFrame, key: str | Sequence[str], order: str) -> DataFrame:
    """One row per key: the last by ``order``, of ties the greatest (a partial aggregate, so a hot key costs no more)."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [order, *[c for c in rows.columns if c not in (*keys, order)]]
    picked = rows.groupBy(*keys).agg(F.max(F.struct(*[F.col(c) for c in rest])).alias("__r"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"__r.{c}").alias(c) for c in rows.columns])


def verify_counts(entity: str, source: DataFrame, id_map: DataFrame, target: DataFrame) -> DataFrame:
    """One row: source rows, recorded ids and target rows of an entity."""
    names = ("source_rows", "recorded_ids", "target_rows")
    parts = [df.select(*[F.lit(int(k == i)).alias(n) for k, n in enumerate(names)]) for i, df in enumerate((source, id_map.where(F.col("entity") == entity), target))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in names]).withColumn("entity", F.lit(entity))


def differences(columns: Sequence[str], expected: dict[str, str], actual: dict[str, str], left: str, right: str, skip: Column | None = None) -> Column:
    """Array of (column, expected, actual) of the values that differ between the structs ``left`` and ``right``.

    ``expected`` and ``actual`` are the types by column; ``skip`` is an array of names that are not compared.
    """
    own = lambda side, c: F.col(f"{side}.`{c}`")
    rows = [F.struct(F.lit(c).alias("column"), shown(own(left, c), expected[c]).alias("expected"), shown(own(right, c), actual[c]).alias("actual"), same_value(own(left, c), expected[c], own(right, c), actual[c]).alias("same")) for c in columns]
    wrong = F.filter(F.array(*rows), lambda p: ~p["same"] & (F.lit(True) if skip is None else ~F.array_contains(skip, p["column"])))
    return F.transform(wrong, lambda p: F.struct(p["column"].alias("column"), p["expected"].alias("expected"), p["actual"].alias("actual")))


def verify_diff(expected: DataFrame, actual: DataFrame, key: str, skip: Collection[str] = ()) -> DataFrame:
    """key, column, expected, actual of every value that differs; a missing row is one entry."""
    columns = [c for c in expected.columns if c != key and c in actual.columns and c not in skip]
    e = expected.select(key, F.struct(*[F.col(c) for c in columns]).alias("e"))
    a = actual.select(key, F.struct(*[F.col(c) for c in columns], F.lit(True).alias("there")).alias("a"))
    gone = F.array(F.struct(F.lit("<row>").alias("column"), F.lit("present").alias("expected"), F.lit("missing").alias("actual")))
    wrong = differences(columns, dict(expected.dtypes), dict(actual.dtypes), "e", "a")
    return e.join(a, key, "left").select(key, F.inline(F.when(F.col("a.there").isNull(), gone).otherwise(wrong)))


def forget(id_map: DataFrame, run_id: str) -> DataFrame:
    """The id map without what one run recorded."""
    return id_map.where(~F.col("run_id").eqNullSafe(run_id))
