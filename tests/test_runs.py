"""Writes, whole runs, streams, verification, rollback, plans and loaders on small tables."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyferry.operators import migrate as M
from tallyferry.operators import writes as W
from tallyferry.operators.storage import spread_join
from tallyferry.plans.mapping import Entity, Field, accepted, build_rows, fingerprint, plan
from tallyferry.sources import loaders as L
from tallyferry.streaming.apply import drain, file_stream, fresh_records

SHOPS = Entity("shops", "shops", "no", "shop", "id", (Field("name", "name", transform=("trim", "nullif_empty"), required=True),))
JOBS = Entity("jobs", "jobs", "no", "job", "key", (Field("key", "no", transform=("int",)), Field("shop", "shop", transform=({"lookup": {"entity": "shops", "required": True}}, "int")), Field("made", "made", default="@now")), conflict="skip")
JOB_ROW = "key long, shop long, made timestamp_ntz"


def tables(spark):
    return {
        "shops": spark.createDataFrame([(1, "North "), (2, " "), (3, "South")], "no int, name string"),
        "jobs": spark.createDataFrame([(10, 1, None), (11, 2, None), (12, 3, dt.datetime(2024, 1, 1))], "no int, shop int, made timestamp_ntz"),
    }


@pytest.fixture
def store(tmp_path):
    return M.Store(f"file://{tmp_path}/store")


def jobs_of(spark, store):
    return sorted(tuple(r)[:2] for r in store.target(spark, JOBS, JOB_ROW).collect())


def test_a_run_remaps_keys_and_writes_no_orphans(spark, store):
    run = M.apply(store, [JOBS, SHOPS], tables(spark), "r1")
    assert jobs_of(spark, store) == [(10, 1), (12, 2)]
    assert sorted(tuple(r) for r in store.errors(spark).select("entity", "source_id", "stage").collect()) == [("jobs", "11", "transform"), ("shops", "2", "transform")]
    assert store.runs(spark).first()["status"] == "completed" and run == "r1"
    assert sorted(tuple(r) for r in store.id_map(spark).collect()) == [("jobs", "10", "10"), ("jobs", "12", "12"), ("shops", "1", "1"), ("shops", "3", "2")]


def test_running_again_writes_nothing(spark, store):
    M.apply(store, [JOBS, SHOPS], tables(spark), "r1")
    M.apply(store, [JOBS, SHOPS], tables(spark), "r2")
    counts = {r["entity"]: (r["inserted"], r["known"]) for r in store.commits(spark).where("run_id = 'r2'").collect()}
    assert counts == {"shops": (0, 2), "jobs": (0, 2)} and jobs_of(spark, store) == [(10, 1), (12, 2)]


def test_a_batch_without_its_commit_is_written_again(spark, store):
    """The folders of a batch that died hold rows; nothing reads them, and the next start writes over them."""
    t = tables(spark)
    M.apply_batch(store, SHOPS, t["shops"], "r1")
    spark.createDataFrame([(99, 9, dt.datetime(2020, 1, 1), False)], f"{JOB_ROW}, __deleted boolean").write.parquet(store.at("rows", "entity=jobs", "version=1"))
    assert jobs_of(spark, store) == []
    M.apply(store, [JOBS, SHOPS], t, "r1")
    assert jobs_of(spark, store) == [(10, 1), (12, 2)]
    assert M.apply_batch(store, JOBS, t["jobs"], "r1")["inserted"] == 2 and store.commits(spark).where("entity = 'jobs'").count() == 1


def test_resume_is_refused_for_another_mapping(spark, store):
    M.apply(store, [JOBS, SHOPS], tables(spark), "r1")
    changed = Entity(**{**SHOPS.__dict__, "conflict": "skip"})
    assert fingerprint([JOBS, SHOPS]) != fingerprint([JOBS, changed])
    with pytest.raises(ValueError, match="another mapping"):
        M.apply(store, [JOBS, changed], tables(spark), "r1", resume=True)
    with pytest.raises(ValueError, match="no such run"):
        M.apply(store, [JOBS, SHOPS], tables(spark), "r9", resume=True)
    assert M.apply(store, [JOBS, SHOPS], tables(spark), "r1", resume=True) == "r1"


def test_limit_and_abort(spark, store):
    assert M.apply_batch(store, SHOPS, tables(spark)["shops"], "r1", limit=1)["inserted"] == 1
    with pytest.raises(M.RowsRejected):
        M.apply_batch(store, SHOPS, tables(spark)["shops"], "r2", on_error="abort")
    assert store.commits(spark).count() == 1


@pytest.mark.parametrize("conflict,want,rows", [("skip", (1, 0, 2, 0), {1: "old", 2: "a"}), ("update", (1, 2, 0, 0), {1: "new", 2: "b"}), ("error", (1, 0, 0, 2), {1: "old", 2: "a"})])
def test_equal_keys_of_one_batch_and_of_the_target(spark, store, conflict, want, rows):
    e = Entity("e", "s", "no", "t", "id", (Field("id", "id"), Field("v", "v")), conflict=conflict)
    schema = "no int, id int, v string"
    M.apply_batch(store, e, spark.createDataFrame([(1, 1, "old")], schema), "r1")
    got = M.apply_batch(store, e, spark.createDataFrame([(2, 1, "new"), (3, 2, "a"), (4, 2, "b")], schema), "r2")
    assert (got["inserted"], got["updated"], got["skipped"], got["failed"]) == want
    assert {r["id"]: r["v"] for r in store.target(spark, e, "id int, v string").collect()} == rows


def test_rollback_takes_a_run_back_and_forgets_its_ids(spark, store):
    M.apply(store, [JOBS, SHOPS], tables(spark), "r1")
    schemas = {"jobs": store.target(spark, JOBS, JOB_ROW).schema, "shops": store.target(spark, SHOPS, "name string, id long").schema}
    more = tables(spark) | {"jobs": tables(spark)["jobs"].where("no = 12").withColumn("no", F.lit(20))}
    M.apply(store, [JOBS, SHOPS], more, "r2")
    assert jobs_of(spark, store) == [(10, 1), (12, 2), (20, 2)]
    assert M.rollback(store, [JOBS, SHOPS], schemas, spark, "r2") == {"rows_undone": 1, "rows_journalled": 1, "complete": True}
    assert jobs_of(spark, store) == [(10, 1), (12, 2)] and store.id_map(spark).where("source_id = '20'").count() == 0
    M.compact(store, JOBS, JOB_ROW, spark)
    assert jobs_of(spark, store) == [(10, 1), (12, 2)]
    assert M.rollback(store, [JOBS, SHOPS], schemas, spark, "r1")["complete"] and jobs_of(spark, store) == []
    assert store.target(spark, SHOPS, "name string, id long").count() == 0
    with pytest.raises(ValueError):
        M.rollback(store, [JOBS, SHOPS], schemas, spark, "nope")


def test_an_incomplete_rollback_keeps_the_evidence(spark, store):
    M.apply(store, [JOBS, SHOPS], tables(spark), "r1")
    schema = store.target(spark, JOBS, JOB_ROW).schema
    spark.createDataFrame([(10, 1, None, True)], f"{JOB_ROW}, __deleted boolean").write.parquet(store.at("rows", "entity=jobs", "version=2"))
    spark.createDataFrame([("jobs", "by hand", 0, 2, False, 0, 0, 0, 0, 0)], M.COMMITS).write.mode("append").parquet(store.at("commits"))
    got = M.rollback(store, [JOBS], {"jobs": schema}, spark, "r1")
    assert not got["complete"] and store.id_map(spark).where("entity = 'jobs'").count() == 2
    assert store.runs(spark).where("run_id = 'r1'").first()["status"] == "rollback_incomplete"


TYPES = "id int, t timestamp_ntz, d date, n decimal(20,4), f double, b boolean, x binary, a array<string>, s struct<k: int>"
VALUES = (1, dt.datetime(2024, 1, 2, 3, 4, 5, 123456), dt.date(2024, 1, 2), Decimal("1.2345"), 0.1 + 0.2, True, bytearray(b"\x00\xff"), ["a", None], (5,))


def test_rollback_gives_every_type_back_as_it_was(spark):
    before = spark.createDataFrame([VALUES], TYPES)
    after = before.select("id", *[F.lit(None).cast(t).alias(c) for c, t in before.dtypes if c != "id"])
    entries = W.journal(W.classify(after, before, "id", "update"), "r", "e", "id").withColumn("seq", F.lit(1))
    assert [tuple(r) for r in W.rolled_back(after, entries, "id").collect()] == [tuple(r) for r in before.collect()]


def test_null_keys_stay_apart_in_joins(spark):
    a = spark.createDataFrame([(None, i) for i in range(50)] + [(1, 100), (2, 101)], "k int, v int")
    b = spark.createDataFrame([(None, "n"), (1, "x"), (3, "y")], "q int, w string")
    assert sorted((tuple(r) for r in spread_join(a, b, "k", "q", by=["v"]).where("k is not null").collect()), key=repr) == [(1, 100, 1, "x"), (2, 101, None, None)]
    assert spread_join(a, b, "k", "q").count() == 52 and spread_join(a, b, "k", "q", "full_outer").count() == 54
    assert W.merged(spark.createDataFrame([(None, 7), (1, 8)], "k int, v int"), a, "k", "update").where("k is null").count() == 51


def verified(spark, store, **settings):
    t = tables(spark)
    return sorted(tuple(r) for r in M.verify_entity(JOBS, t["jobs"].where("no <> 11"), store.id_map(spark), store.target(spark, JOBS, JOB_ROW), **settings).collect())


def test_verify_passes_a_clean_run_and_clock_made_values(spark, store):
    M.apply(store, [JOBS, SHOPS], tables(spark), "r1")
    assert verified(spark, store) == []


def test_verify_finds_tampering_and_losses(spark, store):
    M.apply(store, [JOBS, SHOPS], tables(spark), "r1")
    rows = store.target(spark, JOBS, JOB_ROW)
    source = tables(spark)["jobs"].where("no <> 11")
    tampered = rows.withColumn("shop", F.lit(9).cast("long")).where("key = 10")
    got = [tuple(r) for r in M.verify_entity(JOBS, source, store.id_map(spark), tampered).collect()]
    assert sorted(got) == [("mismatch", "10", "shop", "1.0", "9.0"), ("missing", "12", None, None, None)]
    gone = M.verify_entity(JOBS, source.where("no = 10"), store.id_map(spark), rows).collect()
    assert [(r["kind"], r["source_id"]) for r in gone] == [("source_vanished", "12")]
    empty = M.verify_entity(JOBS, tables(spark)["jobs"], store.id_map(spark).where("entity = 'none'"), rows).collect()
    assert sorted(r["kind"] for r in empty) == ["count", "lookup"]


def test_verify_samples_alike_every_time(spark):
    ids = spark.range(200).select(F.lit("e").alias("entity"), F.col("id").cast("string").alias("source_id"), F.col("id").cast("string").alias("target_id"))
    e = Entity("e", "s", "id", "t", "id", (Field("id", "id"), Field("v", "id")))
    target = spark.range(200).select("id", F.lit(-1).alias("v"))
    pick = lambda seed: sorted(r["source_id"] for r in M.verify_entity(e, spark.range(200), ids, target, sample=20, seed=seed).collect())
    assert len(pick(1)) == 20 and pick(1) == pick(1) != pick(2)


def test_a_stream_goes_on_where_it_stopped(spark, store, tmp_path):
    folder, offsets = f"file://{tmp_path}/in", f"file://{tmp_path}/offsets"
    t = tables(spark)
    M.apply(store, [SHOPS], {"shops": t["shops"]}, "r1")
    for part in ("no = 10", "no >= 10"):  # the second folder repeats a row
        t["jobs"].where(part).write.mode("append").parquet(folder)
        drain(store, JOBS, file_stream(spark, folder, t["jobs"].schema), "s1", offsets)
    assert jobs_of(spark, store) == [(10, 1), (12, 2)]
    assert [r["known"] for r in store.commits(spark).where("entity = 'jobs'").orderBy("version").collect()] == [0, 1]
    other = Entity(**{**JOBS.__dict__, "conflict": "update"})
    with pytest.raises(ValueError, match="another mapping"):
        drain(store, other, file_stream(spark, folder, t["jobs"].schema), "s1", offsets)


def test_a_stream_shows_content_once(spark, tmp_path):
    schema = "at timestamp, page int, item string"
    rows = [(dt.datetime(2024, 1, 1, 0, 0, i), i, x) for i, x in enumerate(["a", "b", "a", None, None])]
    spark.createDataFrame(rows, schema).write.parquet(f"file://{tmp_path}/in")
    stream = fresh_records(file_stream(spark, f"file://{tmp_path}/in", spark.createDataFrame([], schema).schema), "at", ["item"])
    q = stream.writeStream.format("memory").queryName("fresh_items").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r["item"] for r in spark.table("fresh_items").collect()), key=str) == [None, "a", "b"] or spark.table("fresh_items").count() == 3


def test_plan_stops_at_structure_and_shows_failures(spark):
    t = tables(spark)
    target = spark.createDataFrame([], "key long, shop long, made timestamp_ntz, extra string")
    ids = spark.createDataFrame([("shops", "1", "1")], "entity string, source_id string, target_id string")
    rows = {(r["part"], r["name"]): r["value"] for r in plan(JOBS, t["jobs"], target, ids).collect()}
    assert rows["count", "source_rows"] == "3" and rows["unmapped", "extra"] is None and rows["unresolved", "shops"] == "2" and rows["count", "existing_keys"] == "0"
    assert [r["value"] for r in plan(JOBS, t["jobs"].drop("shop"), target.drop("made"), ids).collect()] == ["source column shop is missing", "target column made is missing"]
    bad = [r for r in plan(SHOPS, t["shops"], spark.createDataFrame([], "id long, name string"), ids).collect() if r["part"] == "failure"]
    assert [tuple(r) for r in bad] == [("failure", "2", "name: required field resolved to null")]
    assert {r["name"]: r["value"] for r in plan(SHOPS, t["shops"], spark.createDataFrame([], "id long, name string"), ids, limit=1).collect() if r["part"] == "count"} == {"source_rows": "1", "would_fail": "0"}


def test_a_lookup_that_finds_nothing_is_null_unless_required(spark):
    ids = spark.createDataFrame([("shops", "1", "7")], "entity string, source_id string, target_id string")
    e = lambda **p: Entity("e", "s", "id", "t", "id", (Field("id", "id"), Field("shop", "shop", transform=({"lookup": {"entity": "shops"} | p},))))
    source = spark.createDataFrame([(1, "1"), (2, "2"), (3, ""), (4, None)], "id int, shop string")
    assert sorted(tuple(r) for r in accepted(build_rows(e(), source, ids)).collect()) == [(1, "7"), (2, None), (3, None), (4, None)]
    assert sorted(r["id"] for r in accepted(build_rows(e(required=True), source, ids)).collect()) == [1, 3, 4]


def test_loaders(spark, tmp_path):
    out = L.Table("json", f"file://{tmp_path}/t", where="id > 1", schema="id long, v string")
    L.save(spark.createDataFrame([(i, "x") for i in range(5)], "id long, v string"), out)
    assert sorted(r["id"] for r in L.load(spark, out, after_key=("id", 2)).collect()) == [3, 4]
    L.loader("numbers")(lambda s, t: s.range(int(t.path)))
    assert L.load(spark, L.Table("numbers", "4")).count() == 4
    for use in (lambda: L.load(spark, L.Table("nope", "")), lambda: L.save(spark.range(1), L.Table("nope", ""))):
        with pytest.raises(ValueError):
            use()
