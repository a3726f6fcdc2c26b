"""Runs in key ranges: resume, limits, stops, constraints, structure, buckets and compaction."""

import pytest
from pyspark.sql import functions as F

from tallyferry.operators import migrate as M
from tallyferry.plans.mapping import Entity, Field

ITEMS = Entity("items", "items", "no", "item", "id", (Field("v", "v", transform=("trim",)),))
KEYED = Entity("items", "items", "no", "item", "id", (Field("id", "no"), Field("v", "v")), conflict="update")


@pytest.fixture
def store(tmp_path):
    return M.Store(f"file://{tmp_path}/store")


def items(spark, n, start=1):
    return spark.range(start, start + n).select(F.col("id").alias("no"), F.concat(F.lit(" v"), F.col("id")).alias("v"))


def rows(spark, store, entity=ITEMS):
    return sorted((r["id"], r["v"]) for r in store.target(spark, entity).collect())


def status(spark, store, run):
    return store.runs(spark).where(F.col("run_id") == run).first()["status"]


def test_a_limited_run_goes_on_where_it_stopped(spark, store):
    run = M.apply(store, [ITEMS], {"items": items(spark, 5)}, limit=2)
    assert rows(spark, store) == [(1, "v1"), (2, "v2")] and status(spark, store, run) == "stopped"
    M.apply(store, [ITEMS], {"items": items(spark, 5)}, run, resume=True, limit=3)  # over both runs
    assert len(rows(spark, store)) == 3
    M.apply(store, [ITEMS], {"items": items(spark, 5)}, run, resume=True)
    assert rows(spark, store) == [(k, f"v{k}") for k in range(1, 6)] and status(spark, store, run) == "completed"
    M.apply(store, [ITEMS], {"items": items(spark, 9)}, run, resume=True)
    assert len(rows(spark, store)) == 5  # a completed run is not taken up again


def test_ranges_are_committed_one_by_one_and_a_stop_holds_between_them(spark, store):
    source = items(spark, 10)
    stops = iter([False, True])
    run = M.apply(store, [ITEMS], {"items": source}, batch_rows=3, should_stop=lambda: next(stops))
    first = store.place(spark, "items").commits
    assert status(spark, store, run) == "stopped" and len(first) == 2 and 4 <= len(rows(spark, store)) <= 8
    M.request_stop(store, spark, run)
    assert M.stop_requested(store, spark, run)
    M.apply(store, [ITEMS], {"items": source}, run, resume=True, batch_rows=3)
    assert rows(spark, store) == [(k, f"v{k}") for k in range(1, 11)]
    assert len({(c["batch_id"], c["last_key"]) for c in store.place(spark, "items").commits}) >= 3
    with pytest.raises(ValueError, match="no such run"):
        M.request_stop(store, spark, "nope")


def test_a_run_that_failed_goes_on_behind_its_last_range(spark, store):
    source = items(spark, 10)
    bad = source.withColumn("v", F.when(F.col("no") < 8, F.col("v")).otherwise(F.raise_error(F.lit("broken source"))))
    with pytest.raises(Exception, match="broken source"):
        M.apply(store, [ITEMS], {"items": bad}, "r", batch_rows=3)
    before = len(rows(spark, store))
    assert status(spark, store, "r") == "failed" and 0 < before < 8
    M.apply(store, [ITEMS], {"items": source}, "r", resume=True, batch_rows=3)
    assert rows(spark, store) == [(k, f"v{k}") for k in range(1, 11)]


def test_equal_keys_across_a_limit_are_not_lost(spark, store):
    e = Entity("items", "items", "page", "item", "id", (Field("v", "v"),), id_map_from="no")
    source = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 4, "d"), (None, 5, "e")], "page int, no int, v string")
    run = M.apply(store, [e], {"items": source}, limit=3)
    assert len(rows(spark, store, e)) == 3
    M.apply(store, [e], {"items": source}, run, resume=True)
    assert sorted(v for _, v in rows(spark, store, e)) == ["a", "b", "c", "d", "e"]


def test_one_source_id_twice_gives_one_row(spark, store):
    source = items(spark, 3).unionByName(items(spark, 2))
    M.apply(store, [ITEMS], {"items": source}, "r")
    assert rows(spark, store) == [(1, "v1"), (2, "v2"), (3, "v3")]
    assert [c["known"] for c in store.place(spark, "items").commits] == [2]


def test_a_mapping_that_the_target_cannot_take_is_refused_before_any_row(spark, store):
    M.apply(store, [ITEMS], {"items": items(spark, 2)}, "r1")
    other = Entity(**{**ITEMS.__dict__, "fields": (Field("w", "v"),)})
    with pytest.raises(ValueError, match="target column w is missing"):
        M.apply(store, [other], {"items": items(spark, 4)}, "r2")
    with pytest.raises(ValueError, match="source column v is missing"):
        M.apply(store, [ITEMS], {"items": items(spark, 4).drop("v")}, "r2")
    with pytest.raises(ValueError, match="v is string, not bigint"):
        M.apply(store, [Entity(**{**ITEMS.__dict__, "fields": (Field("v", "no"),)})], {"items": items(spark, 4)}, "r2")
    assert len(rows(spark, store)) == 2 and store.runs(spark).count() == 1
    M.apply(store, [other], {"items": items(spark, 4)}, "r3", grow=True)
    assert sorted(map(tuple, store.target(spark, other).select("id", "v", "w").collect())) == [(1, "v1", None), (2, "v2", None), (3, None, " v3"), (4, None, " v4")]
    with pytest.raises(ValueError, match="no plain identifier"):
        M.check_structure(store, Entity(**{**ITEMS.__dict__, "fields": (Field("z" * 70, "v"),)}), items(spark, 1), grow=True)


def test_rows_that_break_a_constraint_are_errors_and_the_others_are_written(spark, store):
    e = Entity("items", "items", "no", "item", "id", (Field("id", "no"), Field("mail", "mail"), Field("name", "name")), conflict="update", not_null=("name",), unique=("mail",))
    schema = "no long, mail string, name string"
    M.apply(store, [e], {"items": spark.createDataFrame([(1, "a@x", "A"), (2, "b@x", "B")], schema)}, "r1")
    new = [(11, "a@x", "taken"), (12, "c@x", None), (13, "c@x", "first with a name"), (14, "c@x", "second"), (15, None, "no mail"), (16, None, "none either")]
    M.apply(store, [e], {"items": spark.createDataFrame(new, schema)}, "r2")
    got = {r["id"]: (r["mail"], r["name"]) for r in store.target(spark, e).collect()}
    assert got == {1: ("a@x", "A"), 2: ("b@x", "B"), 13: ("c@x", "first with a name"), 15: (None, "no mail"), 16: (None, "none either")}
    assert sorted((r["source_id"], r["stage"], r["message"]) for r in store.errors(spark).collect()) == [("11", "write", "mail is not unique"), ("12", "write", "name is null"), ("14", "write", "mail is not unique")]
    ids = {r["source_id"] for r in store.id_map(spark).collect()}
    assert ids == {"1", "2", "13", "15", "16"}
    # a row that gives its value up in the same batch does not hold it
    again = Entity(**{**e.__dict__, "id_map_from": "key"})
    swap = spark.createDataFrame([(1, "b@x", "A", "s1"), (2, "d@x", "B", "s2")], f"{schema}, key string")
    M.apply(store, [again], {"items": swap}, "r3")
    assert {r["id"]: r["mail"] for r in store.target(spark, e).where("id < 3").collect()} == {1: "b@x", 2: "d@x"}
    with pytest.raises(ValueError, match="constrained column zip"):
        M.apply(store, [Entity(**{**e.__dict__, "not_null": ("zip",)})], {"items": swap}, "r4")


def test_a_small_batch_reads_the_buckets_of_its_keys_only(spark, store):
    M.apply(store, [KEYED], {"items": items(spark, 100_000, 0)}, "r1")
    place = store.place(spark, "items")
    assert len(place.commits[0]["rows_in"]) > 40
    touched = {r[0] for r in spark.range(1000, 2000).select(M.bucket_of(F.col("id"), store.n_buckets)).distinct().collect()}
    read = store.target(spark, KEYED, None, touched)
    n = read.count()
    assert len(touched) <= 2 and n <= 8 * 1024 and len(read.inputFiles()) <= 2
    assert len([f for f in store.ids(spark, "items", touched).inputFiles() if "/ids/" in f]) <= 2
    M.apply(store, [Entity(**{**KEYED.__dict__, "id_map_from": "key"})], {"items": items(spark, 1000, 1000).select("no", F.lit("new").alias("v"), F.concat(F.lit("k"), "no").alias("key"))}, "r2")
    last = store.place(spark, "items").commits
    assert max(last, key=lambda c: c["version"])["updated"] == 1000 and store.target(spark, KEYED).where("v = 'new'").count() == 1000


def test_versions_are_compacted_by_rule_and_keys_go_on(spark, tmp_path):
    store = M.Store(f"file://{tmp_path}/store", n_buckets=4, compact_after=2)
    for k in range(4):
        M.apply(store, [ITEMS], {"items": items(spark, 3 * k + 3)}, f"r{k}")
    assert rows(spark, store) == [(k, f"v{k}") for k in range(1, 13)]
    full, last = store.versions(spark, "items")
    assert full > 1 and last - full <= 2 and store.id_map(spark).count() == 12
    M.rollback(store, [ITEMS], {"items": store.target(spark, ITEMS).schema}, spark, "r3")
    assert rows(spark, store) == [(k, f"v{k}") for k in range(1, 10)]
