"""Work that must not grow faster than the input: ranges of a run, tests of cells, paths over lists, steps in Python."""

from pyspark.sql import functions as F

from tallyferry.functions import variants as V
from tallyferry.operators import migrate as M
from tallyferry.operators import quality as Q
from tallyferry.plans.mapping import Entity, Field, accepted, build_rows


def test_ranges_grow_with_the_logarithm_of_the_rows(spark):
    rows = spark.range(1, 2001).withColumnRenamed("id", "no")
    tops = M.key_ranges(rows, "no", 20)
    assert tops[-1] is None and len(tops) <= 9 and tops[:-1] == sorted(tops[:-1])
    assert 5 <= tops[0] <= 60 and M.key_ranges(rows, "no", 2000) == [None]
    nulls = rows.withColumn("no", F.lit(None).cast("long"))
    assert M.key_ranges(nulls, "no", 20) == [None]


def test_constraints_hold_over_few_ranges(spark, tmp_path):
    store = M.Store(f"file://{tmp_path}/store")
    e = Entity("c", "c", "no", "c", "id", (Field("id", "no"), Field("mail", "mail"), Field("name", "name")), not_null=("name",), unique=("mail",))
    source = spark.range(0, 1200).select(F.col("id").alias("no"), F.concat(F.lit("m"), F.col("id") % 700).alias("mail"), F.when(F.col("id") % 7 != 0, "x").alias("name"))
    M.apply(store, [e], {"c": source}, "r", batch_rows=40)
    assert len(store.place(spark, "c").commits) <= 8
    first = {}
    for k in range(1200):
        if k % 7:
            first.setdefault(k % 700, k)
    assert sorted(r["id"] for r in store.target(spark, e).select("id").collect()) == sorted(first.values())
    assert {r["message"]: r["count"] for r in store.errors(spark).groupBy("message").count().collect()} == {"name is null": 172, "mail is not unique": 1200 - 172 - len(first)}


def test_a_read_of_all_buckets_names_versions_as_a_whole(spark, tmp_path):
    store = M.Store(f"file://{tmp_path}/store", n_buckets=8)
    e = Entity("c", "c", "no", "c", "id", (Field("id", "no"),))
    M.apply(store, [e], {"c": spark.range(0, 20_000).withColumnRenamed("id", "no")}, "r")
    asked, read = [], type(spark.read).parquet
    try:
        type(spark.read).parquet = lambda self, *paths, **k: asked.extend(paths) or read(self, *paths, **k)
        assert store.target(spark, e, None, range(8)).count() == 20_000
    finally:
        type(spark.read).parquet = read
    assert not [p for p in asked if "bucket=" in p]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_test_of_cells_stands_once_in_the_plan_whatever_the_columns(spark):
    df = spark.createDataFrame([(" 1", "2024-01-02", "(555) 010-0001", "a@x.de"), ("x", "1/2/2024", "", " ")], "a string, b string, c string, d string")
    got = {(r["name"], r["transform"]): r["share"] for r in Q.cast_profile(df, df.columns).collect()}
    assert got["a", "int"] == 0.5 and got["b", "date"] == 1.0 and got["c", "phone"] == 1.0 and got["d", "email"] == 1.0 and len(got) == 32
    one, four = (len(plan_of(Q.cast_profile(df, c))) for c in (["a"], df.columns))
    assert four < 2 * one
    nothing = Q.cast_profile(df.where("a = 'none'"), ["a", "b"]).collect()
    assert len(nothing) == 16 and all(r["share"] is None for r in nothing)


def test_dates_are_tried_with_the_formats_that_their_signs_allow(spark):
    texts = ["2024-1-2", "2024-01-02 03:04:05", "2024-01-02T03:04:05Z", "2024-01-02T03:04:05.5", "1/2/2024", "13/2/2024", "1/2/2024 3:4:5", "20240102", "202401", "12024-01-02", "+12024-01-02", "-1/2/2024", "x", "2024"]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, x string")
    e = Entity("d", "d", "k", "d", "k", (Field("k", "k"), Field("d", "x", transform=("to_datetime",))))
    got = {r["k"]: str(r["d"]) for r in accepted(build_rows(e, df)).collect()}
    want = ["2024-01-02 00:00:00", "2024-01-02 03:04:05", "2024-01-02 03:04:05", "2024-01-02 03:04:05.500000", "2024-01-02 00:00:00", "2024-02-13 00:00:00", "2024-01-02 03:04:05", "2024-01-02 00:00:00"]
    assert got == dict(enumerate(want))


def test_a_path_mentions_its_value_a_fixed_number_of_times(spark):
    df = spark.createDataFrame([('{"a": [{"b": [{"c": 1}, {"c": "x"}, 3]}, {"b": {"c": null}}], "0": {"1": 5}}',), ("[[1, 2], [3]]",), ("{",)], "body string")
    at = lambda path: [r[0] for r in df.select(V.as_text(V.resolve(F.try_parse_json("body"), path))).collect()]
    assert at("a.b.c") == ['[[1,"x",null],null]', "[[null,null],[null]]", None] and at("0.1") == ["5", "2", None]
    three, four = (plan_of(df.select(V.as_text(V.resolve(F.try_parse_json("body"), p)))).count("parse_json(body") for p in ("a.b.c", "a.b.c.d"))
    assert three == four < 12


def test_rows_of_one_file_are_dealt_out_before_steps_in_python(spark, tmp_path):
    spark.range(0, 60).selectExpr("id as k", "concat('<b>', id, '</b>') as x").coalesce(1).write.parquet(f"{tmp_path}/t")
    e = Entity("t", "t", "k", "t", "k", (Field("k", "k"), Field("x", "x", transform=("strip_html",))))
    built = build_rows(e, spark.read.parquet(f"{tmp_path}/t"))
    assert built.select(F.spark_partition_id()).distinct().count() > 1
    assert sorted(r["x"] for r in accepted(built).collect()) == sorted(str(k) for k in range(60))
