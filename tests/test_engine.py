"""Transforms against literal pairs, and every query with SQL against DuckDB."""

import glob
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyferry.functions.transforms import apply_chain, cell, identifier, same_value
from tallyferry.operators import quality as Q
from tallyferry.operators import resolve as R
from tallyferry.plans import catalog
from tallyferry.plans.mapping import Entity, Field, build_rows, in_order

SF = "/root/testdata/sf0.001"

PAIRS = [
    ("trim", "  a\t", "a"),
    ("title", "o'brien and SONS", "O'Brien And Sons"),
    ("nullif_empty", " \n", None),
    ({"split": {"sep": "#", "index": 1}}, "a#b", "b"),
    ({"split": {"sep": "#", "index": 5}}, "a#b", None),
    ({"split": {"sep": "#", "index": -1}}, "a#b", "b"),
    ("int", " 42 ", 42),
    ("int", "3.0", "error"),
    ("float", "x", "error"),
    ("decimal", "$1,250.005", "1250.00"),
    ("bool", "Y", True),
    ("bool", "maybe", "error"),
    ("to_datetime", "0000-00-00 00:00:00", None),
    ("to_datetime", "1/2/2024", "2024-01-02 00:00:00"),
    ("to_datetime", "25/12/2024", "2024-12-25 00:00:00"),
    ("to_datetime", "nonsense", "error"),
    ("phone", "(555) 123-4567", "+15551234567"),
    ("phone", "n/a", None),
    ({"digits": {"last": 4}}, "12-3456", "3456"),
    ("safe_text", "VERSA`<b>", "VERSAb"),
    ("clock", "8", "08:00:00"),
    ("clock", "77", "77"),
    ("email", " A@B.Com ", "a@b.com"),
    ({"email": {"strict": True}}, "nope", "error"),
    ("vin", "1hg-cm8", "1HGCM8"),
    ("postal_code", "123456789", "12345-6789"),
    ({"map": {"values": {"A": "x", "*": "z"}}}, "A", "x"),
    ({"map": {"values": {"A": "x"}, "strict": True}}, "B", "error"),
    ("strip_html", "<p>a &amp; b</p><script>x</script>", "a & b"),
    ("slugify", "Café del Mar!", "cafe-del-mar"),
    ("php_unserialize", 'a:1:{s:1:"k";i:5;}', '{"k": 5}'),
    ("strip_html", "a<script>x</script>b<br/>c", "a b\nc"),
    ("float", "1.0d", "error"),
    ("float", "2f", "error"),
    ("float", " 1e3 ", "1000.0"),
    ("float", "", None),
    ("to_datetime", "2024-01-02T03:04:05", "2024-01-02 03:04:05"),
    ("to_datetime", "2024-01-02T03:04:05+02:00", "2024-01-02 01:04:05"),
    ("to_datetime", "20240102", "2024-01-02 00:00:00"),
    ("to_datetime", "5550001201", "error"),
    ("to_datetime", "2024", "error"),
    ({"to_datetime": {"at": "12:00:00"}}, "2024-01-02", "2024-01-02 12:00:00"),
    ("to_date", "1/2/2024", "2024-01-02"),
    ({"now": {"at": "2024-05-06 07:08:09"}}, "x", "2024-05-06 07:08:09"),
    ({"map": {"values": {"A": "x"}, "strict": True}}, None, "error"),
    ({"map": {"values": {"A": "x", None: "none"}, "strict": True}}, None, "none"),
    ({"map": {"values": {"A": "x", "*": "z"}}}, None, "z"),
    ({"map": {"values": {"A": "x"}}}, "B", "B"),
    ({"map": {"values": {"A": None}}}, "A", None),
    ("nags", " fw 02 ", "FW02"),
    ("nags", "  ", None),
    ("json_encode", 'a"b', '"a\\"b"'),
    ("json_encode", None, None),
    ("json_decode", "{bad", None),
    ({"json_decode": {"strict": True}}, "{bad", "error"),
    ("json_decode", '{"a":[1,2]}', '{"a":[1,2]}'),
    ({"truncate": {"length": 3}}, "abcdef", "abc"),
    ("upper", "x", "X"),
]


@pytest.mark.parametrize("step,given,want", PAIRS, ids=[f"{i}" for i in range(len(PAIRS))])
def test_transform(spark, step, given, want):
    got = apply_chain(cell(F.col("v")), [step])
    row = spark.createDataFrame([(given,)], "v string").select(got.value.cast("string").alias("v"), got.error.alias("e")).first()
    if want == "error":
        assert row["v"] is None and row["e"]
    else:
        assert row["e"] is None and row["v"] == (None if want is None else str(want).lower() if isinstance(want, bool) else str(want))


def test_numbers_are_unix_seconds(spark):
    df = spark.createDataFrame([(1700000000, 1700000000.5)], "i long, d double")
    row = df.select(apply_chain(cell(F.col("i")), ["to_datetime"]).value.cast("string"), apply_chain(cell(F.col("d")), ["to_datetime"]).value.cast("string"), apply_chain(cell(F.col("i")), ["to_date"]).value.cast("string")).first()
    assert list(row) == ["2023-11-14 22:13:20", "2023-11-14 22:13:20.5", "2023-11-14"]


def test_several_columns_join_and_fall_back(spark):
    parts = F.array(F.lit(" a "), F.lit(None).cast("string"), F.lit(" "), F.lit("b"))
    row = spark.range(1).select(apply_chain(cell(parts), ["concat"]).value, apply_chain(cell(parts), [{"coalesce": {"fallback": "z"}}]).value, apply_chain(cell(F.array(F.lit(""), F.lit(None).cast("string"))), [{"coalesce": {"fallback": "z"}}]).value).first()
    assert list(row) == ["a b", " a ", "z"]


def test_identifiers(spark):
    got = spark.createDataFrame([("Job No. 7",), ("2nd line",), ("x" * 50,)], "v string").select(identifier(F.col("v"))).collect()
    assert [r[0] for r in got] == ["job_no_7", "c_2nd_line", "x" * 40]


@pytest.mark.parametrize(
    "a,b,same",
    [
        (("07001", "string"), ("7001", "string"), False),
        (("7001", "string"), (7001, "int"), True),
        (("x", "string"), (None, "int"), False),
        ((None, "string"), (None, "int"), True),
        ((True, "boolean"), (1, "int"), True),
        ((True, "boolean"), ("true", "string"), False),
        ((" a ", "string"), ("a", "string"), True),
        (("1.0d", "string"), (1, "int"), False),
        ((2.5, "double"), ("2.50", "string"), True),
    ],
)
def test_values_are_compared_across_types(spark, a, b, same):
    row = spark.createDataFrame([(a[0], b[0])], f"a {a[1]}, b {b[1]}").select(same_value(F.col("a"), a[1], F.col("b"), b[1])).first()
    assert row[0] is same


def test_unknown_step_is_refused():
    with pytest.raises(ValueError):
        Field("a", "b", transform=("nope",))


def test_first_error_follows_field_order(spark):
    e = Entity("x", "s", "id", "t", "id", (Field("a", "a", transform=("int",)), Field("b", "b", transform=("int",))))
    row = build_rows(e, spark.createDataFrame([("1", "p", "q")], "id string, a string, b string")).first()
    assert row["__error"].startswith("a: ")


def test_order_and_cycle():
    f = (Field("id", "id"),)
    a, b = Entity("a", "s", "id", "t", "id", f, depends_on=("b",)), Entity("b", "s", "id", "t", "id", f)
    assert [e.name for e in in_order([a, b])] == ["b", "a"]
    with pytest.raises(ValueError):
        in_order([a, Entity("b", "s", "id", "t", "id", f, depends_on=("a",))])


def test_link_refuses_a_household(spark):
    people = spark.createDataFrame([("1", "Ann", "Lee", "", "5551234567", "1", 1), ("2", "Bob", "Lee", "", "5551234567", "1", 2)], "id string, first_name string, last_name string, email string, phone string, zip string, ingest int")
    jobs = spark.createDataFrame([("j", "X", "Y", "", "15551234567", "9")], "id string, customer_first_name string, customer_last_name string, customer_email string, customer_phone string, customer_zip string")
    assert R.link(jobs, people).first()["outcome"] == "ambiguous"


def test_scrub(spark):
    df = spark.createDataFrame([("4111 1111 1111 1111", "123", "ssn 123-45-6789", "4111111111111112")], "note string, cvv string, other string, ref string")
    row = Q.scrub(df).first()
    assert row["note"] == "•••• 1111" and row["cvv"] is None and row["other"] == "ssn •••-••-####" and row["ref"] == "4111111111111112"


def test_redaction_hides_secrets_by_name(spark):
    df = spark.createDataFrame([("h", "4111", "k", "a@b.c", "y" * 203, None)], "pwd_hash string, card string, api_key string, email string, note string, Auth_Token string")
    row = Q.redact(df).first()
    assert [row["pwd_hash"], row["card"], row["api_key"], row["email"], row["Auth_Token"]] == ["<redacted>"] * 3 + ["a@b.c", None]
    assert row["note"] == "y" * 200 + "... (+3 chars)"


def test_scrub_report_names_personal_data(spark):
    df = spark.createDataFrame([("4111111111111111", None, "Ann", 7)], "note string, cvv string, first_name string, state int")
    assert sorted(map(tuple, Q.scrub_report(df).collect())) == [("cvv", 1, 0, False), ("first_name", 0, 0, True), ("note", 0, 1, False)]


def same(v):
    if v is None or isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(p).split('.')[0]} as select * from '{p}'")
    want = con.sql(catalog.ORACLES[name])
    got = catalog.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    expected = sorted((tuple(same(r[i]) for i in at) for r in want.fetchall()), key=repr)
    assert sorted((tuple(same(r[c]) for c in columns) for r in got.collect()), key=repr) == expected


def test_record_pages_are_bounded_and_hold_every_record(spark):
    """One user has most rows; ids, users and payloads may be null."""
    rows = [(1 if i % 10 else i, i, f'{{"k":{i % 7}}}') for i in range(4000)] + [(None, 4001, '{"k":1}'), (2, None, '{"k":2}'), (2, 4002, None)]
    pages = Q.record_pages(spark.createDataFrame(rows, "user_id long, event_id long, props string"))
    assert max(r["body"].count('"id":') for r in pages.collect()) <= 500
    want = [(u, e, None if p is None else int(p[5:-1])) for u, e, p in rows]
    assert sorted(map(tuple, Q.open_pages(pages).collect()), key=repr) == sorted(want, key=repr)
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert Q.open_pages(Q.record_pages(events)).count() == events.count()
