"""Entity resolution and back-fill: mostly refusals; folding and relations by name."""

import pytest

from tallyferry.operators import resolve as R

PERSON = "id string, first_name string, last_name string, email string, phone string, alt_phone string, zip string, ingest int"
JOB = "id string, customer_first_name string, customer_last_name string, customer_email string, customer_phone string, customer_zip string, customer_id string"


def linked(spark, people, job):
    jobs = spark.createDataFrame([("j", *job, None)], JOB)
    return tuple(R.link(jobs, spark.createDataFrame([(*p, i) for i, p in enumerate(people)], PERSON)).first())[1:]


ANN, BOB = ("1", "Ann", "Lee", "ann@x.com", "(555) 123-4567", "", "10001"), ("2", "Bob", "Lee", "", "5551234567", None, "10002")


@pytest.mark.parametrize(
    "people,job,want",
    [
        ([ANN], ("X", "Y", "", "1-555-123-4567", "9"), ("1", "phone", "matched")),
        ([("12", *ANN[1:]), ("9", *ANN[1:])], ("X", "Y", "", "5551234567", "9"), ("9", "phone", "matched")),
        ([ANN, BOB], ("X", "Y", "", "5551234567", "9"), (None, None, "ambiguous")),
        ([ANN, BOB], ("X", "Y", " ANN@x.com", "5551234567", "9"), ("1", "email", "matched")),
        ([("1", "A", "B", "", "911", "", "")], ("X", "Y", "", "911", ""), (None, None, "unmatched")),
        ([("1", "A", "B", "", "", "555-000-1111", "")], ("X", "Y", "", "5550001111", ""), ("1", "phone", "matched")),
        ([ANN], ("ann", " lee ", "", "", "10001"), ("1", "name+zip", "matched")),
        ([ANN], ("ann", "lee", "", "", "10-001"), ("1", "name+zip", "matched")),
        ([("1", "A", "B", "", "", "", None)], ("a", "b", "", "", ""), ("1", "name+zip", "matched")),
        ([ANN], ("ann", "lee", "", "", "20002"), (None, None, "unmatched")),
        ([ANN, ("3", "Ann", "Lee", "", "", "", "10001")], ("ann", "lee", "", "", "10001"), (None, None, "ambiguous")),
        ([ANN], ("", "", None, None, None), (None, None, "unmatched")),
    ],
)
def test_link(spark, people, job, want):
    assert linked(spark, people, job) == want


def test_backfill_refuses_what_is_uncertain(spark):
    people = [("1", "A", "X", "", "", "", ""), ("2", "B", "X", "", "", "", ""), ("3", "C", "X", "", "", "", ""), ("4", "C", "X", "", "n/a", "", ""), ("5", "D", "X", "", "", "5550000000", ""), ("6", "E", "X", "", "911", "", "")]
    job = lambda k, first, number, of: (k, first, "X", "", number, "", of)
    jobs = [
        job("a", "A", "5551111111", "1"), job("b", "A", "5552222222", "1"), job("c", "A", "5553333333", None),  # matched jobs disagree: the name does not help
        job("d", "B", "15554444444", "2"), job("e", "B", "555-444-4444", "2"), job("f", "B", "5559999999", None),
        job("g", "C", "5555555555", None), job("h", "E", "911", "6"), job("i", "E", "5556666666", None),
    ]
    got = R.backfill_phone(spark.createDataFrame([(*p, i) for i, p in enumerate(people)], PERSON), spark.createDataFrame(jobs, JOB))
    assert sorted(map(tuple, got.collect())) == [("1", None, "ambiguous"), ("2", "5554444444", "enriched"), ("3", None, "no_source"), ("4", None, "no_source"), ("6", "5556666666", "enriched")]


def test_notes_have_their_texts(spark):
    notes = spark.createDataFrame([("j", 2, "second", None, 0), ("j", 1, " first\n line ", "1 May", 1), ("j", 3, "  ", "x", 1)], "job_id string, seq int, body string, created_at string, print_on_invoice int")
    parts = spark.createDataFrame([("j", 1, "", "FW02", "Front", "grey"), ("j", 2, None, None, None, None)], "job_id string, seq int, part_number string, nags_part_number string, nags_description string, nags_colour string")
    paid = spark.createDataFrame([("j", 1, "USD 12.50", "2 May", "paid", "card"), ("j", 2, "", "", "", "")], "job_id string, seq int, amount string, paid_at string, status string, processor string")
    (row,) = R.compose_notes(notes, parts, paid).collect()
    assert [tuple(n) for n in row["notes"]] == [("first line  (1 May)", True), ("second", False), ("Part: FW02 Front - grey", False), ("Payment (from v2, reference only): $12.50 on 2 May paid via card", False)]


def test_relations_need_values_not_names_alone(spark):
    tables = {
        "orders": spark.createDataFrame([(1, 10, 77), (2, 11, 78)], "id int, customer_id int, vehicle_id int"),
        "customers": spark.createDataFrame([(900, 10), (901, 11)], "_id int, id int"),
        "vehicles": spark.createDataFrame([(1,), (2,)], "id int"),
    }
    found = R.candidate_keys(tables, {"customers": "_id", "orders": "id"})
    assert ("orders", "customer_id", "customers", "_id") in found and ("orders", "id", "orders", "id") not in found
    assert [tuple(r) for r in R.infer_relationships(tables, {"customers": "_id", "orders": "id"}).collect()] == [("orders.customer_id", "customers.id", 1.0)]
    assert R.infer_relationships({"t": tables["vehicles"]}).count() == 0
