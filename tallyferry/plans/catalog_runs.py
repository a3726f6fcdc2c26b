"""Queries that run whole migrations (apply, stream, verify, roll back, plan) and fold or relate tables."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from tallyferry.operators import migrate as M
from tallyferry.operators import resolve as R
from tallyferry.operators.storage import shared_dir
from tallyferry.plans.catalog import CUSTOMERS, customer_rows, nation_ids, query, t
from tallyferry.plans.mapping import Entity, Field, accepted, build_rows, plan
from tallyferry.streaming.apply import drain, file_stream, fresh_records

NATIONS = Entity("nation", "nation", "n_nationkey", "nations", "id", (Field("name", "n_name", transform=("trim",), required=True), Field("region", "n_regionkey", transform=("int",))), where="n_nationkey % 5 <> 0")
NATION_SCHEMA = "name string, region long, id long"
CUSTOMER_SCHEMA = "legacy_id long, number long, segment string, balance decimal(38,2), nation_id long, source_system string"


def new_store(spark) -> M.Store:
    return M.Store(f"{shared_dir(spark)}/migrations/{uuid.uuid4().hex}")


def migrated(spark, sf) -> M.Store:
    """Nations, which get new ids, then customers, whose nations are looked up."""
    store = new_store(spark)
    M.apply(store, [CUSTOMERS, NATIONS], {"nation": t(spark, sf, "nation"), "customers": t(spark, sf, "customer")}, "r1")
    return store


MIGRATED = """with ids as (select n_nationkey, row_number() over (order by n_nationkey) as id from nation where n_nationkey % 5 <> 0),
m as (select c_custkey as legacy_id, cast(split_part(c_name, '#', 2) as bigint) as number, case c_mktsegment when 'BUILDING' then 'B' when 'AUTOMOBILE' then 'A' else 'other' end as segment,
  round(c_acctbal, 2) as balance, ids.id as nation_id, 'legacy' as source_system, c_nationkey from customer left join ids on n_nationkey = c_nationkey)
"""
ROW = "legacy_id, number, segment, balance, nation_id, source_system"


def shown_rows(rows):
    return rows.withColumn("balance", F.col("balance").cast("double"))


@query(MIGRATED + f"select {ROW} from m where nation_id is not null")
def apply_run(spark, sf):
    """The target after a run over two entities, the parent first."""
    return shown_rows(migrated(spark, sf).target(spark, CUSTOMERS, CUSTOMER_SCHEMA))


@query(MIGRATED + "select 'customers' as entity, cast(legacy_id as varchar) as source_id, 'transform' as stage, 'nation_id: lookup: no nation for ' || c_nationkey as message from m where nation_id is null")
def apply_errors(spark, sf):
    """Children whose parent was not moved are rejected, never written."""
    return migrated(spark, sf).errors(spark).select("entity", "source_id", "stage", "message")


@query(MIGRATED + f"select {ROW} from m where nation_id is not null")
def incremental_apply(spark, sf):
    """The same target from a stream of the customers' files, with the run started twice."""
    store = new_store(spark)
    M.apply(store, [NATIONS], {"nation": t(spark, sf, "nation")}, "parents")
    folder = f"{store.root}/stream"
    rows = t(spark, sf, "customer")
    for k in range(2):
        rows.where(F.pmod(F.hash("c_custkey"), F.lit(2)) == k).write.mode("append").parquet(folder)
        drain(store, CUSTOMERS, file_stream(spark, folder, rows.schema), "streamed", f"{store.root}/offsets")
    return shown_rows(store.target(spark, CUSTOMERS, CUSTOMER_SCHEMA))


@query(MIGRATED + f"select {ROW} from m where nation_id is not null")
def apply_rollback(spark, sf):
    """A second run raises balances and adds customers; taking it back leaves the first run's rows."""
    store, c = migrated(spark, sf), t(spark, sf, "customer")
    again = replace(CUSTOMERS, name="customers", conflict="update", id_map_from="c_again", fields=(*CUSTOMERS.fields[:4], Field("nation_id", "c_nationkey", transform=({"lookup": {"entity": "nation"}}, "int")), CUSTOMERS.fields[5]))
    higher = c.where("c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    added = c.where("c_custkey % 4 = 0").withColumn("c_custkey", F.col("c_custkey") + 10_000_000)
    M.apply(store, [again], {"customers": higher.unionByName(added).withColumn("c_again", F.concat(F.lit("again "), F.col("c_custkey")))}, "r2")
    M.rollback(store, [again], {"customers": store.target(spark, CUSTOMERS, CUSTOMER_SCHEMA).schema}, spark, "r2")
    return shown_rows(store.target(spark, CUSTOMERS, CUSTOMER_SCHEMA))


@query("""with k as (select c_custkey as i, c_acctbal as b, upper('legacy') as up from customer where c_nationkey % 5 <> 0)
select 'mismatch' as kind, cast(i as varchar) as source_id, 'segment' as field, case c_mktsegment when 'BUILDING' then 'B' when 'AUTOMOBILE' then 'A' else 'other' end as expected, 'tampered' as actual
  from k join customer on c_custkey = i where i % 10 = 1
union all select 'missing', cast(i as varchar), null, null, null from k where i % 10 = 2
union all select 'source_vanished', cast(i as varchar), null, null, null from k where i % 10 = 3
union all select 'count', null, null, cast((select count(*) from customer where c_custkey % 10 <> 3) as varchar), cast((select count(*) from k) as varchar)
  where (select count(*) from k) < (select count(*) from customer where c_custkey % 10 <> 3)""")
def verify_ids(spark, sf):
    """Rows changed in the target, deleted there, or gone from the source after the run."""
    c, ids = t(spark, sf, "customer"), nation_ids(spark, sf)
    moved = c.where("c_nationkey % 5 <> 0")
    known = ids.unionByName(moved.select(F.lit("customers").alias("entity"), F.col("c_custkey").cast("string").alias("source_id"), F.col("c_custkey").cast("string").alias("target_id")))
    target = accepted(customer_rows(spark, sf)).where("legacy_id % 10 <> 2")
    target = target.withColumn("segment", F.when(F.col("legacy_id") % 10 == 1, "tampered").otherwise(F.col("segment"))).withColumn("nation_id", F.col("nation_id").cast("string"))
    return M.verify_entity(CUSTOMERS, c.where("c_custkey % 10 <> 3"), known, target)


@query("""with c as (select *, row_number() over (order by c_custkey) as r from customer where c_custkey % 4 = 0)
select 'count' as part, 'source_rows' as name, cast(count(*) as varchar) as value from customer
union all select 'count', 'would_fail', cast(count(*) as varchar) from c
union all select 'count', 'existing_keys', cast(count(*) as varchar) from customer where c_custkey % 3 = 0 and c_custkey % 4 <> 0
union all select 'failure', cast(c_custkey as varchar), 'balance: decimal: not a decimal: n/a' from c where r <= 50
union all select 'unmapped', 'note', null
union all select 'unresolved', 'nation', cast(count(*) as varchar) from customer where c_nationkey % 5 = 0 having count(*) > 0
union all select 'sample', cast(c_custkey as varchar), '{"legacy_id":' || c_custkey || ',"balance":1.00,"nation_id":' || c_nationkey + case when c_nationkey % 5 <> 0 then 1000 else 0 end || '}'
  from (select *, row_number() over (order by c_custkey) as r from customer where c_custkey % 4 <> 0) where r <= 5""")
def plan_rows(spark, sf):
    """A dry run's whole report: counts, failures, samples, lookups that nothing answers yet."""
    e = Entity("customers", "customer", "c_custkey", "customers", "legacy_id", (
        Field("legacy_id", "c_custkey", transform=("int",), required=True), Field("balance", "price", transform=("decimal",)),
        Field("nation_id", "c_nationkey", transform=({"lookup": {"entity": "nation", "required": True}}, "int")),
    ))
    source = t(spark, sf, "customer").withColumn("price", F.when(F.col("c_custkey") % 4 == 0, "n/a").otherwise("$1.00"))
    target = source.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("legacy_id"), F.lit(1.0).alias("balance"), F.lit(1).alias("nation_id"), F.lit("").alias("note"))
    return plan(e, source, target, nation_ids(spark, sf))


@query("""select c_custkey as id, '{"full":"' || c_name || '"}' as name, '[{"kind":"home","nation":"' || c_nationkey || '"}' || case when c_mktsegment = 'BUILDING' then ',{"kind":"work","nation":"site"}' else '' end || ']' as addresses from customer""")
def nested_json(spark, sf):
    """Nested targets as JSON; array entries with nothing but constants are dropped."""
    e = Entity("n", "customer", "c_custkey", "n", "id", (
        Field("id", "c_custkey"), Field("name.full", "c_name"), Field("addressList[0].kind", const="home"), Field("addressList[0].nation", "nation"),
        Field("addressList[1].kind", const="work"), Field("addressList[1].nation", "c_mktsegment", transform=({"map": {"values": {"BUILDING": "site", "*": None}}},)),
    ))
    rows = accepted(build_rows(e, t(spark, sf, "customer").withColumn("nation", F.col("c_nationkey").cast("string"))))
    text = lambda c: F.to_json(c, {"ignoreNullFields": "false"})
    return rows.select("id", text("name").alias("name"), text("addressList").alias("addresses"))


@query("""with n as (select o_orderkey as job, 1 as section, o_custkey as seq, 'status ' || o_orderstatus || case when o_orderkey % 2 = 0 then '  (today)' else '' end as content, o_orderkey % 5 = 0 as prints from orders where o_orderkey % 3 <> 0),
p as (select l_orderkey, 2, l_linenumber, 'Part: ' || case when l_linenumber % 2 = 0 then 'P' || l_partkey else 'N' || l_suppkey end || ' line item' || case when l_linenumber = 1 then ' - grey' else '' end, false from lineitem),
y as (select o_orderkey, 3, o_custkey, 'Payment (from v2, reference only): $' || cast(o_custkey as varchar) || ' on 2024' || case when o_orderkey % 2 = 0 then ' paid via card' else '' end, false from orders where o_orderkey % 4 = 0),
u as (select * from n union all select * from p union all select * from y)
select job as job_id, string_agg(content || case when prints then ' [prints]' else '' end, chr(10) order by section, seq, content) as notes from u group by job""")
def job_notes(spark, sf):
    """Notes, parts and payments of a job as one ordered list of texts."""
    o, li = t(spark, sf, "orders"), t(spark, sf, "lineitem")
    k = F.col("o_orderkey")
    notes = o.select(k.alias("job_id"), F.col("o_custkey").alias("seq"), F.when(k % 3 != 0, F.concat(F.lit(" status \n "), F.col("o_orderstatus"))).otherwise(" ").alias("body"), F.when(k % 2 == 0, " today ").alias("created_at"), (k % 5 == 0).cast("int").alias("print_on_invoice"))
    even = F.col("l_linenumber") % 2 == 0
    parts = li.select(F.col("l_orderkey").alias("job_id"), F.col("l_linenumber").alias("seq"), F.when(even, F.concat(F.lit("P"), F.col("l_partkey"))).alias("part_number"), F.concat(F.lit("N"), F.col("l_suppkey")).alias("nags_part_number"), F.lit("line   item").alias("nags_description"), F.when(F.col("l_linenumber") == 1, "grey").alias("nags_colour"))
    paid = o.where("o_orderkey % 4 = 0").select(k.alias("job_id"), F.col("o_custkey").alias("seq"), F.concat(F.lit("USD "), F.col("o_custkey")).alias("amount"), F.lit("2024").alias("paid_at"), F.when(k % 2 == 0, "paid").alias("status"), F.when(k % 2 == 0, "card").alias("processor"))
    folded = R.compose_notes(notes, parts, paid)
    return folded.select("job_id", F.array_join(F.transform("notes", lambda n: F.concat(n["content"], F.when(n["isPrintable"], " [prints]").otherwise(""))), "\n").alias("notes"))


@query("""select 'orders.customer_id' as child, 'customers.id' as parent, round((select count(distinct o_custkey) from orders where o_custkey in (select c_custkey from customer)) / (select count(distinct o_custkey) from orders), 4) as confidence
union all select 'customers.nation_no', 'nations.code', 1.0""")
def infer_relationships(spark, sf):
    """Relations that column names suggest and values prove; a column without matching values is no key."""
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("order_no"), F.col("o_custkey").alias("customer_id"), F.lit("x").alias("nation_ref"))
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation_no"), F.col("c_name").alias("name"))
    n = t(spark, sf, "nation").select(F.col("n_nationkey").alias("code"), (F.col("n_nationkey") + 100).alias("_id"))
    return R.infer_relationships({"orders": o, "customers": c, "nations": n}, {"orders": "order_no", "customers": "id", "nations": "_id"})


# ---- batches, constraints, growth


@query(MIGRATED + f"select {ROW} from m where nation_id is not null")
def apply_resume(spark, sf):
    """A run that a limit stops inside a range, resumed in ranges of the source key."""
    store = new_store(spark)
    sources = {"nation": t(spark, sf, "nation"), "customers": t(spark, sf, "customer")}
    M.apply(store, [CUSTOMERS, NATIONS], sources, "r1", limit=700, batch_rows=500)
    M.apply(store, [CUSTOMERS, NATIONS], sources, "r1", resume=True, batch_rows=6000)
    return shown_rows(store.target(spark, CUSTOMERS, CUSTOMER_SCHEMA))


CONTACTS = Entity(
    "contacts", "customer", "c_custkey", "contacts", "id",
    (Field("id", "c_custkey"), Field("name", "name"), Field("mail", "mail")), not_null=("name",), unique=("mail",),
)

CONTACT_SQL = """with c as (select c_custkey as id, case when c_custkey % 7 <> 0 then c_name end as name, case when c_custkey % 5 <> 0 then 'm' || (c_custkey // 2) || '@x' end as mail from customer),
r as (select *, row_number() over (partition by mail order by id) as k from c where name is not null)
"""


def contacts(spark, sf) -> M.Store:
    store, c = new_store(spark), t(spark, sf, "customer")
    name = F.when(F.col("c_custkey") % 7 != 0, F.col("c_name")).alias("name")
    mail = F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("m"), F.floor(F.col("c_custkey") / 2), F.lit("@x"))).alias("mail")
    M.apply(store, [CONTACTS], {"contacts": c.select("c_custkey", name, mail)}, "r1", batch_rows=10_000)
    return store


@query(CONTACT_SQL + "select id, name, mail from r where k = 1 or mail is null")
def constrained_rows(spark, sf):
    """What is written of a batch whose rows break a column's constraints."""
    return contacts(spark, sf).target(spark, CONTACTS)


@query(CONTACT_SQL + """select cast(id as varchar) as source_id, 'write' as stage, 'name is null' as message from c where name is null
union all select cast(id as varchar), 'write', 'mail is not unique' from r where k > 1 and mail is not null""")
def constrained_errors(spark, sf):
    """The others, each with the first constraint that it breaks."""
    return contacts(spark, sf).errors(spark).select("source_id", "stage", "message")


@query("""select n_nationkey as id, n_name as name, case when n_nationkey % 2 = 1 then n_regionkey end as region from nation""")
def grown_target(spark, sf):
    """A second mapping with one more column: refused as it stands, taken with ``grow``."""
    store, n = new_store(spark), t(spark, sf, "nation")
    plain = Entity("n", "nation", "n_nationkey", "n", "id", (Field("id", "n_nationkey"), Field("name", "n_name")))
    more = replace(plain, fields=(*plain.fields, Field("region", "n_regionkey")))
    M.apply(store, [plain], {"n": n.where("n_nationkey % 2 = 0")}, "r1")
    try:
        M.apply(store, [more], {"n": n}, "r2")
    except ValueError:
        M.apply(store, [more], {"n": n}, "r3", grow=True)
    return store.target(spark, more)


@query("""select 'r1' as run_id, 'apply' as mode, 'completed' as status, 2 as entities, count(*) filter (c_nationkey % 5 <> 0) + (select count(*) from nation where n_nationkey % 5 <> 0) as written, count(*) filter (c_nationkey % 5 = 0) as failed from customer
union all select 'r2', 'apply', 'stopped', 0, 0, 0""")
def run_listing(spark, sf):
    """All runs with what is done, written and failed, from the store itself; the second one knows every row up to its limit."""
    store = migrated(spark, sf)
    M.apply(store, [CUSTOMERS], {"customers": t(spark, sf, "customer").where("c_nationkey % 5 <> 0")}, "r2", limit=100)
    return M.run_history(store, spark)


@query("select distinct event_type, user_id from events")
def stream_news(spark, sf):
    """What a stream has never shown before, over two starts; no horizon forgets it."""
    folder, e = f"{shared_dir(spark)}/news/{uuid.uuid4().hex}", t(spark, sf, "events").select("event_type", "user_id")
    for k in range(2):
        e.where(F.pmod(F.hash("user_id"), F.lit(3)) != k).write.mode("append").parquet(f"{folder}/in")
        fresh = fresh_records(file_stream(spark, f"{folder}/in", e.schema), "", ["event_type", "user_id"], None)
        fresh.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/offsets").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(e.schema).parquet(f"{folder}/out")
