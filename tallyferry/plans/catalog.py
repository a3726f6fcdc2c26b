"""Registered queries of the engine and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyferry.functions.transforms import apply_chain, cell
from tallyferry.operators import quality as Q
from tallyferry.operators import resolve as R
from tallyferry.operators import responses as A
from tallyferry.operators import writes as W
from tallyferry.sources import pages as P
from tallyferry.plans.mapping import Entity, Field, accepted, build_rows, error_summary, plan_report, rejected

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(fn: Callable) -> Callable:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- scans and sources


@query("select * from customer where c_acctbal > 5000 and c_mktsegment = 'BUILDING'")
def scan_where(spark, sf):
    return t(spark, sf, "customer").where("c_acctbal > 5000 and c_mktsegment = 'BUILDING'")


@query("select * from customer where c_custkey > 100 order by c_custkey limit 500")
def scan_after_key(spark, sf):
    return t(spark, sf, "customer").where(F.col("c_custkey") > 100).orderBy("c_custkey").limit(500)


@query("select o_orderstatus, count(*) as n from orders where o_totalprice > 1000 group by 1")
def source_counts(spark, sf):
    return t(spark, sf, "orders").where("o_totalprice > 1000").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("select * from customer where cast(c_custkey as varchar) in (select cast(o_custkey as varchar) from orders where o_totalprice > 300000)")
def fetch_by_keys(spark, sf):
    keys = t(spark, sf, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").cast("string").alias("k"))
    c = t(spark, sf, "customer")
    return c.join(keys, c.c_custkey.cast("string") == keys.k, "left_semi")


@query("""
with h as (select event_type as grp, event_id as n from events),
s as (select grp, n, n - coalesce(lag(n) over (partition by grp order by n), 0) - 1 as gap from h),
b as (select grp, min(n) as cut from s where gap >= 15 group by grp)
select grp, n from s left join b using (grp) where cut is null or n < cut""")
def sequence_stop(spark, sf):
    """Series of the ids of an event type: kept until 15 ids in a row are missing."""
    return P.until_misses(t(spark, sf, "events").select(F.col("event_type").alias("grp"), F.col("event_id").alias("n")), 15, span=1000)


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_fields(spark, sf):
    return t(spark, sf, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query("select user_id, event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def explode_records(spark, sf):
    """Paged payloads opened into their records again."""
    return Q.open_pages(Q.record_pages(t(spark, sf, "events")))


@query("select 'https://crm.example/customers/' || c_name as url, c_name as parent, count(*) as orders from customer join orders on o_custkey = c_custkey where trim(c_name) <> '' group by c_name")
def child_from_parent(spark, sf):
    parents = t(spark, sf, "customer").where("trim(c_name) <> ''").select("c_custkey", "c_name")
    kids = t(spark, sf, "orders").join(parents, F.col("o_custkey") == F.col("c_custkey"))
    return kids.groupBy("c_name").agg(F.count(F.lit(1)).alias("orders")).select(F.format_string("https://crm.example/customers/%s", "c_name").alias("url"), F.col("c_name").alias("parent"), "orders")


@query("select page_id, url from pages where regexp_matches(url, 'page=[0-9]+') order by url, page_id limit 20")
def url_match(spark, sf):
    return t(spark, sf, "pages").where(F.col("url").rlike("page=[0-9]+")).orderBy("url", "page_id").limit(20).select("page_id", "url")


@query("""select page_id, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) as host,
  regexp_extract(html, '(?s)<title>(.*?)</title>', 1) as title, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) as h1 from pages""")
def html_fields(spark, sf):
    return t(spark, sf, "pages").select("page_id", F.lower(F.regexp_extract("url", r"^https?://([^/?#]+)", 1)).alias("host"), F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"), F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1).alias("h1"))


@query("select page_id, unnest(regexp_extract_all(html, '<li><a href=\"[^\"]*\">([^<]*)</a></li>', 1)) as item from pages")
def html_rows(spark, sf):
    return t(spark, sf, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<li><a href="[^"]*">([^<]*)</a></li>'), F.lit(1))).alias("item"))


@query("select sha256(regexp_replace(regexp_replace(html, '>[^<]+<', '><', 'g'), '=\"[^\"]*\"', '=\"\"', 'g')) as template, count(*) as pages from pages group by 1")
def page_templates(spark, sf):
    skeleton = F.regexp_replace(F.regexp_replace("html", ">[^<]+<", "><"), '="[^"]*"', '=""')
    return t(spark, sf, "pages").groupBy(F.sha2(skeleton, 256).alias("template")).agg(F.count(F.lit(1)).alias("pages"))


@query("select regexp_extract(url, '^https?://([^/?#]+)', 1) as collection, count(*) as stored, count(distinct url) as urls from pages group by 1")
def harvest_totals(spark, sf):
    return t(spark, sf, "pages").groupBy(F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("collection")).agg(F.count(F.lit(1)).alias("stored"), F.count_distinct("url").alias("urls"))


@query("select doc_id, lang, source from documents where text is not null and trim(text) <> '' and lang <> '' and source <> ''")
def require_fields(spark, sf):
    return t(spark, sf, "documents").where("text is not null and trim(text) <> '' and lang <> '' and source <> ''").select("doc_id", "lang", "source")


@query(" union all ".join(f"select '{n}' as table_name, count(*) as n, (select string_agg(column_name, ',' order by column_name) from (describe select * from {n})) as columns from {n}" for n in ("customer", "orders", "pages")))
def snapshot_summary(spark, sf):
    """Rows and column names of each collection."""
    return Q.snapshot({n: t(spark, sf, n) for n in ("customer", "orders", "pages")})


# ---- mapping

CUSTOMERS = Entity(
    "customers", "customer", "c_custkey", "customers", "legacy_id",
    (
        Field("legacy_id", "c_custkey", transform=("int",), required=True),
        Field("number", "c_name", transform=("trim", {"split": {"sep": "#", "index": 1}}, "int")),
        Field("segment", "c_mktsegment", transform=({"map": {"values": {"BUILDING": "B", "AUTOMOBILE": "A", "*": "other"}}},)),
        Field("balance", "c_acctbal", transform=({"decimal": {"places": 2}},)),
        Field("nation_id", "c_nationkey", transform=({"lookup": {"entity": "nation", "required": True}}, "int")),
        Field("source_system", const="legacy"),
    ),
    conflict="skip",
)

MAPPED = """
with m as (select c_custkey as legacy_id, cast(split_part(c_name, '#', 2) as bigint) as number,
  case c_mktsegment when 'BUILDING' then 'B' when 'AUTOMOBILE' then 'A' else 'other' end as segment,
  round(c_acctbal, 2) as balance, c_nationkey, case when c_nationkey % 5 <> 0 then c_nationkey::bigint + 1000 end as nation_id,
  'legacy' as source_system from customer)
"""


def nation_ids(spark, sf):
    """Id map of the nations that were moved: every fifth is missing."""
    n = t(spark, sf, "nation").where("n_nationkey % 5 <> 0")
    return n.select(F.lit("nation").alias("entity"), F.col("n_nationkey").cast("string").alias("source_id"), (F.col("n_nationkey") + 1000).cast("string").alias("target_id"))


def customer_rows(spark, sf, plan_mode=False):
    return build_rows(CUSTOMERS, t(spark, sf, "customer"), nation_ids(spark, sf), plan_mode)


@query(MAPPED + "select legacy_id, number, segment, balance, nation_id, source_system from m where nation_id is not null")
def map_customers(spark, sf):
    return accepted(customer_rows(spark, sf)).withColumn("balance", F.col("balance").cast("double"))


@query("select 'customers' as entity, cast(c_custkey as varchar) as source_id, 'transform' as stage, 'nation_id: lookup: no nation for ' || c_nationkey as message from customer where c_nationkey % 5 = 0")
def map_errors(spark, sf):
    return rejected(customer_rows(spark, sf), "customers")


@query("select 'customers' as entity, 'transform' as stage, 'nation_id: lookup: no nation for ' || c_nationkey as message, count(*) as n from customer where c_nationkey % 5 = 0 group by c_nationkey")
def error_summary_by_message(spark, sf):
    return error_summary(rejected(customer_rows(spark, sf), "customers"))


@query("select c_custkey as id, coalesce(case when c_mktsegment = 'MACHINERY' then null else lower(c_mktsegment) end, 'none') as segment from customer")
def map_defaults(spark, sf):
    e = Entity("d", "customer", "c_custkey", "d", "id", (Field("id", "c_custkey"), Field("segment", "c_mktsegment", transform=({"map": {"values": {"MACHINERY": None}}}, "lower"), default="none")))
    return accepted(build_rows(e, t(spark, sf, "customer")))


@query(MAPPED + """select count(*) as source_rows, count(*) as would_write, 0::bigint as would_fail,
  (select count(*) from customer where c_custkey % 3 = 0) as existing_keys from m""")
def plan_customers(spark, sf):
    target = t(spark, sf, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("legacy_id"))
    return plan_report(CUSTOMERS, t(spark, sf, "customer"), target, nation_ids(spark, sf))


@query()
def nested_rows(spark, sf):
    e = Entity("n", "customer", "c_custkey", "n", "id", (
        Field("id", "c_custkey"), Field("name.full", "c_name"), Field("addressList[0].kind", const="home"), Field("addressList[0].nation", "c_nationkey"),
        Field("addressList[1].kind", const="work"), Field("addressList[1].nation", "c_mktsegment", transform=({"map": {"values": {"BUILDING": "site", "*": None}}},)),
    ))
    return accepted(build_rows(e, t(spark, sf, "customer").withColumn("c_nationkey", F.col("c_nationkey").cast("string"))))


@query("select c_custkey, '{\"id\":' || c_custkey || ',\"name\":\"' || c_name || '\"}' as payload from customer")
def payload_json(spark, sf):
    return t(spark, sf, "customer").select("c_custkey", F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))).alias("payload"))


@query("""select s_suppkey, upper(trim(s_name)) as upper_name, substr(s_name, 1, 5) as cut, right(regexp_replace(s_name, '[^0-9]', '', 'g'), 4) as last_four,
  case when s_nationkey between 0 and 23 then lpad(cast(s_nationkey as varchar), 2, '0') || ':00:00' else cast(s_nationkey as varchar) end as clock,
  s_nationkey % 2 = 1 as odd, '+1' || lpad(cast(s_suppkey as varchar), 10, '5') as phone, lpad(cast(s_suppkey as varchar), 5, '0') as zip from supplier""")
def transform_catalogue(spark, sf):
    s = t(spark, sf, "supplier")
    run = lambda c, *steps: apply_chain(cell(c), steps).value
    key = F.col("s_suppkey").cast("string")
    return s.select(
        "s_suppkey", run(F.col("s_name"), "trim", "upper").alias("upper_name"), run(F.col("s_name"), {"truncate": {"length": 5}}).alias("cut"),
        run(F.col("s_name"), {"digits": {"last": 4}}).alias("last_four"), run(F.col("s_nationkey"), "clock").alias("clock"),
        run((F.col("s_nationkey") % 2).cast("string"), "bool").alias("odd"), run(F.lpad(key, 10, "5"), "phone").alias("phone"), run(F.lpad(key, 5, "0"), "postal_code").alias("zip"),
    )


# ---- joins


@query("select c_custkey, case when c_nationkey % 5 <> 0 then cast(c_nationkey + 1000 as varchar) end as nation_id from customer")
def lookup_fk(spark, sf):
    ids = nation_ids(spark, sf)
    c = t(spark, sf, "customer")
    return c.join(ids, c.c_nationkey.cast("string") == ids.source_id, "left").select("c_custkey", F.col("target_id").alias("nation_id"))


@query("select c_custkey, case when c_nationkey % 5 <> 0 then cast(c_nationkey + 1000 as varchar) else cast(c_nationkey as varchar) end as nation_id, c_nationkey % 5 = 0 as unresolved from customer")
def plan_lookups(spark, sf):
    ids = nation_ids(spark, sf)
    c = t(spark, sf, "customer")
    return c.join(ids, c.c_nationkey.cast("string") == ids.source_id, "left").select("c_custkey", F.coalesce("target_id", F.col("c_nationkey").cast("string")).alias("nation_id"), F.col("target_id").isNull().alias("unresolved"))


@query("select * from orders where o_orderkey not in (select o_orderkey from orders where o_orderkey % 4 = 0)")
def skip_migrated(spark, sf):
    o = t(spark, sf, "orders")
    done = o.where("o_orderkey % 4 = 0").select(F.col("o_orderkey").cast("string").alias("source_id"))
    return o.join(done, o.o_orderkey.cast("string") == done.source_id, "left_anti")


@query("select o_orderkey, o_custkey from orders where o_custkey not in (select c_custkey from customer where c_nationkey % 5 <> 0)")
def orphans(spark, sf):
    good = t(spark, sf, "customer").where("c_nationkey % 5 <> 0")
    o = t(spark, sf, "orders")
    return o.join(good, o.o_custkey == good.c_custkey, "left_anti").select("o_orderkey", "o_custkey")


@query("select 'nation' as entity, count(*) as n, count(*) filter (c_nationkey % 5 = 0) as misses from customer")
def lookup_health(spark, sf):
    return lookup_fk(spark, sf).agg(F.lit("nation").alias("entity"), F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("nation_id").isNull(), 1)).alias("misses"))


@query("select count(*) as existing from customer where c_custkey in (select o_custkey from orders)")
def probe_existing(spark, sf):
    c, o = t(spark, sf, "customer"), t(spark, sf, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left_semi").agg(F.count(F.lit(1)).alias("existing"))


CONTACTS = """
with c as (select cast(c_custkey as varchar) as id, 'f' || (c_custkey % 50) as fn, 'l' || (c_custkey % 40) as ln,
  case when c_custkey % 3 = 0 then '' else 'u' || (c_custkey % 700) || '@x.com' end as em,
  case when c_custkey % 4 = 0 then '' else '555' || lpad(cast(c_custkey % 900 as varchar), 7, '0') end as ph, lpad(cast(c_custkey % 97 as varchar), 5, '0') as zp from customer),
j as (select cast(o_orderkey as varchar) as id, 'f' || (o_custkey % 50) as fn, 'l' || (o_custkey % 40) as ln,
  case when o_orderkey % 2 = 0 then '' else 'U' || (o_custkey % 700) || '@X.com' end as em,
  case when o_orderkey % 3 = 0 then '1555' || lpad(cast(o_custkey % 900 as varchar), 7, '0') else '' end as ph, lpad(cast(o_custkey % 97 as varchar), 5, '0') as zp from orders),
i as (select id, fn || '|' || ln as person, 'phone' as s, nullif(ph, '') as k from c union all select id, fn || '|' || ln, 'email', nullif(em, '') from c
  union all select id, fn || '|' || ln, 'name_zip', fn || '|' || ln || '|' || zp from c),
x as (select s, k, count(distinct id) as ids, count(distinct person) as ps, min(lpad(id, 20, '0')) as low from i where k is not null group by s, k),
h as (select s, k, case when ps = 1 and (s <> 'name_zip' or ids = 1) then coalesce(nullif(ltrim(low, '0'), ''), '0') end as hit from x),
l as (select j.id, coalesce(p.hit, e.hit, z.hit) as customer_id, case when p.hit is not null then 'phone' when e.hit is not null then 'email' when z.hit is not null then 'name+zip' end as method,
  coalesce(p.k, e.k, z.k) is not null as seen from j left join h p on p.s = 'phone' and p.k = right(nullif(j.ph, ''), 10)
  left join h e on e.s = 'email' and e.k = lower(nullif(j.em, '')) left join h z on z.s = 'name_zip' and z.k = j.fn || '|' || j.ln || '|' || j.zp),
linked as (select id, customer_id, method, case when method is not null then 'matched' when seen then 'ambiguous' else 'unmatched' end as outcome from l)
"""


def contacts(spark, sf):
    c, o = t(spark, sf, "customer"), t(spark, sf, "orders")
    s = lambda k, m, w: F.lpad((F.col(k) % m).cast("string"), w, "0")
    text = lambda p, k, m: F.concat(F.lit(p), F.col(k) % m)
    people = c.select(F.col("c_custkey").cast("string").alias("id"), text("f", "c_custkey", 50).alias("first_name"), text("l", "c_custkey", 40).alias("last_name"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.concat(text("u", "c_custkey", 700), F.lit("@x.com"))).alias("email"), F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.concat(F.lit("555"), s("c_custkey", 900, 7))).alias("phone"), s("c_custkey", 97, 5).alias("zip"), F.col("c_custkey").alias("ingest"))
    jobs = o.select(F.col("o_orderkey").cast("string").alias("id"), text("f", "o_custkey", 50).alias("customer_first_name"), text("l", "o_custkey", 40).alias("customer_last_name"), F.when(F.col("o_orderkey") % 2 == 0, "").otherwise(F.concat(text("U", "o_custkey", 700), F.lit("@X.com"))).alias("customer_email"), F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("1555"), s("o_custkey", 900, 7))).otherwise("").alias("customer_phone"), s("o_custkey", 97, 5).alias("customer_zip"), F.col("o_custkey").cast("string").alias("customer_id"))
    return people, jobs


@query(CONTACTS + "select * from linked")
def link_waterfall(spark, sf):
    people, jobs = contacts(spark, sf)
    return R.link(jobs, people)


@query(CONTACTS + "select outcome, coalesce(method, '') as method, count(*) as n from linked group by 1, 2")
def link_report(spark, sf):
    people, jobs = contacts(spark, sf)
    return R.link_report(R.link(jobs, people))


ENRICH = """with j as (select o_custkey, case when o_orderkey % 2 = 0 then o_custkey end as mid, case when o_custkey % 7 = 0 then 'shared' else 'a' || o_custkey end as nm,
  case when o_orderkey % 11 = 0 then '911' when o_custkey % 5 = 0 then '555' || lpad(cast(o_orderkey % 900 as varchar), 7, '0') else '555' || lpad(cast(o_custkey % 900 as varchar), 7, '0') end as ph from orders),
g as (select * from j where length(ph) = 10),
i as (select mid as id, min(ph) as lo, max(ph) as hi from g where mid is not null group by mid),
bare as (select c_custkey as id, case when c_custkey % 7 = 0 then 'shared' else 'a' || c_custkey end as nm from customer where c_custkey % 4 = 0),
n as (select nm, min(ph) as lo, max(ph) as hi from g where nm in (select nm from bare group by nm having count(*) = 1) group by nm)
select cast(bare.id as varchar) as id, case when i.id is not null then case when i.lo = i.hi then i.lo end when n.lo = n.hi then n.lo end as phone,
  case when i.id is null and n.nm is null then 'no_source' when coalesce(i.lo, n.lo) = coalesce(i.hi, n.hi) then 'enriched' else 'ambiguous' end as outcome
from bare left join i on i.id = bare.id left join n on n.nm = bare.nm"""


@query(ENRICH)
def enrich_value(spark, sf):
    """Jobs of some customers disagree, some name no customer, some numbers are too short, some names are shared."""
    c, o = t(spark, sf, "customer"), t(spark, sf, "orders")
    named = lambda k: F.when(F.col(k) % 7 == 0, "shared").otherwise(F.concat(F.lit("a"), F.col(k)))
    seven = lambda k: F.concat(F.lit("555"), F.lpad((F.col(k) % 900).cast("string"), 7, "0"))
    people = c.select(F.col("c_custkey").alias("id"), named("c_custkey").alias("first_name"), F.lit("").alias("last_name"), F.when(F.col("c_custkey") % 4 == 0, "n/a").otherwise("(555) 123-4567").alias("phone"))
    number = F.when(F.col("o_orderkey") % 11 == 0, "911").when(F.col("o_custkey") % 5 == 0, seven("o_orderkey")).otherwise(seven("o_custkey"))
    jobs = o.select(F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("customer_id"), named("o_custkey").alias("customer_first_name"), F.lit(None).cast("string").alias("customer_last_name"), number.alias("customer_phone"))
    return R.backfill_phone(people, jobs)


@query("""with v as (select 'orders.o_custkey' as child, 'customer.c_custkey' as parent, (select count(*) from (select distinct o_custkey k from orders) where k in (select c_custkey from customer)) / (select count(distinct o_custkey) from orders) as x
  union all select 'customer.c_nationkey', 'nation.n_nationkey', (select count(*) from (select distinct c_nationkey k from customer) where k in (select n_nationkey from nation)) / (select count(distinct c_nationkey) from customer)
  union all select 'lineitem.l_partkey', 'part.p_partkey', (select count(*) from (select distinct l_partkey k from lineitem) where k in (select p_partkey from part)) / (select count(distinct l_partkey) from lineitem))
select child, parent, round(x, 4) as confidence from v where x >= 0.85""")
def infer_fks(spark, sf):
    kids = [("orders", "o_custkey"), ("customer", "c_nationkey"), ("lineitem", "l_partkey")]
    tops = [("nation", "n_nationkey"), ("customer", "c_custkey"), ("part", "p_partkey")]
    load = lambda pairs: [(n, c, t(spark, sf, n)) for n, c in pairs]
    return R.infer_keys(load(kids), load(tops), [(0, 0), (0, 1), (1, 0), (2, 0), (2, 2)])


@query("select l_orderkey, count(*) as parts, sum(l_linenumber)::bigint as line_sum, min(l_linenumber) as first_line from lineitem group by 1")
def fold_children(spark, sf):
    li = t(spark, sf, "lineitem")
    notes = R.fold_children([(1, li, "l_orderkey", "l_linenumber", F.col("l_linenumber").cast("string"), F.lit(True))], "l_orderkey")
    n = lambda x: x["content"].cast("int")
    return notes.select("l_orderkey", F.size("notes").cast("long").alias("parts"), F.aggregate("notes", F.lit(0).cast("long"), lambda a, x: a + n(x)).alias("line_sum"), n(F.col("notes")[0]).alias("first_line"))


# ---- writes


def halves(spark, sf):
    """Target: customers not divisible by 3, balances as they are. Incoming: even ones, balance 1 higher."""
    c = t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return c.where("c_custkey % 3 <> 0"), c.where("c_custkey % 2 = 0").select("c_custkey", (F.col("c_acctbal") + 1).alias("c_acctbal"))


def upsert_sql(policy: str) -> str:
    new = "case when c_custkey % 3 = 0 {} then c_acctbal + 1 else c_acctbal end".format("or c_custkey % 2 = 0" if policy == "update" else "")
    return f"select c_custkey, case when c_custkey % 3 <> 0 then c_name end as c_name, {new} as c_acctbal from customer where c_custkey % 3 <> 0 or c_custkey % 2 = 0"


@query(upsert_sql("skip"))
def upsert_skip(spark, sf):
    target, new = halves(spark, sf)
    return W.merged(new, target, "c_custkey", "skip")


@query(upsert_sql("update"))
def upsert_update(spark, sf):
    target, new = halves(spark, sf)
    return W.merged(new, target, "c_custkey", "update")


@query("select c_custkey, case when c_custkey % 3 = 0 then 'inserted' else 'failed' end as action from customer where c_custkey % 2 = 0")
def upsert_error(spark, sf):
    target, new = halves(spark, sf)
    return W.classify(new, target, "c_custkey", "error").select("c_custkey", F.col("__action").alias("action"))


@query("select count(*) filter (c_custkey % 3 = 0) as inserted, count(*) filter (c_custkey % 3 <> 0) as updated, 0::bigint as skipped, 0::bigint as failed from customer where c_custkey % 2 = 0")
def run_tally(spark, sf):
    target, new = halves(spark, sf)
    return W.tally(W.classify(new, target, "c_custkey", "update"))


@query("select 'r1' as run_id, 'customers' as entity, c_custkey as target_id, case when c_custkey % 3 = 0 then 'inserted' else 'updated' end as action, c_custkey % 3 <> 0 as has_prior from customer where c_custkey % 2 = 0")
def journal_rows(spark, sf):
    target, new = halves(spark, sf)
    j = W.journal(W.classify(new, target, "c_custkey", "update"), "r1", "customers", "c_custkey")
    return j.select("run_id", "entity", "target_id", "action", F.col("prior_row").isNotNull().alias("has_prior"))


@query("select c_custkey, c_name, c_acctbal from customer where c_custkey % 3 <> 0")
def rollback_restore(spark, sf):
    target, new = halves(spark, sf)
    j = W.journal(W.classify(new, target, "c_custkey", "update"), "r1", "customers", "c_custkey").withColumn("seq", F.lit(1))
    return W.rolled_back(W.merged(new, target, "c_custkey", "update"), j, "c_custkey")


@query("select c_custkey, 5000 + row_number() over (order by c_custkey) - 1 as id from customer where c_custkey % 2 = 1")
def assign_keys(spark, sf):
    return W.assign_keys(t(spark, sf, "customer").where("c_custkey % 2 = 1").select("c_custkey"), "c_custkey", 5000)


@query("""select c_custkey, case when c_custkey % 7 = 0 then 'email is null' else 'email is not unique' end as message from customer
where c_custkey % 7 = 0 or c_custkey // 2 in (select c_custkey // 2 from customer where c_custkey % 7 <> 0 group by 1 having count(*) > 1)""")
def constraint_errors(spark, sf):
    rows = t(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.floor(F.col("c_custkey") / 2).cast("string")).alias("email"))
    return W.constraint_errors(rows, "c_custkey", ["email"], ["email"])


@query("select user_id, max(event_id) as event_id from events group by user_id")
def staging_upsert(spark, sf):
    e = t(spark, sf, "events").select("user_id", "event_id")
    return W.last_by_key(e.withColumn("seq", F.col("event_id")), "user_id", "seq").select("user_id", "event_id")


@query("select c_custkey as id, c_name as name, null::varchar as brand from customer union all select p_partkey, p_name, p_brand from part")
def schema_growth(spark, sf):
    a = t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    b = t(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    return a.unionByName(b, allowMissingColumns=True)


@query("select 'orders' as entity, cast(o_custkey as varchar) as source_id, max(o_orderkey) as target_id from orders group by o_custkey")
def id_map_upsert(spark, sf):
    ids = t(spark, sf, "orders").select(F.lit("orders").alias("entity"), F.col("o_custkey").cast("string").alias("source_id"), F.col("o_orderkey").alias("target_id"), F.col("o_orderkey").alias("seq"))
    return W.last_by_key(ids, ("entity", "source_id"), "seq").select("entity", "source_id", "target_id")


@query("select o_orderstatus as run_id, count(distinct o_custkey) as entities, count(*) filter (o_orderpriority = '1-URGENT') as failed, count(*) as written from orders group by 1")
def run_history(spark, sf):
    return t(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("run_id")).agg(F.count_distinct("o_custkey").alias("entities"), F.count(F.when(F.col("o_orderpriority") == "1-URGENT", 1)).alias("failed"), F.count(F.lit(1)).alias("written"))


RESPONSES = """with r as (select event_id, event_id % 10 as m from events)
"""


def responses(spark, sf):
    """A response log: one call per event, statuses and bodies by the id's last digit."""
    m, e = F.col("event_id") % 10, F.col("event_id").cast("string")
    text = lambda a, z: F.concat(F.lit(a), e, F.lit(z))
    body = (
        F.when(m == 2, '{"succeeded": false, "message": "Already exists"}')
        .when(m == 3, '{"succeeded": false, "messages": ["name is missing", "zip is missing"]}')
        .when(m == 4, text('{"succeeded": true, "data": {"id": "x', '"}}'))
        .when(m == 5, text('{"succeeded": true, "data": "k', '"}'))
        .when(m == 6, '{"success": false, "message": "no such plan exists"}')
        .when(m == 7, text('[{"uuid": "u', '"}]'))
        .when(m == 8, "created")
        .otherwise(text('{"ok": true, "data": {"key": "", "guid": ', "}}"))
    )
    return t(spark, sf, "events").select("event_id", F.when(m == 0, 409).when(m == 1, 422).otherwise(200).alias("status"), body.alias("body"))


@query(RESPONSES + """select event_id, case when m in (0, 2) then 'skipped' when m in (1, 3, 6) then 'failed' else 'inserted' end as action,
  case m when 4 then 'x' || event_id when 5 then 'k' || event_id when 7 then 'u' || event_id when 9 then cast(event_id as varchar) end as target_id,
  case m when 2 then 'Already exists' when 3 then 'name is missing; zip is missing' when 6 then 'no such plan exists' when 1 then 'HTTP 422: {"ok": true, "data": {"key": "", "guid": ' || event_id || '}}'
    when 0 then 'HTTP 409: {"ok": true, "data": {"key": "", "guid": ' || event_id || '}}' end as problem from r""")
def response_outcome(spark, sf):
    return A.with_outcome(responses(spark, sf)).select("event_id", "action", "target_id", "problem")


@query(RESPONSES + "select count(*) filter (m in (4, 5, 7, 9)) as undone, count(*) as calls from r")
def undo_outcome(spark, sf):
    return responses(spark, sf).agg(F.count(F.when(A.undone(F.col("status"), F.col("body")), 1)).alias("undone"), F.count(F.lit(1)).alias("calls"))


@query("select (select count(*) from customer) as source_rows, (select count(*) from nation where n_nationkey % 5 <> 0) as recorded_ids, (select count(*) from customer where c_nationkey % 5 <> 0) as target_rows, 'nation' as entity")
def verify_counts(spark, sf):
    c = t(spark, sf, "customer")
    return W.verify_counts("nation", c, nation_ids(spark, sf), c.where("c_nationkey % 5 <> 0"))


@query("""select c_custkey, 'c_name' as "column", c_name as expected, upper(c_name) as actual from customer where c_custkey % 10 = 1 and c_name <> upper(c_name)
union all select c_custkey, '<row>', 'present', 'missing' from customer where c_custkey % 10 = 2""")
def verify_diff(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    actual = c.where("c_custkey % 10 <> 2").withColumn("c_name", F.when(F.col("c_custkey") % 10 == 1, F.upper("c_name")).otherwise(F.col("c_name")))
    return W.verify_diff(c, actual, "c_custkey")


# ---- scrubbing and profiles


@query(r"select doc_id, unnest(regexp_extract_all(text, '[0-9]{13,19}')) as token from documents")
def digit_runs(spark, sf):
    return t(spark, sf, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[0-9]{13,19}"), F.lit(0))).alias("token"))


def tokens(spark, sf):
    return digit_runs(spark, sf).select("doc_id", F.col("token").alias("note"), F.col("token").alias("card_number"), F.lit("123").alias("cvv"))


@query("select doc_id, case when length(text) > 200 then substr(text, 1, 200) || '... (+' || (length(text) - 200) || ' chars)' else text end as text, lang from documents")
def redact_sample(spark, sf):
    return Q.redact(t(spark, sf, "documents").select("doc_id", "text", "lang"))


@query("select count(*) filter (text is null or trim(text) = '') as no_text, count(*) filter (lang not in ('en', 'de', 'fr', 'es')) as odd_lang, count(*) as n from documents")
def expectations(spark, sf):
    return t(spark, sf, "documents").agg(F.count(F.when(F.col("text").isNull() | (F.trim("text") == ""), 1)).alias("no_text"), F.count(F.when(~F.col("lang").isin("en", "de", "fr", "es"), 1)).alias("odd_lang"), F.count(F.lit(1)).alias("n"))


@query("""select col as name, filled, filled >= greatest(1, n // 2) as usual from (select count(*) as n, count(*) filter (trim(lang) <> '') as a, count(*) filter (trim(source) <> '') as b from documents),
  lateral (values ('lang', a), ('source', b)) as v(col, filled)""")
def fill_rates(spark, sf):
    return Q.fill_rates(t(spark, sf, "documents").select("lang", "source"))


@query("""select case when regexp_matches(p_brand, '^[0-9]+$') then 'NUM(' || length(p_brand) || ')' else 'TEXT(' || length(trim(p_brand)) || ')' end as shape, count(*) as n from part group by 1""")
def value_shapes(spark, sf):
    return t(spark, sf, "part").groupBy(Q.value_shape(F.col("p_brand")).alias("shape")).agg(F.count(F.lit(1)).alias("n"))


def profile_sql(table: str, columns: list[str]) -> str:
    return " union all ".join(f"select '{table}' as table_name, '{c}' as column_name, count(*) as n, count(*) - count({c}) as nulls, count(distinct {c}) as distinct_values, cast(min({c}) as varchar) as least, cast(max({c}) as varchar) as greatest, count(distinct {c}) = count(*) and count(*) > 0 as is_key from {table}" for c in columns)


@query(profile_sql("customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]))
def table_profile(spark, sf):
    return Q.profile(t(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), "customer")


@query("select 'orders' as table_name, 'o_orderkey' as column_name from orders having count(distinct o_orderkey) = count(*)")
def key_profile(spark, sf):
    return Q.profile(t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "orders").where("is_key").select("table_name", "column_name")


from tallyferry.plans import catalog_inputs, catalog_pages, catalog_runs  # noqa: E402, F401  they register their queries here
