"""Queries over inputs as they come: tags, sitemaps, walks, rules, keys, steps that see their row; with their SQL."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tallyferry.functions import transforms as T
from tallyferry.functions import urls as U
from tallyferry.functions import variants as V
from tallyferry.operators import quality as Q
from tallyferry.operators import responses as A
from tallyferry.plans.catalog import query, t
from tallyferry.plans.catalog_pages import site
from tallyferry.plans.mapping import Entity, Field, accepted, build_rows, rejected
from tallyferry.sources import pages as P
from tallyferry.sources.html import PageField, extract, jsonld_types

# ---- pages


def quoted(spark, sf):
    """The pages as links whose attributes hold signs that would end a tag outside quotes."""
    i = F.col("page_id").cast("string")
    parts = ['<a title="a > b" href="/jobs/', i, '" data-method="post">x</a><div title=\'<a href="/not">\'></div><a alt=">" href="/l?x=', i, "&#38;y=2&amp;z=3\">n<abbr>&#187;</abbr></a><a rel=next href='/p/", i, "/'>&eacute;</a>"]
    return t(spark, sf, "pages").select("page_id", F.lit("https://q.example/a").alias("url"), F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts]).alias("html"))


@query("""select page_id, 'https://q.example/l?x=' || page_id || '&y=2&z=3' as href, null::varchar as reason from pages
union all select page_id, 'https://q.example/p/' || page_id || '/', null from pages
union all select page_id, 'https://q.example/jobs/' || page_id, 'data-method=post' from pages""")
def quoted_links(spark, sf):
    return P.page_links(quoted(spark, sf)).select("page_id", "href", "reason")


@query("select page_id, 'https://q.example/p/' || page_id || '/' as next_url from pages")
def quoted_next(spark, sf):
    return P.next_page(quoted(spark, sf))


@query("""select 'https://maps.example/' || page_id as url, case when page_id % 5 <> 0 then url end as loc, page_id % 5 = 0 as broken from pages""")
def sitemap_events(spark, sf):
    """Sitemaps with character data, comments and prefixes; broken ones are error rows."""
    p = t(spark, sf, "pages")
    entry = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<![CDATA["), "url", F.lit("]]>"))).otherwise(F.replace("url", F.lit("&"), F.lit("&amp;")))
    head, tail = F.lit('<?xml version="1.0"?><s:urlset xmlns:s="u" xmlns:i="i"><!-- <s:url><s:loc>gone</s:loc></s:url> --><s:url><s:loc> '), F.lit(" </s:loc><i:image><i:loc>pic</i:loc></i:image></s:url>")
    end = F.when(F.col("page_id") % 5 != 0, "</s:urlset>").otherwise("<s:url>")
    docs = p.select(F.concat(F.lit("https://maps.example/"), F.col("page_id")).alias("url"), F.concat(head, entry, tail, end).alias("xml"))
    return P.sitemap_events(docs).select("url", "loc", F.col("error").isNotNull().alias("broken"))


@query("""with e as (select event_type as grp, event_id as n, user_id as item from events),
f as (select *, min(n) over (partition by grp, item) as first from e),
h as (select distinct grp, n from f where n = first),
s as (select grp, n, n - coalesce(lag(n) over (partition by grp order by n), 0) - 1 as gap from h),
b as (select grp, min(n) as cut from s where gap >= 25 group by grp)
select grp, n, item from f left join b using (grp) where n = first and (cut is null or n < cut)""")
def walk_until_known(spark, sf):
    """A walk over event ids that ends where 25 numbers in a row show no user that is new to the event type."""
    e = t(spark, sf, "events").select(F.col("event_type").alias("grp"), F.col("event_id").alias("n"), F.col("user_id").alias("item"))
    return P.until_nothing_new(e, ["item"], 25, span=1000)


@query("""select regexp_extract(url, '^https?://([^/?#]+)', 1) as collection, count(distinct page_id) as fetched, count(*) filter (regexp_matches(html, '<h1>')) as stored, count(*) filter (not regexp_matches(html, '<h1>')) as failed from pages group by 1""")
def harvest_status(spark, sf):
    """Pages fetched, records stored and failed of each host, from the records of a harvest."""
    records = extract(t(spark, sf, "pages"), [PageField("h1", "h1", required=True)], keep=("page_id", "url"))
    return P.collection_totals(records, U.authority(F.col("url")))


@query("""select event_id, case when event_id % 3 = 0 then '[[[[' || k || ']]]]' when event_id % 3 = 1 then '[' || k || ',[' || (k + 1) || ']]' else cast(k as varchar) end as v
from (select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events)""")
def deep_paths(spark, sf):
    """A path through lists in lists, at any depth."""
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    one, next_one = F.concat(F.lit('{"b":'), k, F.lit("}")), F.concat(F.lit('{"b":'), k + 1, F.lit("}"))
    body = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("[[[["), one, F.lit("]]]]"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("["), one, F.lit(",["), next_one, F.lit("]]"))).otherwise(one)
    return t(spark, sf, "events").select("event_id", F.to_json(V.resolve(F.try_parse_json(F.concat(F.lit('{"a":'), body, F.lit("}"))), "a.b")).alias("v"))


@query("""select page_id, x as type, 1 as n from pages, unnest(['WebPage', 'Article', 'BlogPosting', 'Person']) as u(x) where page_id % 3 = 0""")
def page_jsonld_types(spark, sf):
    """The JSON-LD types of each page, from its parsed blocks."""
    return jsonld_types(site(spark, sf))


@query("""select case when page_id % 2 = 0 then 'Press ' || (page_id % 4) || ' & more' end as generator, count(*) as n from pages group by 1""")
def page_generators(spark, sf):
    """What pages say that they were made with; pages whose meta tags name something else say nothing."""
    i = F.col("page_id")
    meta = F.when(i % 2 == 0, F.concat(F.lit("<META content='Press "), (i % 4).cast("string"), F.lit(" &amp; more' name=generator />"))).otherwise('<meta name="viewport" content="name=generator">')
    return t(spark, sf, "pages").select(U.generator(F.concat(meta, F.col("html"))).alias("generator")).groupBy("generator").agg(F.count(F.lit(1)).alias("n"))


@query("""select 'events' as table_name, count(*) as n, 'even,id,k' as columns from events union all select 'supplier', count(*), 's_acctbal,s_name,s_nationkey,s_suppkey' from supplier""")
def payload_snapshot(spark, sf):
    """Rows and field names of a table, and of the JSON records that another holds."""
    i = F.col("event_id")
    body = F.concat(F.lit('{"id":'), i, F.when(i % 2 == 0, ',"even":true').otherwise(""), F.lit(',"k":{"inner":1}}'))
    return Q.snapshot({"events": t(spark, sf, "events").select(F.when(i % 7 == 0, "[1]").otherwise(body).alias("body")), "supplier": t(spark, sf, "supplier")}, {"events": "body"})


@query("""select o_orderkey, '{"o_orderkey":' || o_orderkey || ',"price":"' || printf('%.2f', o_totalprice) || '","day":"2024-02-' || lpad(cast(1 + o_orderkey % 28 as varchar), 2, '0') || '","at":"2024-01-01T00:00:0' || (o_orderkey % 10) || '","raw":"st ' || o_orderstatus || '","inner":{"n":null,"d":["2024-01-01"]}}' as payload from orders""")
def typed_payloads(spark, sf):
    """Rows as JSON payloads: decimals, dates, times and bytes as text, in structures too, nulls kept."""
    k = F.col("o_orderkey")
    rows = t(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("price"), F.to_date(F.format_string("2024-02-%02d", 1 + k % 28)).alias("day"), F.format_string("2024-01-01 00:00:0%d", k % 10).cast("timestamp_ntz").alias("at"),
        F.concat(F.lit("st "), "o_orderstatus").cast("binary").alias("raw"), F.struct(F.lit(None).cast("int").alias("n"), F.array(F.lit("2024-01-01").cast("date")).alias("d")).alias("inner"),
    )
    return rows.select("o_orderkey", A.payload(rows).alias("payload"))


# ---- rules and suggestions

RULES = (
    Q.Rule("text", required=True, most_chars=2000),
    Q.Rule("lang", required=True, allowed=("en", "de", "fr")),
    Q.Rule("source", required=True, pattern="[a-m]"),
    Q.Rule("doc_id", test="doc_id % 10 <> 3"),
)


@query("""with d as (select doc_id, [case when text is null or trim(text, ' ' || chr(9) || chr(10) || chr(13)) = '' then 'text: required' end, case when length(text) > 2000 then 'text: length' end,
  case when lang is null or trim(lang) = '' then 'lang: required' end, case when lang not in ('en', 'de', 'fr') and trim(lang) <> '' then 'lang: allowed' end,
  case when source is null or trim(source) = '' then 'source: required' end, case when not regexp_matches(source, '[a-m]') and trim(source) <> '' then 'source: pattern' end,
  case when doc_id % 10 = 3 then 'doc_id: test' end] as all_v from documents)
select cast(doc_id as varchar) as source_id, 'validate' as stage, array_to_string(list_filter(all_v, lambda x: x is not null), '; ') as message from d where len(list_filter(all_v, lambda x: x is not null)) > 0""")
def rule_violations(spark, sf):
    """Rows that break declared rules, each with all that it breaks."""
    return Q.split_by_rules(t(spark, sf, "documents"), RULES, "doc_id")[1]


KEY_COLUMNS = ("block", "place", "cust", "total")


@query("with o as (select o_orderkey // 4 as block, o_orderkey % 4 as place, o_custkey as cust, o_totalprice as total from orders) " + " union all ".join(f"select '{','.join(s)}' as columns, {len(s)} as width from o having count(*) = count(distinct ({', '.join(s)}))" for k in (1, 2) for s in combinations(KEY_COLUMNS, k) if "total" not in s))
def key_sets(spark, sf):
    """Keys of one column or two, where a row's number is split over two columns; a sum of money is no key."""
    o = t(spark, sf, "orders")
    return Q.suggest_keys(o.select(F.floor(F.col("o_orderkey") / 4).alias("block"), (F.col("o_orderkey") % 4).alias("place"), F.col("o_custkey").alias("cust"), F.col("o_totalprice").alias("total")), 2, KEY_COLUMNS[:3])


@query("""select name, steps, share from (values ('custkey', '', null::double), ('code', 'trim,nullif_empty,int', 1.0), ('balance', 'trim,nullif_empty,decimal', 1.0), ('work_phone', 'trim,nullif_empty,phone', 1.0),
  ('mail_email', 'trim,nullif_empty,email', 1.0), ('made_date', 'trim,nullif_empty,to_datetime', 1.0), ('flag', 'trim,nullif_empty,bool', 1.0), ('name', 'trim,nullif_empty', null)) as v(name, steps, share) where (select count(*) from customer) > 0""")
def suggested_steps(spark, sf):
    """Transform chains that the columns' names, types and values speak for."""
    k = F.col("c_custkey")
    own = t(spark, sf, "customer").select(
        k.alias("custkey"), F.concat(F.lit(" "), k + 1000).alias("code"), F.format_string("%.2f", "c_acctbal").alias("balance"), F.format_string("(555) 010-%04d", F.pmod(k, F.lit(10_000))).alias("work_phone"),
        F.concat("c_mktsegment", F.lit("@x.example")).alias("mail_email"), F.concat(F.lit("2024-01-0"), 1 + k % 9).alias("made_date"), F.when(k % 2 == 0, "yes").otherwise("no").alias("flag"), F.col("c_name").alias("name"),
    )
    return Q.suggest_steps(own)


# ---- steps


@T.row_transform("from_nation")
def from_nation(v, row, context, home=0):
    """A key with the nation that the row names, unless it is the home nation; the run's entity names a missing one."""
    nation = row("c_nationkey")
    return F.when(nation != home, F.concat(nation, F.lit("-"), T.text(v))).otherwise(T.text(v)), F.when(nation == 24, F.concat(F.lit(f"no {context.entity} from nation "), nation))


ABROAD = Entity("abroad", "customer", "c_custkey", "abroad", "id", (Field("id", "c_custkey"), Field("code", "c_custkey", transform=({"from_nation": {"home": 3}}, "lower"))))


@query("select c_custkey as id, case when c_nationkey <> 3 then c_nationkey || '-' || c_custkey else cast(c_custkey as varchar) end as code from customer where c_nationkey <> 24")
def row_steps(spark, sf):
    """A step that reads another column of the source row."""
    return accepted(build_rows(ABROAD, t(spark, sf, "customer")))


@query("select 'abroad' as entity, cast(c_custkey as varchar) as source_id, 'transform' as stage, 'code: from_nation: no abroad from nation 24' as message from customer where c_nationkey = 24")
def row_step_errors(spark, sf):
    return rejected(build_rows(ABROAD, t(spark, sf, "customer")), "abroad")


MORE_STEPS = Entity(
    "more", "customer", "c_custkey", "more", "id",
    (
        Field("id", "c_custkey"),
        Field("titled", "c_mktsegment", transform=("lower", "title")),
        Field("blank", "blank", transform=("nullif_empty",)),
        Field("plain", "page", transform=("strip_html",)),
        Field("slug", "page", transform=("strip_html", "slugify")),
        Field("joined", ("c_name", "blank", "c_mktsegment"), transform=({"concat": {"sep": "/"}},)),
        Field("amount", "amount", transform=("float",)),
        Field("day", "day", transform=("to_date",)),
        Field("seen", "c_custkey", transform=({"now": {"at": "2024-05-06 07:08:09"}},)),
        Field("as_json", "c_name", transform=("json_encode",)),
        Field("from_php", "php", transform=("php_unserialize",)),
        Field("safe", "page", transform=("safe_text",)),
        Field("glass", "glass", transform=("nags",)),
        Field("first", ("void", "c_mktsegment"), transform=({"coalesce": {"fallback": "none"}},)),
        Field("must", "c_name", transform=({"split": {"sep": "#", "index": 1}}, "int"), required=True),
    ),
)


@query("""select c_custkey as id, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) as titled, null::varchar as blank, c_name || ' & ' || c_mktsegment as plain,
  lower(replace(c_name, '#', '-')) || '-' || lower(c_mktsegment) as slug, c_name || '/' || c_mktsegment as joined, c_custkey + 0.5 as amount, make_date(2024, 1, 1 + cast(c_custkey % 28 as int)) as day,
  timestamp '2024-05-06 07:08:09' as seen, '"' || c_name || '"' as as_json, '{"a": ' || c_custkey || ', "b": {"0": "x"}}' as from_php, 'b' || c_name || '/b &amp; ' || c_mktsegment as safe, c_mktsegment as first, c_custkey as must
from customer""")
def more_steps(spark, sf):
    """Steps over texts, markup, serialised values and lists of columns; a required whole number."""
    source = t(spark, sf, "customer").select(
        "*", F.lit("  ").alias("blank"), F.lit("").alias("void"), F.concat(F.lit("<b>"), "c_name", F.lit("</b> &amp; "), "c_mktsegment").alias("page"), F.concat(F.lit(" "), "c_custkey", F.lit(".5")).alias("amount"),
        F.format_string("2024-01-%02d", 1 + F.col("c_custkey") % 28).alias("day"), F.concat(F.lit('a:2:{s:1:"a";i:'), "c_custkey", F.lit(';s:1:"b";a:1:{i:0;s:1:"x";}}')).alias("php"), F.concat(F.lit("DW0"), F.format_string("%04d", F.col("c_custkey") % 10_000)).alias("glass"),
    )
    return accepted(build_rows(MORE_STEPS, source)).drop("glass")
