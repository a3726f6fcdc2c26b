"""Queries over pages, payloads and calls, and over what is scrubbed from texts, with their SQL.

The given pages hold no tables, JSON-LD, next links or links to each other, so :func:`site` derives a
site from them: every page keeps its HTML and gets such parts by its id.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyferry.functions import urls as U
from tallyferry.functions import variants as V
from tallyferry.operators import quality as Q
from tallyferry.plans.catalog import query, t, tokens
from tallyferry.sources import pages as P
from tallyferry.sources.html import PageField, extract, skeletons
from tallyferry.sources.html import jsonld_types as jsonld_types_of

SITE = "https://site.example"


def site(spark, sf):
    """page_id, url, html of the derived site."""
    p = t(spark, sf, "pages")
    i = F.col("page_id")
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])
    plain = text(
        '<a href="', 2 * i + 1, '">deeper</a> <a href=\'/p/', 3 * i + 2, "#part'>more of it</a> <a href=\"../p/./", i, '/delete">x</a>',
        ' <a class="b" data-method="POST" href="/jobs/', i, '">go</a> <a href="/jobs/', i, '/x" data-confirm="Sure?">y</a>',
        ' <a href="mailto:a@b.example">m</a> <!-- <a href="/hidden">no</a> --> <a href="/files/', i, '.pdf">f</a>',
        ' <a href="https://other.example/p/1">o</a> <a href="/pic/', i, '.png?s=1">p</a>',
    )
    paging = F.when(i % 4 == 0, text(' <a rel="next" href="?page=', i + 1, '">n</a>')).when(i % 4 == 1, text(' <a href="/list/page/', i, '">&raquo;</a>')).when(i % 4 == 2, text(' <a href="/list?offset=', i, '">all</a>')).otherwise("")
    graph = text('<script type="application/ld+json">{"@graph":[{"@type":"WebPage","name":"P', i, '"},{"@type":["Article","BlogPosting"],"headline":"H', i, '","keywords":["a","b"],"author":{"@type":"Person","name":"A', i % 7, '"}}]}</script>')
    ld = F.when(i % 3 == 0, graph).when(i % 3 == 1, '<script type="application/ld+json">{"@type": "Broken", </script>').otherwise("")
    rows = text('<table class="grid"><tr><th>Code</th><th>Name</th></tr><tr data-id="', i, 'a"><td>A', i, '<td><a href="/c/', i, '">First</a></tr><tr data-id="', i, 'b"><td>B', i, "<td>Second &amp; more</tr></table>")
    form = F.when(i % 20 == 0, '<form><input name="p" type="password"></form>').otherwise("")
    url = F.when(i % 25 == 5, text(f"{SITE}/login?next=", i)).otherwise(text(f"{SITE}/p/", i))
    return p.select("page_id", url.alias("url"), F.concat("html", plain, paging, ld, F.when(i % 10 == 0, rows).otherwise(""), form).alias("html"))


UNSAFE_RE2 = U.UNSAFE.replace("'", "''")

LINKS = f"""
with own as (select page_id as i, unnest(list_distinct(regexp_extract_all(html, '<a href="([^"]*)"', 1))) as h from pages),
l as (select i, '{SITE}' || h as href, case when regexp_matches(h || '?', '{UNSAFE_RE2}') then 'looks like a state change' end as reason from own
  union all select page_id, case when page_id % 25 = 5 then '{SITE}/' else '{SITE}/p/' end || (2 * page_id + 1), null from pages
  union all select page_id, '{SITE}/p/' || (3 * page_id + 2), null from pages
  union all select page_id, '{SITE}/p/' || page_id || '/delete', 'looks like a state change' from pages
  union all select page_id, '{SITE}/jobs/' || page_id, 'data-method=post' from pages
  union all select page_id, '{SITE}/jobs/' || page_id || '/x', 'has a confirmation prompt' from pages
  union all select page_id, '{SITE}/files/' || page_id || '.pdf', null from pages
  union all select page_id, 'https://other.example/p/1', null from pages
  union all select page_id, '{SITE}/pic/' || page_id || '.png?s=1', null from pages
  union all select page_id, case page_id % 4 when 0 then case when page_id % 25 = 5 then '{SITE}/login' else '{SITE}/p/' || page_id end || '?page=' || (page_id + 1)
    when 1 then '{SITE}/list/page/' || page_id else '{SITE}/list?offset=' || page_id end, null from pages where page_id % 4 < 3
  union all select page_id, '{SITE}/c/' || page_id, null from pages where page_id % 10 = 0)
"""


@query(LINKS + "select distinct i as page_id, href from l where reason is null")
def page_links(spark, sf):
    return P.page_links(site(spark, sf)).where("reason is null").select("page_id", "href")


@query(LINKS + "select i as page_id, href, reason from l where reason is not null")
def unsafe_links(spark, sf):
    return P.page_links(site(spark, sf)).where("reason is not null").select("page_id", "href", "reason")


@query(LINKS + f"""select distinct i as page_id, href, coalesce(reason, case when regexp_matches(href, '\\.pdf') then 'file download' end) as reason
from l where href not like '%.png%' and href not like 'https://other%' and href <> '{SITE}/p/1'""")
def classified_links(spark, sf):
    """Links of the page's own host that lead to a page not seen yet."""
    seen = spark.range(1).select(F.lit(f"{SITE}/p/1").alias("href"))
    return P.classify_links(P.page_links(site(spark, sf)), seen=seen).select("page_id", "href", "reason").distinct()


@query(f"""select page_id, case page_id % 4 when 0 then case when page_id % 25 = 5 then '{SITE}/login' else '{SITE}/p/' || page_id end || '?page=' || (page_id + 1)
  when 1 then '{SITE}/list/page/' || page_id when 2 then '{SITE}/list?offset=' || page_id end as next_url from pages""")
def next_page(spark, sf):
    return P.next_page(site(spark, sf))


@query(f"""
with recursive n as (select page_id as i from pages where page_id % 25 <> 5),
e as (select i as src, 2 * i + 1 as dst from n union all select i, 3 * i + 2 from n),
r as (select 0::bigint as node, 0 as depth union all select e.dst, depth + 1 from r join e on e.src = r.node join n on n.i = e.dst where depth < 4)
select '{SITE}/p/' || node as url, min(depth) as depth from r group by node""")
def crawl_reach(spark, sf):
    """What a crawl over the pages' own links reaches in four steps."""
    return P.crawl(site(spark, sf), f"{SITE}/p/0", follow="/p/[0-9]+$", max_depth=4)


@query("select distinct url from pages where regexp_matches(url, '/en/')")
def sitemap_urls(spark, sf):
    """An index names up to 64 indexes, these name sitemaps of 200 page ids of a host, those name pages."""
    at = lambda *parts: F.concat(F.lit("https://maps.example/"), *parts, F.lit(".xml"))
    loc = lambda tag, c: F.concat(F.lit(f"<sm:{tag}><sm:loc> "), F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit(f" </sm:loc></sm:{tag}>"))
    doc = lambda root, c: F.concat(F.lit(f'<?xml version="1.0"?><sm:{root} xmlns:sm="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(F.collect_list(c), ""), F.lit(f"</sm:{root}>")).alias("xml")
    p = t(spark, sf, "pages")
    parts = p.groupBy(at(U.authority(F.col("url")), F.lit("-"), F.floor(F.col("page_id") / 200)).alias("url")).agg(doc("urlset", loc("url", F.col("url"))))
    level = parts.groupBy(at(F.lit("index-"), F.pmod(F.hash("url"), F.lit(64))).alias("index")).agg(doc("sitemapindex", loc("sitemap", F.col("url")))).withColumnRenamed("index", "url")
    top = level.groupBy(F.lit("https://maps.example/index.xml").alias("index")).agg(doc("sitemapindex", loc("sitemap", F.col("url")))).withColumnRenamed("index", "url")
    return P.sitemap_pages(parts.unionByName(level).unionByName(top), top.select("url"), match="/en/")


CLEAN = "trim(regexp_replace(regexp_replace({}, '&amp;?', '&', 'g'), '&quot;?', '\"', 'g'))"
TITLE, H1 = (CLEAN.format(f"regexp_extract(html, '(?s)<{x}>(.*?)</{x}>', 1)") for x in ("title", "h1"))


@query(f"select page_id, {TITLE} as title, {H1} as h1, array_to_string(regexp_extract_all(html, '<li><a href=\"[^\"]*\">([^<]*)</a></li>', 1), '|') as items, url as address, 'pages' as origin from pages")
def html_selectors(spark, sf):
    """Fields of whole pages by selector: text, several values, the address, a constant."""
    fields = [PageField("title", "title"), PageField("h1", "article > h1"), PageField("items", "nav li a", many=True), PageField("address", source="url"), PageField("origin", const="pages")]
    return extract(t(spark, sf, "pages"), fields).withColumn("items", F.array_join("items", "|")).drop("position", "error")


@query(f"""select page_id, position, case position when 0 then page_id || 'a' else page_id || 'b' end as id, case position when 0 then 'A' || page_id else 'B' || page_id end as code,
  case position when 0 then 'First' else 'Second & more' end as name, case position when 0 then '{SITE}/c/' || page_id end as link, {H1} as page_title
from pages, (values (0), (1)) as v(position) where page_id % 10 = 0""")
def html_table(spark, sf):
    """Records of a table's rows, each with a value of its page."""
    fields = [PageField("id", ".", attr="data-id"), PageField("code", "td:nth-of-type(1)"), PageField("name", "td:nth-of-type(2)"), PageField("link", "td a[href]", attr="href"), PageField("page_title", "h1", source="page")]
    return extract(site(spark, sf), fields, rows="table.grid tr:has(td)").drop("error")


@query("select page_id, 'link: selector ''.grid td a'' matched nothing' as error from pages where page_id % 10 <> 0")
def html_required(spark, sf):
    """Pages that lack what is required are errors, not stops."""
    return extract(site(spark, sf), [PageField("link", ".grid td a", attr="href", required=True)]).where("error is not null").select("page_id", "error")


@query("""select page_id, case when page_id % 3 = 0 then 'P' || page_id end as page_name, case when page_id % 3 = 0 then 'A' || (page_id % 7) end as author,
  case when page_id % 3 = 0 then 'H' || page_id end as headline, case when page_id % 3 = 0 then '["a", "b"]' end as keywords from pages""")
def jsonld_fields(spark, sf):
    """JSON-LD by type and path, and by path alone, anywhere in the blocks."""
    fields = [PageField("page_name", path="WebPage.name", source="jsonld"), PageField("author", path="Person.name", source="jsonld"), PageField("headline", path="headline", source="jsonld"), PageField("keywords", path="BlogPosting.keywords", source="jsonld")]
    return extract(site(spark, sf), fields).drop("position", "error")


@query("select x as type, count(*) as n from pages, unnest(['WebPage', 'Article', 'BlogPosting', 'Person']) as u(x) where page_id % 3 = 0 group by 1")
def jsonld_types(spark, sf):
    """Every @type at any depth, single or listed; blocks that are no JSON do not count."""
    return jsonld_types_of(site(spark, sf)).groupBy("type").agg(F.sum("n").alias("n"))


@query("""with li as (select page_id, url, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">[^<]*</a></li>', 1)) as h, unnest(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1)) as item,
  unnest(range(len(regexp_extract_all(html, '<li><a href="([^"]*)">[^<]*</a></li>', 1)))) as position from pages)
select page_id, item, regexp_extract(url, '^(https?://[^/?#]+)', 1) || h as link, regexp_extract(url, '^(https?://[^/?#]+)', 1) || h as _url,
  regexp_extract(url, '^(https?://[^/?#]+)', 1) || h || '#' || position as _key, timestamp '2024-01-01 00:00:00' as _fetched_at from li""")
def finalise_keys(spark, sf):
    """List items as finished records: their own address, a key, the time they were read."""
    records = extract(t(spark, sf, "pages"), [PageField("item", "a"), PageField("link", "a", attr="href")], rows="nav li", keep=("page_id", "url")).drop("error").withColumnRenamed("url", "page_url")
    return P.finalise(records, "page_url", "position", "2024-01-01 00:00:00")


@query("""with li as (select page_id, unnest(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1)) as item from pages)
select page_id, item from (select *, min(page_id) over (partition by item) as first from li) where page_id = first""")
def earlier_page_repeats(spark, sf):
    """List items that no earlier page holds; repeats within a page stay."""
    items = t(spark, sf, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<li><a href="[^"]*">([^<]*)</a></li>'), F.lit(1))).alias("item"))
    return P.without_repeats(items, "page_id", ["item"])


@query()
def page_skeletons(spark, sf):
    """Template clusters: pages by the digest of their skeleton."""
    return skeletons(site(spark, sf)).groupBy(F.sha2("skeleton", 256).alias("template")).agg(F.count(F.lit(1)).alias("pages"), F.min("page_id").alias("example"))


@query("""select page_id, array_to_string(list_filter([case when page_id % 25 = 5 then 'address' end, case when page_id % 20 = 0 then 'password input' end], lambda x: x is not null), ',') as evidence
from pages where page_id % 25 = 5 or page_id % 20 = 0""")
def login_pages(spark, sf):
    """Pages that are sign-in screens, with the evidence."""
    found = site(spark, sf).select("page_id", U.sign_in_evidence(F.col("url"), F.col("html")).alias("e"))
    return found.where(F.size("e") > 0).select("page_id", F.array_join("e", ",").alias("evidence"))


#: Signatures of the given pages besides the fixed ones.
OWN_SIGNATURES = (("tracking script", r"track\("), ("navigation list", "<nav><ul>"), ("advertisement", 'class="ad"'))


@query("select page_id, label as platform, substr(regexp_extract(html, '(?i)' || re, 0), 1, 60) as evidence from pages, (values " + ", ".join(f"('{a}', '{b}')" for a, b in (*OWN_SIGNATURES, *U.SIGNATURES)) + ") as s(label, re) where regexp_matches(html, '(?i)' || re)")
def page_platforms(spark, sf):
    found = t(spark, sf, "pages").select("page_id", F.inline(U.platforms(F.col("html"), (*OWN_SIGNATURES, *U.SIGNATURES))))
    return found.select("page_id", "platform", F.array_join("evidence", "|").alias("evidence"))


@query("""with p as (select url, trim(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/') as path from pages),
g as (select url, case when path = '' then '/' when len(string_split(path, '/')) = 1 then '/<page>' else '/' || string_split(path, '/')[1] || repeat('/<...>', len(string_split(path, '/')) - 1) end as pattern from p)
select pattern, count(*) as n, min(url) as example from g group by 1 order by n desc, pattern limit 40""")
def url_groups(spark, sf):
    """The forty most frequent address shapes."""
    return t(spark, sf, "pages").groupBy(U.url_group(F.col("url")).alias("pattern")).agg(F.count(F.lit(1)).alias("n"), F.min("url").alias("example")).orderBy(F.desc("n"), "pattern").limit(40)


@query("""with p as (select regexp_replace(regexp_extract(url, '^([^?#]*)', 1), '/[0-9]+(/|$)', '/<id>\\1', 'g') as path, list_sort(regexp_extract_all(regexp_extract(url, '\\?([^#]*)', 1), '(?:^|&)([^=&]+)=', 1)) as names from pages)
select path || case when len(names) > 0 then '?' || array_to_string(list_transform(names, lambda k: k || '=…'), '&') else '' end as pattern, count(*) as calls from p group by 1""")
def endpoint_patterns(spark, sf):
    return t(spark, sf, "pages").groupBy(U.url_pattern(F.col("url")).alias("pattern")).agg(F.count(F.lit(1)).alias("calls"))


@query("""select case event_id % 6 when 0 then 'page' when 1 then 'offset' when 2 then 'cursor' when 3 then 'page' when 4 then 'page' end as style,
  case event_id % 6 when 0 then 'page' when 1 then 'skip' when 2 then 'next_cursor' when 3 then 'page' when 4 then 'pagenumber' end as param,
  case event_id % 6 when 0 then 'per_page' when 1 then 'limit' when 3 then 'take' when 4 then 'size' end as per_page_param,
  case event_id % 6 when 0 then 50 when 1 then null when 3 then 10 + user_id % 2 when 4 then 25 end::bigint as per_page, count(*) as calls from events group by all""")
def pagination_style(spark, sf):
    """Paging of a log of calls, read off addresses and JSON bodies."""
    m, text = F.col("event_id") % 6, lambda a, c: F.concat(F.lit(a), F.col(c).cast("string"))
    url = F.when(m == 0, text("https://api.example/x?per_page=50&Page=", "event_id")).when(m == 1, text("https://api.example/x?limit=many&skip=", "event_id")).when(m == 2, text("https://api.example/x?q=1&next_cursor=", "event_id"))
    url = url.when(m == 3, F.concat(F.lit("https://api.example/x?take="), 10 + F.col("user_id") % 2)).otherwise("https://api.example/search")
    body = F.when(m == 4, F.concat(F.lit('{"pageNumber": '), F.col("event_id"), F.lit(', "size": 25, "q": "x"}')))
    logged = t(spark, sf, "events").select(U.paging(url, body).alias("p"))
    return logged.groupBy("p.style", "p.param", "p.per_page_param", "p.per_page").agg(F.count(F.lit(1)).alias("calls"))


@query("""with p as (select user_id, event_id // 500 as page, count(*) as n from events group by all)
select 'data' as wrapper, 'id,p' as fields, count(*) as payloads, sum(n)::bigint as items from p""")
def payload_shapes(spark, sf):
    """Where payloads keep their list, its records' names and how many there are."""
    shapes = Q.record_pages(t(spark, sf, "events")).select(V.payload_shape(F.col("body")).alias("s"))
    return shapes.groupBy("s.wrapper", F.array_join("s.fields", ",").alias("fields")).agg(F.count(F.lit(1)).alias("payloads"), F.sum("s.items").alias("items"))


@query("""select user_id, event_id // 500 as page, string_agg(json_extract_string(props, '$.k'), ',' order by event_id) as ks, min(event_id) as first_id from events group by all""")
def json_list_path(spark, sf):
    """A name mapped over a list, and an element by number."""
    body = F.try_parse_json("body")
    ks, first = V.as_text(V.resolve(body, "data.p.k")), V.as_text(V.resolve(body, "data.0.id"))
    return Q.record_pages(t(spark, sf, "events")).select("user_id", "page", F.regexp_replace(ks, r"[\[\]]", "").alias("ks"), first.cast("long").alias("first_id"))


# ---- scrubbing

LUHN = "list_sum([case when (length(d) - i) % 2 = 1 then case when 2 * d[i]::int > 9 then 2 * d[i]::int - 9 else 2 * d[i]::int end else d[i]::int end for i in range(1, length(d) + 1)]) % 10 = 0"
TOKENS = f"""with x as (select doc_id, unnest(regexp_extract_all(text, '[0-9]{{13,19}}')) as d from documents),
y as (select doc_id, d, regexp_matches(d, '{Q.IIN}') and {LUHN} as pan from x)
"""


@query(TOKENS + "select doc_id, d as pan from y where pan")
def pan_values(spark, sf):
    return tokens(spark, sf).select("doc_id", Q.card_digits(F.col("note")).alias("pan")).where("pan is not null")


@query(TOKENS + "select doc_id, case when pan then '•••• ' || right(d, 4) else d end as note, '•••• ' || right(d, 4) as card_number, null::varchar as cvv from y")
def scrub_rows(spark, sf):
    return Q.scrub(tokens(spark, sf))


@query(TOKENS + """select 'note' as name, 0::bigint as blocked, count(*) filter (pan) as masked, false as personal from y
union all select 'card_number', 0, count(*), false from y union all select 'cvv', count(*), 0, false from y""")
def scrub_report(spark, sf):
    return Q.scrub_report(tokens(spark, sf))


CAST_COLUMNS = {
    "c_name": "c_name",
    "c_custkey": "cast(c_custkey as varchar)",
    "since": "'2024-01-' || lpad(cast(c_custkey % 28 + 1 as varchar), 2, '0')",
    "mail": "case when c_custkey % 5 = 0 then 'x' when c_custkey % 5 = 1 then '' else 'u@x.com' end",
    "flag": "case when c_custkey % 3 = 0 then 'yes' when c_custkey % 3 = 1 then 'off' else 'maybe' end",
    "phone": "'(555) ' || lpad(cast(c_custkey % 1000 as varchar), 3, '0') || '-' || lpad(cast(c_custkey % 10000 as varchar), 4, '0')",
}
CAST_TESTS = {
    "int": "regexp_matches(v, '^[+-]?[0-9]+$')",
    "decimal": "regexp_matches(replace(replace(v, '$', ''), ',', ''), '^[+-]?[0-9]+(\\.[0-9]+)?$')",
    "bool": "lower(v) in ('1', 'true', 't', 'yes', 'y', 'on', 'active', 'enabled', '0', 'false', 'f', 'no', 'n', 'off', 'inactive', 'disabled')",
    "date": "regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')",
    "email": "v like '%@%.%'",
    "vin": "regexp_matches(upper(regexp_replace(v, '[\\s-]', '', 'g')), '^[A-HJ-NPR-Z0-9]{17}$')",
    "phone": "regexp_matches(v, '^[0-9\\s().+-]+$') and length(regexp_replace(v, '[^0-9]', '', 'g')) in (10, 11)",
    "zip": "regexp_matches(v, '^[0-9]{5}(-?[0-9]{4})?$')",
}


@query(" union all ".join(f"select '{c}' as name, '{k}' as transform, round(avg(case when {x} then 1.0 else 0.0 end) filter (v <> ''), 4) as share from (select {e} as v from customer)" for c, e in CAST_COLUMNS.items() for k, x in CAST_TESTS.items()))
def cast_profile(spark, sf):
    c = t(spark, sf, "customer").selectExpr(*[f"{e.replace('varchar', 'string')} as {c}" for c, e in CAST_COLUMNS.items()])
    return Q.cast_profile(c, list(CAST_COLUMNS))
