"""Tags, references, sitemaps, deep inputs, walks without news, rules, suggestions and steps that see their row."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyferry.functions import transforms as T
from tallyferry.functions import urls as U
from tallyferry.functions import variants as V
from tallyferry.operators import quality as Q
from tallyferry.operators import resolve as R
from tallyferry.operators import responses as A
from tallyferry.plans.mapping import Entity, Field, accepted, build_rows
from tallyferry.sources import html as H
from tallyferry.sources import pages as P
from tallyferry.streaming.apply import file_stream, fresh_records, state_on_disk


def pages(spark, html, url="https://x.example/a/b"):
    return spark.createDataFrame([(1, url, html)], "page_id int, url string, html string")


def links(spark, html, pattern=None):
    return [(r["href"].removeprefix("https://x.example"), r["reason"]) for r in P.page_links(pages(spark, html), pattern).orderBy("position").collect()]


def test_attributes_end_where_their_quotes_end(spark):
    assert links(spark, '<a href="/jobs/1" title="a > b" data-method="post">x</a>') == [("/jobs/1", "data-method=post")]
    assert links(spark, """<a title="x>y" href="/ok">1</a><A HREF='/two' title='"'>2</A><a href=/three/ >3</a><a href="/4"class="q">4</a>""") == [("/ok", None), ("/two", None), ("/three/", None), ("/4", None)]
    assert links(spark, """<div title='<a href="/not">'>t</div><img alt="a>b<a href=/no>"><a href="/yes">y</a>""") == [("/yes", None)]
    assert links(spark, '<a href="/open">one <a href="/second" data-confirm="Sure?">two') == [("/open", None), ("/second", "has a confirmation prompt")]
    assert links(spark, '<a name="n">no link</a><a href="/l" href="/other" DATA-METHOD="GET">l</a><abbr href="/q">q</abbr><a\nhref\n=\n"/new"\n>n</a>') == [("/l", None), ("/new", None)]
    assert links(spark, '<a href="/x' + "y" * 30_000 + '">' + "word " * 20_000 + "</a>")[0][1] is None


def test_references_are_decoded(spark):
    assert links(spark, '<a href="/l?x=1&#38;y=2">a</a><a href="/m?x=1&#x26;y=2&amp;z=3&notin;">b</a>') == [("/l?x=1&y=2", None), ("/m?x=1&y=2&z=3∉", None)]
    rows = [("&#187; &eacute;&Eacute;&euro;&#x1F600;", "» éÉ€😀"), ("&amp;lt; &nope; & &#0; &#xD800; &#38x", "&lt; &nope; & � � &x"), ("plain", "plain"), (None, None), ("&amp;", "&")]
    got = spark.createDataFrame(rows, "a string, b string").select(U.unescaped(F.col("a")).alias("a"), "b").collect()
    assert all(r["a"] == r["b"] for r in got)
    found = P.next_page(pages(spark, '<a href="/l/2">&#187;</a>')).first()["next_url"]
    assert found == "https://x.example/l/2"
    assert P.next_page(pages(spark, '<a href="/n">ne<abbr title="</a>">x</abbr>t</a> <a href="/o" rel="next">o</a>')).first()["next_url"] == "https://x.example/o"
    assert pages(spark, "<meta content='WordPress 6.4 &amp; more' NAME=generator><meta name='x' content='y'>").select(U.generator(F.col("html")).alias("g")).first()["g"] == "WordPress 6.4 & more"


def test_sitemaps_are_read_as_xml(spark):
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:image="i"'
    docs = [
        ("a", f'<?xml version="1.0"?><urlset {ns}><url><loc><![CDATA[https://x/?a=1&b=2]]></loc><image:image><image:loc>https://x/pic</image:loc></image:image></url><!-- <url><loc>https://x/gone</loc></url> --><url><loc> https://x/&#50; </loc></url></urlset>'),
        ("b", f"<s:sitemapindex xmlns:s='u'><s:sitemap><s:loc>https://x/s1</s:loc></s:sitemap></s:sitemapindex>"),
        ("c", "<urlset><url><loc>https://x/broken</loc>"), ("d", None), ("e", ""), ("f", "<list><loc>https://x/bare</loc></list>"),
    ]
    got = P.sitemap_events(spark.createDataFrame(docs, "url string, xml string")).collect()
    assert sorted((r["url"], r["kind"], r["loc"]) for r in got if r["error"] is None) == [("a", "page", "https://x/2"), ("a", "page", "https://x/?a=1&b=2"), ("b", "sitemap", "https://x/s1"), ("f", "page", "https://x/bare")]
    assert {r["url"] for r in got if r["error"]} == {"c", "e"}


def test_no_input_stops_a_job(spark):
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert H.skeleton(H.parse(deep)).count("<div>") == 5000 and H.parse(deep).inner().count("<div>") == 5000
    nested = "[" * 100_000 + "]" * 100_000
    table = spark.createDataFrame([(1, "u", f'<script type="application/ld+json">{nested}</script><script type="application/ld+json">{{"@type":"Job","title":"t"}}</script><p>{deep}</p>')], "page_id int, url string, html string")
    got = H.extract(table, [H.PageField("title", source="jsonld", path="Job.title"), H.PageField("inner", selector="p", attr="html")]).collect()
    assert [r["title"] for r in got] == ["t"] and H.skeletons(table).count() == 1
    value = "i:7;"
    for k in range(1500):
        value = f"a:1:{{i:{k};{value}}}"
    assert T.php_value('a:2:{s:1:"a";a:1:{i:0;s:2:"é";}i:5;N;}') == {"a": {"0": "é"}, "5": None}
    steps = T.apply_chain(T.cell(F.col("v")), ["php_unserialize"])
    rows = spark.createDataFrame([(value,), ("b:1;",), ("a:1:{i:0;",), ("x",)], "v string").select(steps.value.alias("v"), steps.error.alias("e")).collect()
    assert rows[1]["v"] == "true" and [r["e"] is None for r in rows][1:] == [True, False, False]


def test_paths_go_through_lists_of_any_depth(spark):
    rows = ['{"a":[[[[{"b":1}]]]]}', '{"a":[[{"b":1}],{"b":2},3]}', '{"a":{"b":5}}', None, '{"a":[]}']
    got = spark.createDataFrame([(r,) for r in rows], "j string").select(F.to_json(V.resolve(F.try_parse_json("j"), "a.b")).alias("v")).collect()
    assert [r["v"] and json.loads(r["v"]) for r in got] == [[[[[1]]]], [[1], 2, None], 5, None, []]


def test_a_walk_ends_where_numbers_give_nothing_new(spark):
    records = [("g", 1, "a"), ("g", 1, "a"), ("g", 2, "b"), ("g", 3, "a"), ("g", 4, "c"), ("g", 5, "a"), ("g", 6, "b"), ("g", 7, "c"), ("g", 9, "d"), ("h", 1, "a"), ("h", 4, "z")]
    table = spark.createDataFrame(records, "grp string, n long, item string")
    walk = lambda budget: sorted(map(tuple, P.until_nothing_new(table, ["item"], budget).collect()))
    assert walk(3) == [("g", 1, "a"), ("g", 1, "a"), ("g", 2, "b"), ("g", 4, "c"), ("h", 1, "a"), ("h", 4, "z")]
    assert walk(2)[-1] == ("h", 1, "a") and walk(1) == [("g", 1, "a"), ("g", 1, "a"), ("g", 2, "b"), ("h", 1, "a")]
    assert ("g", 9, "d") in walk(9)


def test_rules_name_all_that_a_row_breaks(spark):
    rules = [Q.Rule("name", required=True, most_chars=5), Q.Rule("kind", allowed=("a", "b")), Q.Rule("n", test="n > 0"), Q.Rule("zip", pattern="^[0-9]{5}$", required=True)]
    rows = [(1, "ok", "a", 1, "12345"), (2, " ", "c", -1, "1"), (3, "too long", None, None, "12345"), (4, None, "b", 0, None)]
    table = spark.createDataFrame(rows, "id int, name string, kind string, n int, zip string")
    good, errors = Q.split_by_rules(table, rules, "id")
    assert [r["id"] for r in good.collect()] == [1] and good.columns == table.columns
    assert {r["source_id"]: r["message"] for r in errors.collect()} == {"2": "name: required; kind: allowed; n: test; zip: pattern", "3": "name: length", "4": "name: required; n: test; zip: required"}
    assert {r["rule"]: r["broken"] for r in Q.rule_counts(table, rules).collect()}["name: required"] == 2
    with pytest.raises(ValueError, match="absent"):
        Q.judged(table, [Q.Rule("nope", required=True)])
    assert Q.judged(table, []).where("size(violations) > 0").count() == 0


def test_keys_of_one_column_and_of_several(spark):
    table = spark.createDataFrame([(i // 4, i % 4, i % 2, i if i else None, "x") for i in range(200)], "a int, b int, c int, d int, e string")
    assert [tuple(r) for r in Q.suggest_keys(table).collect()] == [("a,b", 2)]
    assert [tuple(r) for r in Q.suggest_keys(table.where("d is not null")).collect()] == [("d", 1), ("a,b", 2)]
    assert Q.suggest_keys(table.where("false")).count() == 0


def test_steps_follow_names_types_and_values(spark):
    table = spark.createDataFrame([(i, "(555) 010-%04d" % i, str(i), "1.50", "2024-01-02", "word", f"u{i}@x.example", "yes") for i in range(40)], "id int, home_phone string, amount string, price string, made_at string, note string, email string, flag string")
    got = {r["name"]: (r["steps"], r["share"]) for r in Q.suggest_steps(table).collect()}
    assert got["id"] == ("", None) and got["home_phone"][0] == "trim,nullif_empty,phone" and got["amount"][0] == "trim,nullif_empty,int" and got["price"][0] == "trim,nullif_empty,decimal"
    assert got["made_at"][0] == "trim,nullif_empty,to_datetime" and got["note"] == ("trim,nullif_empty", None) and got["email"][0] == "trim,nullif_empty,email"


def test_names_match_by_their_forms():
    assert R.name_forms("Companies") & R.name_forms("company") and R.name_forms("boxes") & R.name_forms("box") and R.name_forms("statuses") & R.name_forms("status")
    assert not R.name_forms("customers") & R.name_forms("orders")


def test_steps_see_their_row_and_run(spark):
    @T.row_transform("with_country")
    def with_country(v, row, context, sign="+"):
        return F.when(row("country") == "US", F.concat(F.lit(sign + "1"), v)).otherwise(v), F.when(row("country").isNull(), F.lit(f"no country in {context.entity} of {context.run_id}"))

    @T.arrow_transform("halved", columns=("n",))
    def halved(v, row, context, by=2):
        return f"{int(v) // by}/{row['n']}"

    e = Entity("calls", "s", "id", "t", "id", (Field("id", "id"), Field("phone", "phone", transform=("trim", "with_country")), Field("half", "phone", transform=({"halved": {"by": 5}}, "upper"))))
    source = spark.createDataFrame([(1, " 50 ", "US", 7), (2, "60", "DE", 8), (3, "x", "US", 9), (4, "70", None, 1), (5, None, "US", 1)], "id int, phone string, country string, n int")
    rows = build_rows(e, source, run_id="r9")
    assert sorted(map(tuple, accepted(rows).collect())) == [(1, "+150", "10/7"), (2, "60", "12/8"), (5, None, None)]
    errors = {r["__key"]: r["__error"] for r in rows.where("__error is not null").collect()}
    assert errors["4"] == "phone: with_country: no country in calls of r9" and errors["3"].startswith("half: halved: ValueError")


def test_content_comes_once_for_good_and_over_restarts(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    state_on_disk(spark)
    try:
        folder, schema = f"file://{tmp_path}/in", "at timestamp, item string"
        for day, items in ((1, ["a", "b", "a", None]), (40, ["a", "c", None])):  # long after any horizon, by a new start
            spark.createDataFrame([(dt.datetime(2024, 1, 1) + dt.timedelta(days=day), x) for x in items], schema).write.mode("append").parquet(folder)
            stream = fresh_records(file_stream(spark, folder, spark.createDataFrame([], schema).schema), "at", ["item"], None)
            stream.writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
        assert sorted((r["item"] for r in spark.read.parquet(f"file://{tmp_path}/out").collect()), key=str) == [None, "a", "b", "c"]
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_payloads_hold_what_json_can_carry(spark):
    row = (dt.date(2024, 2, 3), dt.datetime(2024, 2, 3, 4, 5, 6, 70), dt.datetime(2024, 2, 3), Decimal("1.50"), bytearray(b"ok\xff"), [dt.date(2024, 1, 1), None], (Decimal("2.0"),), None, 'q"')
    table = spark.createDataFrame([row], "d date, t timestamp_ntz, z timestamp_ntz, n decimal(5,2), b binary, a array<date>, s struct<k: decimal(3,1)>, x struct<k: int>, q string")
    got = json.loads(table.select(A.payload(table).alias("p")).first()["p"])
    assert got == {"d": "2024-02-03", "t": "2024-02-03T04:05:06.000070", "z": "2024-02-03T00:00:00", "n": "1.50", "b": "ok\ufffd", "a": ["2024-01-01", None], "s": {"k": "2.0"}, "x": None, "q": 'q"'}
    assert json.loads(table.select(A.payload(table, ["n"]).alias("p")).first()["p"]) == {"n": "1.50"}


def test_snapshots_name_the_keys_of_payloads(spark):
    table = spark.createDataFrame([('{"b":1,"a":{"c":2}}',), ('{"d":null}',), ("[1]",), ("no json",), (None,)], "j string")
    got = {r["table_name"]: (r["n"], r["columns"]) for r in Q.snapshot({"p": table, "t": table, "none": table.where("false")}, {"p": "j", "none": "j"}).collect()}
    assert got == {"p": (5, "a,b,d"), "t": (5, "j"), "none": (0, "")}


def test_types_of_json_ld_count_at_any_depth(spark):
    block = '{"@graph":[{"@type":["A","B"],"x":[[{"@type":"A"}]],"@id":1},{"@type":3},"s"]}'
    html = f'<script type="application/ld+json">{block}</script><script type="application/ld+json">{{"@type":"Broken"</script>'
    table = spark.createDataFrame([(1, html), (2, None), (3, "<p>ld+json</p>")], "page_id int, html string")
    assert sorted(map(tuple, H.jsonld_types(table).collect())) == [(1, "A", 2), (1, "B", 1)]
