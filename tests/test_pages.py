"""Addresses, links, selectors, JSON-LD, payload paths, sitemaps, counters and responses on literal pages."""

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from tallyferry.functions import urls as U
from tallyferry.functions import variants as V
from tallyferry.operators import responses as A
from tallyferry.sources import html as H
from tallyferry.sources import pages as P

BASES = ["https://a.example/x/y?z=1#f", "http://a.example", "https://a.example/x/"]
REFS = ["b", "/b/c", "./b", "../b", "../../../b", "b/../c", "?q=2", "#top", "", "//h.example/p", "https://o.example/p?x#y", "b/.", "..", "mailto:a@b.c", "b?x=/../y"]


def test_references_resolve_as_browsers_do(spark):
    rows = [(b, r) for b in BASES for r in REFS]
    got = spark.createDataFrame(rows, "b string, r string").select(U.resolve(F.col("b"), F.col("r"))).collect()
    assert [(b, r, x[0]) for (b, r), x in zip(rows, got, strict=True)] == [(b, r, urljoin(b, r)) for b, r in rows]


PAGE = """<!doctype html><html><head><title>List &amp; more</title>
<script type="application/ld+json">{"@graph": [{"@type": "Shop", "tel": "1", "geo": {"@type": ["Place", "Thing"], "lat": 1.5}}, {"offers": [{"p": 1}, {"p": 2}]}]}</script>
<script type="application/ld+json">{broken</script></head>
<body><!-- <a href="/no">x</a> --><div class="card big" id="c1"><h2>One</h2><p>a<br>b</div><div class="card"><h2>Two <b>bold</b></h2><img src="i.png"></div>
<table><tr><th>H</th></tr><tr data-id="7"><td>Dana<span>Reyes</span><td><a href="../r/7">go</a></table>
<a href='/x' rel='nofollow next'>n</a><a href="?page=3">3</a><a href="/del?delete">d</a><a data-method="put" href=/m>m</a><a href="/c" data-confirm="?">c</a><a href="/x#2">x</a></body></html>"""


@pytest.mark.parametrize(
    "selector,texts",
    [
        ("h2", ["One", "Two bold"]),
        ("div.card.big > h2", ["One"]),
        ("#c1 p", ["a b"]),
        ("div:not(.big) h2", ["Two bold"]),
        ("div:has(img) h2, title", ["List & more", "Two bold"]),
        ("tr:has(td)", ["Dana Reyes go"]),
        ("td:nth-of-type(2) a", ["go"]),
        ("div + div b", ["bold"]),
        ("div ~ table th", ["H"]),
        ("[data-id='7'] span", ["Reyes"]),
        ("a[href^='/x']", ["n", "x"]),
        ("a[href$=delete]", ["d"]),
        ("a[rel~=next]", ["n"]),
        ("tr:nth-child(2) td:first-child", ["Dana Reyes"]),
        ("body > a:nth-of-type(odd)", ["n", "d", "c"]),
        ("svg", []),
    ],
)
def test_selectors(selector, texts):
    assert [n.text() for n in H.Selector(selector).select(H.parse(PAGE))] == texts


def test_bad_selectors_stop_before_the_job(spark):
    pages = spark.createDataFrame([(1, "u", PAGE)], "page_id int, url string, html string")
    for bad in ("div[", "div >", ":has(", ""):
        with pytest.raises(ValueError):
            H.Selector(bad)
    with pytest.raises(ValueError):
        H.extract(pages, [H.PageField("a", "div[")])


def test_extract_reads_pages_rows_and_json_ld(spark):
    pages = spark.createDataFrame([(1, "https://a.example/l/p", PAGE), (2, None, None)], "page_id int, url string, html string")
    fields = [
        H.PageField("name", "td", attr="own_text"), H.PageField("id", ".", attr="data-id"), H.PageField("link", "a", attr="href"), H.PageField("title", "title", source="page"),
        H.PageField("tel", source="jsonld", path="Shop.tel"), H.PageField("lat", source="jsonld", path="Thing.lat"), H.PageField("prices", source="jsonld", path="offers.p"), H.PageField("none", source="jsonld", path="Nope.tel"),
    ]
    (row,) = H.extract(pages, fields, rows="tr:has(td)").collect()
    assert tuple(row)[:6] == (1, 0, "Dana", "7", "https://a.example/r/7", "List & more")
    assert tuple(row)[6:] == ("1", "1.5", "[1, 2]", None, None)
    whole = H.extract(pages, [H.PageField("heads", "h2", many=True), H.PageField("pic", "img", attr="src", required=True)]).orderBy("page_id").collect()
    assert (whole[0]["heads"], whole[0]["pic"], whole[0]["error"]) == (["One", "Two bold"], "https://a.example/l/i.png", None)
    assert whole[1]["heads"] is None and whole[1]["error"].startswith("pic: ")


def test_links_and_next_page(spark):
    pages = spark.createDataFrame([(1, "https://a.example/l/p", PAGE), (2, "https://a.example/q", '<a href="/list?page=2">two</a><a href="/n">Older</a>'), (3, "u", None)], "page_id int, url string, html string")
    got = P.page_links(pages.where("page_id = 1")).orderBy("position").collect()
    at = "https://a.example"
    assert [(r["href"], r["reason"]) for r in got] == [
        (f"{at}/r/7", None), (f"{at}/x", None), (f"{at}/l/p?page=3", None),
        (f"{at}/del?delete", "looks like a state change"), (f"{at}/m", "data-method=put"), (f"{at}/c", "has a confirmation prompt"),
    ]
    assert [r["href"] for r in P.page_links(pages, pattern="/x$").where("reason is null").collect()] == [f"{at}/x"]
    assert {r["page_id"]: r["next_url"] for r in P.next_page(pages).collect()} == {1: f"{at}/l/p?page=3", 2: f"{at}/n", 3: None}


def test_skeletons_hide_values_and_fold_repeats():
    rows = "".join(f'<tr id="r{i}"><td data-x="v">{i}0.00</td></tr>' for i in range(5))
    got = H.skeleton(H.parse(f"<head><title>t</title></head><table><tr><th>Email</th></tr>{rows}</table><a href='/c/51?page=2' title='Ann'>ann@x.com</a>"))
    assert got == '<table><tr><th>Email</th></tr><tr id="r0"><td data-x="TEXT(1)">MONEY</td></tr><tr id="r0"><td data-x="TEXT(1)">MONEY</td></tr><!-- 3 more like the above --></table><a href="/c/00?page=V">EMAIL</a>'


def test_payload_paths(spark):
    body = '{"data": {"rows": [{"a": {"b": 1}, "n.x": "dot"}, {"a": null}]}, "one": {"id": 5}, "s": "t"}'
    v = F.try_parse_json(F.lit(body))
    paths = ["data.rows.a.b", "data.rows.0.a.b", "data.rows.7", "one.id", "s", "s.x", "nope", "data.rows.1.a"]
    row = spark.range(1).select(*[V.as_text(V.resolve(v, p)).alias(str(i)) for i, p in enumerate(paths)]).first()
    assert list(row) == ["[1,null]", "1", None, "5", "t", None, None, None]
    count = lambda path, text=body: spark.range(1).select(F.size(V.records(F.lit(text), path))).first()[0]
    assert [count("data.rows"), count("one"), count("s"), count("", "[1, 2]"), count("", "no json")] == [2, 1, 0, 2, 0]


def test_sitemaps_lead_to_sitemaps(spark):
    docs = [("r", "<sitemapindex><sitemap><loc> a </loc></sitemap><sitemap><loc>r</loc></sitemap></sitemapindex>"), ("a", "<x:urlset xmlns:x='u'><x:url><x:lastmod>1</x:lastmod><x:loc>p1?a=1&amp;b=2</x:loc></x:url><x:url><x:loc>p2</x:loc></x:url></x:urlset>"), ("b", "<urlset><url><loc>p3</loc></url></urlset>"), ("c", "")]
    table = spark.createDataFrame(docs, "url string, xml string")
    assert sorted(r["url"] for r in P.sitemap_pages(table, table.where("url = 'r'")).collect()) == ["p1?a=1&b=2", "p2"]


@pytest.mark.parametrize("span", [2, 7, 1000])
def test_counter_stops_after_misses_in_any_range(spark, span):
    hits = [("a", n) for n in (1, 2, 5, 6, 9, 14, 15)] + [("b", n) for n in (7, 8)] + [("c", 1), ("c", 2), ("c", 2)]
    got = P.until_misses(spark.createDataFrame(hits, "grp string, n long"), 4, span=span)
    assert sorted(map(tuple, got.collect())) == [("a", 1), ("a", 2), ("a", 5), ("a", 6), ("a", 9), ("c", 1), ("c", 2), ("c", 2)]


def test_responses(spark):
    cases = [
        (409, None, "skipped", None), (422, "{}", "failed", None), (200, '{"succeeded": "no", "id": 3}', "inserted", "3"), (200, '{"success": false, "errors": []}', "failed", None),
        (200, '{"ok": false, "error": {"code": "duplicate key"}}', "skipped", None), (200, '{"isSuccess": true, "data": ["only"]}', "inserted", "only"), (200, '{"isSuccess": true, "data": [1, 2]}', "inserted", None),
        (201, "", "inserted", None), (200, '{"succeeded": true, "data": null}', "inserted", None), (200, '{"_id": "z", "key": ""}', "inserted", "z"),
    ]
    log = spark.createDataFrame([(i, s, b) for i, (s, b, _, _) in enumerate(cases)], "i int, status int, body string")
    got = A.with_outcome(log).orderBy("i").collect()
    assert [(r["action"], r["target_id"]) for r in got] == [c[2:] for c in cases]
    assert A.with_outcome(log, conflict="error").orderBy("i").first()["action"] == "failed"
    assert A.with_outcome(log, preferred="id").where("i = 9").first()["target_id"] is None


def test_finished_records(spark):
    rows = spark.createDataFrame([("p", 0, "https://a.example/1", ["x"], "k1"), ("p", 1, "rel", None, "")], "page_url string, position int, link string, tags array<string>, code string")
    got = P.finalise(rows, "page_url", "position", "2024-01-01 00:00:00", key="code").collect()
    assert [(r["_url"], r["_key"], r["tags"]) for r in got] == [("https://a.example/1", "k1", '["x"]'), ("p", "p#1", None)]
    assert [r["_key"] for r in P.finalise(rows, "page_url", "position", "2024-01-01 00:00:00", rows_mode=False).collect()] == ["https://a.example/1", "p#1"]
