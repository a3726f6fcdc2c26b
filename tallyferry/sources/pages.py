"""Pages as a source: links, next pages, crawls over stored pages, sitemaps, counters, repeats, finished records."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyferry.functions import urls as U
from tallyferry.functions.transforms import shown
from tallyferry.operators.storage import durable

#: Links that are dropped without a word.
NOT_FOLLOWED = r"(?i)^(mailto:|tel:|javascript:)"


def page_links(pages: DataFrame, pattern: str | None = None, keep: Sequence[str] = ("page_id",), url: str = "url", html: str = "html") -> DataFrame:
    """``keep``, url, position, href, reason: a page's links, resolved and without fragment.

    Safe links (no reason) come once each, in their order, and match ``pattern`` if given; refused ones
    come as often as they stand on the page, behind the safe ones. All native expressions.
    """
    target = lambda a: U.without_fragment(U.resolve(F.col(url), a["href"]))
    found = F.transform(F.filter(U.anchors(F.coalesce(F.col(html), F.lit(""))), lambda a: ~a["href"].rlike(NOT_FOLLOWED)), lambda a: F.struct(target(a).alias("href"), a["method"].alias("method"), a["confirm"].alias("confirm")))
    judged = F.transform("__found", lambda a: F.struct(a["href"].alias("href"), U.link_reason(a["method"], a["confirm"], a["href"]).alias("reason")))
    wanted = (lambda h: h.rlike(pattern)) if pattern else (lambda h: F.lit(True))
    safe = F.array_distinct(F.filter("__judged", lambda a: a["reason"].isNull() & wanted(a["href"])))
    out = pages.select(*keep, F.col(url).alias("url"), found.alias("__found")).withColumn("__judged", judged)
    out = out.select(*keep, "url", F.posexplode(F.concat(safe, F.filter("__judged", lambda a: a["reason"].isNotNull()))).alias("position", "__a"))
    return out.select(*keep, "url", "position", F.col("__a.href").alias("href"), F.col("__a.reason").alias("reason"))


def classify_links(links: DataFrame, origin: Column | None = None, seen: DataFrame | None = None) -> DataFrame:
    """``links`` (href, reason) of the page's own host that lead to a page not in ``seen`` (href).

    Files get a reason; links to other hosts, static parts and seen addresses go.
    """
    own = U.authority(origin if origin is not None else F.col("url"))
    out = links.where((U.authority(F.col("href")) == own) & ~F.col("href").rlike(U.NOT_A_PAGE))
    if seen is not None:
        out = out.join(seen.select("href").distinct(), "href", "left_anti")
    out = out.where(F.col("reason").isNotNull() | F.col("href").rlike(U.DOWNLOAD) | ~F.col("href").rlike(U.STATIC))
    return out.withColumn("reason", F.coalesce("reason", F.when(F.col("href").rlike(U.DOWNLOAD), "file download")))


def next_page(pages: DataFrame, keep: Sequence[str] = ("page_id",), url: str = "url", html: str = "html") -> DataFrame:
    """``keep``, next_url: the first link marked or worded as next, else the first to a numbered page; null without one."""
    found = F.transform(U.anchors(F.coalesce(F.col(html), F.lit(""))), lambda a: F.struct(U.resolve(F.col(url), a["href"]).alias("to"), ((a["rel"] == "next") | a["text"].rlike(U.NEXT_TEXT)).alias("says")))
    bare = U.without_fragment(F.col(url))
    named = F.filter("__a", lambda a: a["says"] & (U.without_fragment(a["to"]) != bare))
    numbered = F.filter("__a", lambda a: (U.without_fragment(a["to"]) != F.col(url)) & (U.without_fragment(a["to"]).rlike(U.PAGE_PARAM) | U.without_fragment(a["to"]).rlike(U.PAGE_PATH)))
    out = pages.select(*keep, F.col(url).alias("url"), found.alias("__a"))
    first = lambda x: F.get(x, F.lit(0))["to"]
    return out.select(*keep, U.without_fragment(F.coalesce(first(named), first(numbered))).alias("next_url"))


def crawl(pages: DataFrame, start: str, follow: str | None = None, keep: str | None = None, max_depth: int = 3, limit: int | None = None) -> DataFrame:
    """url, depth of the stored pages that a crawl from ``start`` reaches, breadth first over safe links.

    Only links of the start's host that match ``follow`` lead on; pages whose address matches ``keep``
    (``follow`` if not given) are returned, ``limit`` of them by (depth, url) at most. Every level is
    kept in the shared folder, so no level repeats those before.
    """
    host = U.authority(F.lit(start))
    found = page_links(pages, follow, keep=()).where(F.col("reason").isNull() & (U.authority(F.col("href")) == host))
    stored = durable(pages.select("url").distinct())
    edges = durable(found.select(F.col("url").alias("src"), F.col("href").alias("dst")).join(stored.select(F.col("url").alias("dst")), "dst", "left_semi").distinct())
    seen = durable(reach(edges, stored.where(F.col("url") == start).select(F.col("url").alias("node")), max_depth))
    wanted = keep or follow
    out = seen.select(F.col("node").alias("url"), "depth")
    out = out.where(F.col("url").rlike(wanted)) if wanted else out
    return out.orderBy("depth", "url").limit(limit) if limit is not None else out


def reach(edges: DataFrame, start: DataFrame, max_depth: int) -> DataFrame:
    """node, depth of what ``start`` (node) reaches over ``edges`` (src, dst) in ``max_depth`` steps."""
    seen = front = durable(start.select("node", F.lit(0).alias("depth")))
    for depth in range(1, max_depth + 1):
        front = durable(front.join(edges, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct().join(seen, "node", "left_anti").withColumn("depth", F.lit(depth)))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


class SitemapReader:
    """Takes an XML document's events and keeps the addresses of its pages and of further sitemaps."""

    def __init__(self) -> None:
        self.open: list[str] = []
        self.text: list[str] | None = None
        self.found: list[tuple[str, str]] = []
        self.plain: list[str] = []

    def start(self, name: str, _: dict) -> None:
        self.open.append(name.rpartition(":")[2])
        if self.open[-1] == "loc":
            self.text = []

    def data(self, text: str) -> None:
        if self.text is not None:
            self.text.append(text)

    def end(self, _: str) -> None:
        name = self.open.pop()
        if name == "loc" and self.text is not None:
            loc = "".join(self.text).strip()
            kind = {"url": "page", "sitemap": "sitemap"}.get(self.open[-1] if self.open else "")
            if loc and kind:
                self.found.append((kind, loc))
            elif loc:
                self.plain.append(loc)
            self.text = None

    def read(self, xml: str) -> list[tuple[str, str]]:
        parser = expat.ParserCreate()
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = self.start, self.end, self.data
        parser.Parse(xml.encode(), True)
        # some documents have bare addresses only
        return self.found or [("page", loc) for loc in self.plain]


def sitemap_events(docs: DataFrame, url: str = "url", xml: str = "xml") -> DataFrame:
    """url, kind (page or sitemap), loc of every entry of sitemap documents, or an error row for one that is no XML.

    Documents are read as XML events, so character data, comments, references and any prefix count as
    what they are. An address belongs to the ``url`` or ``sitemap`` element right above it. A null
    document has no entries.
    """
    slim = docs.select(F.col(url).alias("url"), F.col(xml).alias("xml"))
    kind = slim.schema["url"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, rows = [], []
            for k, text in enumerate(batch.column(1)):
                if text.as_py() is None:
                    continue
                try:
                    own = [(*entry, None) for entry in SitemapReader().read(text.as_py().strip())]
                except expat.ExpatError as e:
                    own = [(None, None, str(e))]
                owner += [k] * len(own)
                rows += own
            columns = [pa.array([r[k] for r in rows], pa.string()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int32())), *columns], names=["url", "kind", "loc", "error"])

    return slim.mapInArrow(run, f"url {kind}, kind string, loc string, error string")


def sitemap_entries(docs: DataFrame, url: str = "url", xml: str = "xml") -> DataFrame:
    """url, kind, loc of :func:`sitemap_events`; broken documents have none."""
    return sitemap_events(docs, url, xml).where("error is null").drop("error")


def sitemap_pages(docs: DataFrame, roots: DataFrame, most_levels: int = 60, match: str | None = None) -> DataFrame:
    """url of the pages that the sitemaps reached from ``roots`` (url) list, once each."""
    entries = durable(sitemap_entries(docs))
    edges = entries.where("kind = 'sitemap'").select(F.col("url").alias("src"), F.col("loc").alias("dst")).distinct()
    known = reach(edges, roots.select(F.col("url").alias("node")).distinct(), most_levels)
    found = entries.where("kind = 'page'").join(known.select(F.col("node").alias("url")), "url", "left_semi").select(F.col("loc").alias("url")).distinct()
    return found.where(F.col("url").rlike(match)) if match else found


def without_repeats(rows: DataFrame, page: str, content: Sequence[str], group: str | None = None) -> DataFrame:
    """``rows`` without those whose content stands on an earlier page (of the same ``group``); repeats within a page stay.

    The first page of each content comes from a partial aggregate. Rows meet it by content and page
    together, so content that fills a third of the table is spread by its pages.
    """
    mark = F.xxhash64(*[F.coalesce(shown(F.col(c), t), F.lit("\0")) for c, t in rows.dtypes if c in content])
    marked = rows.withColumn("__sig", F.struct(mark, *([F.col(group)] if group else [])))
    first = marked.groupBy("__sig").agg(F.min(page).alias(page))
    return marked.join(first, ["__sig", page], "left_semi").select(*rows.columns)


def until_nothing_new(records: DataFrame, content: Sequence[str], budget: int, group: str = "grp", number: str = "n", start: int = 1, span: int = 1 << 20) -> DataFrame:
    """The records of a walk over numbers, up to the first run of ``budget`` numbers that give nothing new.

    A number misses if it has no record, or only such as an earlier number of its group has shown;
    repeats of earlier numbers are left out of the result, those within a number stay.
    """
    return until_misses(without_repeats(records, number, content, group), budget, group, number, start, span)


def until_misses(rows: DataFrame, budget: int, group: str = "grp", number: str = "n", start: int = 1, span: int = 1 << 20) -> DataFrame:
    """Hits (group, number, ascending from ``start``) before the first run of ``budget`` numbers without a hit.

    Gaps are found inside ranges of ``span`` numbers; the ranges' first and last hits, one row each,
    join them, so no task holds a group.
    """
    g, n = F.col(group), F.col(number)
    hits = rows.select(group, number).distinct().withColumn("__b", F.floor(n / span).cast("long"))
    inside = hits.withColumn("__gap", n - F.lag(number).over(Window.partitionBy(group, "__b").orderBy(number)) - 1)
    edges = hits.groupBy(group, "__b").agg(F.min(number).alias("__first"), F.max(number).alias("__last"))
    before = F.coalesce(F.lag("__last").over(Window.partitionBy(group).orderBy("__b")), F.lit(start - 1))
    gaps = inside.where(F.col("__gap") >= budget).select(g.alias("__g"), n.alias("__n"))
    gaps = gaps.unionByName(edges.withColumn("__gap", F.col("__first") - before - 1).where(F.col("__gap") >= budget).select(g.alias("__g"), F.col("__first").alias("__n")))
    cuts = F.broadcast(gaps.groupBy("__g").agg(F.min("__n").alias("__cut"))) if _few(rows, group) else gaps.groupBy("__g").agg(F.min("__n").alias("__cut"))
    return rows.join(cuts, g == F.col("__g"), "left").where(F.col("__cut").isNull() | (n < F.col("__cut"))).drop("__g", "__cut")


def _few(rows: DataFrame, group: str, most: int = 10_000) -> bool:
    return rows.select(group).distinct().limit(most + 1).count() <= most


def collection_totals(records: DataFrame, collection: Column, page: str = "page_id", error: str = "error") -> DataFrame:
    """collection, fetched (pages), stored, failed: what a harvest's records (with ``error``) come to."""
    bad = F.col(error).isNotNull()
    return records.groupBy(collection.alias("collection")).agg(F.count_distinct(page).alias("fetched"), F.count(F.when(~bad, 1)).alias("stored"), F.count(F.when(bad, 1)).alias("failed"))


#: Fixed names of fields that hold a record's own address.
CANONICAL = ("link", "permalink", "url", "guid", "canonical_url")


def finalise(records: DataFrame, page_url: str, position: str, fetched_at: str, key: str | None = None, rows_mode: bool = True) -> DataFrame:
    """``records`` with _url, _key and _fetched_at; structures become JSON text.

    The address is the first canonical field that holds one, else the page's. The key is the key
    field's text, else the address, with the position where a page has several records.
    """
    flat = [F.to_json(F.col(c)).alias(c) if t.startswith(("array", "struct", "map", "variant")) else F.col(c) for c, t in records.dtypes if c not in (page_url, position)]
    named = [F.when(F.col(c).rlike("^https?://"), F.col(c)) for c in CANONICAL if c in records.columns and c != page_url and dict(records.dtypes)[c] == "string"]
    canonical = F.coalesce(*named, F.col(page_url))
    placed = F.when(F.lit(rows_mode) | (F.col(position) > 0), F.concat(canonical, F.lit("#"), F.col(position))).otherwise(canonical)
    own = F.coalesce(F.nullif(F.col(key).cast("string"), F.lit("")), placed) if key else placed
    return records.select(*flat, canonical.alias("_url"), own.alias("_key"), F.lit(fetched_at).cast("timestamp_ntz").alias("_fetched_at"))
