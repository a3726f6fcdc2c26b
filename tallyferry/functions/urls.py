"""Addresses and anchors of pages as Columns: no page leaves the JVM for its links."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What must not be followed on a page of a live system, what is no page, files and static parts.
UNSAFE = r"(?i)(^|[/?&#_.-])(log[ _-]?out|sign[ _-]?out|delete|destroy|remove|trash|archive|purge|cancel|void|refund|chargeback|reverse|send|e[ _-]?mail|notify|sms|text|dispatch|remind|approve|reject|decline|accept|confirm|finali[sz]e|pay|charge|capture|checkout|invoice_now|impersonate|switch[ _-]?user|become|reset|regenerate|rotate|revoke|disable|deactivate|merge|restore|publish|unpublish)([/?&#_.-]|$)"
NOT_A_PAGE = r"(?i)^(mailto:|tel:|javascript:|blob:|data:)"
DOWNLOAD = r"(?i)\.(pdf|csv|xlsx?|zip|docx?|pptx?)(\?|$)"
STATIC = r"(?i)\.(png|jpe?g|gif|svg|webp|avif|ico|woff2?|ttf|eot|css|mp4|webm|m4a|mp3)(\?|$)"
#: Texts and addresses of a link to the next page of a list.
NEXT_TEXT = r"(?i)^\s*(next|older|more|›|»|→|>>?)\s*$"
PAGE_PARAM = r"(?i)[?&](page|p|pg|offset|start)=[0-9]+"
PAGE_PATH = r"(?i)/page/[0-9]+/?$"


def scheme(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)


def authority(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def path_and_query(url: Column) -> Column:
    return F.concat(path(url), F.lit("?"), query(url))


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(url, r"#.*$", "")


def _without_dots(p: Column) -> Column:
    """A path whose ``.`` and ``..`` parts are worked off."""

    def step(done: Column, part: Column) -> Column:
        shorter = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(part == "..", shorter).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    parts = F.split(F.regexp_replace(p, "^/", ""), "/")
    ends = F.when(p.rlike(r"/\.\.?$"), F.lit("/")).otherwise("")
    worked = F.aggregate(parts, F.array().cast("array<string>"), step, lambda done: F.array_join(done, "/"))
    return F.when(p.rlike(r"(^|/)\.\.?(/|$)"), F.concat(F.lit("/"), worked, F.when(worked == "", "").otherwise(ends))).otherwise(p)


def resolve(base: Column, ref: Column) -> Column:
    """``ref`` as seen from the page ``base`` (both absolute http addresses or references)."""
    root = F.concat(scheme(base), F.lit("://"), authority(base))
    own, rest = F.regexp_extract(ref, r"^([^?#]*)", 1), F.regexp_extract(ref, r"^[^?#]*(.*)$", 1)
    above = F.regexp_extract(path(base), r"^(.*/)", 1)
    full = F.when(own.startswith("/"), own).otherwise(F.concat(F.when(above == "", "/").otherwise(above), own))
    return (
        F.when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), ref)
        .when(ref.startswith("//"), F.concat(scheme(base), F.lit(":"), ref))
        .when(ref == "", base)
        .when(ref.startswith("#"), F.concat(without_fragment(base), ref))
        .when(ref.startswith("?"), F.concat(root, path(base), ref))
        .otherwise(F.concat(root, _without_dots(full), rest))
    )


ENTITY = r"&(?:#[0-9]{1,7};?|#[xX][0-9a-fA-F]{1,6};?|[A-Za-z][A-Za-z0-9]{1,31};)"


def unescaped(v: Column) -> Column:
    """``v`` with its character references decoded: numbers, and all names that HTML knows; others stay as written."""
    names = F.from_json(F.lit(json.dumps({k: t for k, t in html5.items() if k.endswith(";")})), "map<string,string>")

    def one(ref: Column) -> Column:
        digits = F.regexp_extract(ref, "^&#([0-9]+)", 1)
        code = F.coalesce(digits.try_cast("int"), F.conv(F.nullif(F.regexp_extract(ref, "^&#[xX]([0-9a-fA-F]+)", 1), F.lit("")), 16, 10).cast("int"))
        no_sign = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
        sign = F.decode(F.unhex(F.lpad(F.hex(F.when(no_sign, 0xFFFD).otherwise(code)), 8, "0")), "UTF-32")
        return F.when(ref.startswith("&#"), sign).otherwise(F.coalesce(F.try_element_at(names, F.substring(ref, 2, 40)), ref))

    decoded = F.zip_with(F.split(v, ENTITY), F.regexp_extract_all(v, F.lit(ENTITY), F.lit(0)), lambda text, ref: F.concat(text, F.coalesce(one(ref), F.lit(""))))
    return F.when(v.contains("&"), F.array_join(decoded, "")).otherwise(v)


#: A tag's attribute: its name, and a value that may hold ``>`` inside quotes. The possessive forms never go back.
ATTRIBUTE = r"""[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?"""
NAMED = r"""(?s)([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?"""
INSIDE = rf"(?:[\s/]++|{ATTRIBUTE})*+>"
#: Every tag in turn, so that none is found inside another's attribute; group 1 is a link and what it encloses, up to its own end tag.
TAGS = rf"(?is)(<a(?=[\s/>]){INSIDE}.*?(?=</a\s*+>|<a[\s/>]|\z))|<[a-z!?/]{INSIDE}"
OPENING = rf"(?is)^<a(?=[\s/>]){INSIDE}"


def attributes(opening: Column) -> tuple[Column, Column]:
    """Names (lower case) and raw values of an opening tag's attributes, in two passes over it."""
    return F.transform(F.regexp_extract_all(opening, F.lit(NAMED), F.lit(1)), F.lower), F.regexp_extract_all(opening, F.lit(NAMED), F.lit(2))


def attribute(names: Column, values: Column, name: str) -> Column:
    """The first attribute of a name, decoded; null if the tag has none."""
    raw = F.get(values, (F.array_position(names, name) - 1).cast("int"))
    return F.when(F.array_contains(names, name), unescaped(F.regexp_replace(raw, r"""(?s)^(["'])(.*)\1$""", "$2")))


def anchors(html: Column) -> Column:
    """Array of (href, text, rel, method, confirm) of a page's links in their order; comments and scripts hold none."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)[^>]*>.*?</\1>", " ")
    tags = F.filter(F.regexp_extract_all(bare, F.lit(TAGS), F.lit(1)), lambda t: t != "")

    def parts(tag: Column) -> Column:
        names, values = attributes(F.regexp_extract(tag, OPENING, 0))
        return F.struct(tag.alias("tag"), names.alias("names"), values.alias("values"))

    def one(tag: Column) -> Column:
        own = lambda name: attribute(tag["names"], tag["values"], name)
        lower = lambda c: F.lower(F.coalesce(c, F.lit("")))
        text = F.trim(F.regexp_replace(unescaped(F.regexp_replace(F.regexp_replace(tag["tag"], OPENING, ""), rf"(?is)<[a-z!?/]{INSIDE}", " ")), r"[\s\p{Z}]+", " "))
        confirm = F.coalesce(F.nullif(own("data-confirm"), F.lit("")), own("data-turbo-confirm"), F.lit(""))
        return F.struct(own("href").alias("href"), text.alias("text"), lower(own("rel")).alias("rel"), lower(own("data-method")).alias("method"), confirm.alias("confirm"))

    return F.filter(F.transform(F.transform(tags, parts), one), lambda a: a["href"].isNotNull())


#: Why a link is refused.
REFUSED = ("data-method=", "has a confirmation prompt", "looks like a state change")


def link_reason(method: Column, confirm: Column, url: Column) -> Column:
    """Why a link must not be followed; null for a safe one."""
    return (
        F.when((method != "") & (method != "get"), F.concat(F.lit(REFUSED[0]), method))
        .when(confirm != "", REFUSED[1])
        .when(path_and_query(url).rlike(UNSAFE), REFUSED[2])
    )


def url_group(url: Column) -> Column:
    """The shape of an address's path: its first part and how deep it goes."""
    parts = F.filter(F.split(F.regexp_replace(path(url), "^/+|/+$", ""), "/"), lambda x: F.lit(True))
    return F.when(parts[0] == "", "/").when(F.size(parts) == 1, "/<page>").otherwise(F.concat(F.lit("/"), parts[0], F.repeat(F.lit("/<...>"), F.size(parts) - 1)))


def url_pattern(url: Column) -> Column:
    """Numeric parts become <id>, UUID parts <uuid>; parameters keep their names, sorted."""
    at = F.regexp_replace(F.regexp_replace(F.regexp_extract(url, r"^([^?#]*)", 1), r"/[0-9]+(?=/|$)", "/<id>"), r"(?i)/[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}(?=/|$)", "/<uuid>")
    names = F.array_sort(F.regexp_extract_all(query(url), F.lit("(?:^|&)([^=&]+)=[^&]"), F.lit(1)))
    return F.concat(at, F.when(F.size(names) > 0, F.concat(F.lit("?"), F.array_join(F.transform(names, lambda k: F.concat(k, F.lit("=…"))), "&"))).otherwise(F.lit("")))


#: Fixed parameter names by paging style, and of the page size.
PAGING = (
    ("cursor", ("cursor", "after", "next", "next_cursor", "page_token", "continuation")),
    ("page", ("page", "p", "pagenumber", "page_number", "pagina")),
    ("offset", ("offset", "skip", "start", "from")),
)
PER_PAGE = ("per_page", "perpage", "limit", "page_size", "pagesize", "size", "take", "count")


def paging(url: Column, body: Column | None = None) -> Column:
    """(style, param, per_page_param, per_page) of a logged call's address and JSON body; null if it does not page."""
    pair = F.lit("(?:^|&)([^=&]+)=([^&]+)")
    names, values = (F.regexp_extract_all(query(url), pair, F.lit(k)) for k in (1, 2))
    if body is not None:
        own = F.from_json(body, "map<string,string>")
        names, values = F.concat(names, F.coalesce(F.map_keys(own), F.array().cast("array<string>"))), F.concat(values, F.coalesce(F.map_values(own), F.array().cast("array<string>")))
    names = F.transform(names, F.lower)
    first = lambda known: F.get(F.filter(names, lambda n: n.isin(*known)), F.lit(0))
    size = first(PER_PAGE)
    found = [(style, first(known)) for style, known in PAGING]
    style = F.coalesce(*[F.when(p.isNotNull(), F.lit(s)) for s, p in found], F.when(size.isNotNull(), F.lit("page")))
    param = F.coalesce(*[p for _, p in found], F.when(size.isNotNull(), F.lit("page")))
    observed = F.get(values, F.array_position(names, size).cast("int") - 1)
    return F.when(style.isNotNull(), F.struct(style.alias("style"), param.alias("param"), size.alias("per_page_param"), F.when(observed.rlike("^[0-9]+$"), observed.try_cast("bigint")).alias("per_page")))


#: Fixed words of a sign-in page.
SIGN_IN_URL = r"/(login|signin|sign-in|auth|sso)(\?|/|$)"
SIGN_IN_WORDS = r"(?i)\b(sign in|signin|log ?in|password|forgot your password|remember me|two.factor|authenticate)\b"
PASSWORD_INPUT = r"""(?is)<input\b[^>]*\stype\s*=\s*["']?password"""


def page_title(html: Column) -> Column:
    return F.trim(unescaped(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)))


def sign_in_evidence(url: Column, html: Column) -> Column:
    """Array of what tells that a page is the sign-in screen; empty for other pages."""
    text = F.trim(F.regexp_replace(F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style|head)[^>]*>.*?</\1>|<[^>]*>", " "), r"\s+", " "))
    short = (F.length(text) < 2000) & text.rlike(SIGN_IN_WORDS) & ~html.rlike(r"(?i)<article\b")
    title = page_title(html)
    found = [
        F.when(F.lower(url).rlike(SIGN_IN_URL), "address"),
        F.when(html.rlike(PASSWORD_INPUT), "password input"),
        F.when(title.rlike(SIGN_IN_WORDS), F.concat(F.lit("title: "), title)),
        F.when(short, "short page of sign-in words"),
    ]
    return F.array_compact(F.array(*found))


#: Fixed signatures of page software: (label, expression).
SIGNATURES = (
    ("WordPress", r"/wp-content/|/wp-includes/|wp-json"),
    ("WooCommerce", r"woocommerce|wc-ajax"),
    ("Elementor", r"elementor"),
    ("Divi", r"et_pb_|divi"),
    ("Shopify", r"cdn\.shopify\.com|/cdn/shop/|Shopify\.theme"),
    ("Wix", r"static\.wixstatic\.com|wix-code|_wixCssStates"),
    ("Squarespace", r"squarespace\.com|static1\.squarespace"),
    ("Webflow", r"assets\.website-files\.com|uploads-ssl\.webflow\.com|data-wf-page"),
    ("Duda", r"/_dm/|dudamobile|dudaone"),
    ("GoDaddy Website Builder", r"img1\.wsimg\.com|godaddy"),
    ("Joomla", r"/media/jui/|joomla"),
    ("Drupal", r"/sites/default/files/|drupal-settings-json"),
    ("Magento", r"/static/version|mage/|Magento_"),
    ("BigCommerce", r"cdn\d*\.bigcommerce\.com"),
    ("HubSpot CMS", r"hs-scripts\.com|hubspot"),
    ("Next.js", r"__NEXT_DATA__|/_next/static"),
    ("Nuxt", r"__NUXT__|/_nuxt/"),
    ("Gatsby", r"___gatsby|page-data\.json"),
    ("React (SPA)", r"react(-dom)?(\.production)?\.min\.js|data-reactroot"),
    ("Angular", r"ng-version="),
    ("Vue", r"data-v-[0-9a-f]{8}"),
)


def generator(html: Column) -> Column:
    """What a page's generator meta tag says, whatever the order of its attributes; null without one."""
    metas = F.transform(F.regexp_extract_all(html, F.lit(rf"(?is)<meta(?=[\s/]){INSIDE}"), F.lit(0)), lambda t: F.struct(*[c.alias(n) for c, n in zip(attributes(t), ("names", "values"), strict=True)]))
    said = F.transform(metas, lambda m: F.struct(F.lower(attribute(m["names"], m["values"], "name")).alias("name"), F.trim(attribute(m["names"], m["values"], "content")).alias("content")))
    return F.nullif(F.get(F.filter(said, lambda m: m["name"] == "generator"), F.lit(0))["content"], F.lit(""))


def platforms(html: Column, signatures: tuple[tuple[str, str], ...] = SIGNATURES) -> Column:
    """Array of (platform, evidence) of what a page is made with; up to three distinct finds of 60 signs each."""
    labels = sorted({label for label, _ in signatures})
    found = []
    for label in labels:
        hits = F.array(*[F.nullif(F.substring(F.regexp_extract(html, f"(?i){x}", 0), 1, 60), F.lit("")) for name, x in signatures if name == label])
        found.append(F.struct(F.lit(label).alias("platform"), F.slice(F.array_sort(F.array_distinct(F.array_compact(hits))), 1, 3).alias("evidence")))
    return F.filter(F.array(*found), lambda p: F.size(p["evidence"]) > 0)
