"""Entity resolution that refuses ambiguous matches, back-fill, child folding, key inference."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyferry.functions.transforms import last_digits, match_text
from tallyferry.operators.storage import spread_join

SIGNALS = ("phone", "email", "name_zip")


def phone_key(v: Column) -> Column:
    """The last ten digits; null unless there are ten."""
    d = last_digits(v)
    return F.when(F.length(d) == 10, d)


def name_key(first: Column, last: Column) -> Column:
    """Both names for a comparison; null if both are blank."""
    name = F.concat_ws("|", match_text(first), match_text(last))
    return F.when(name != "|", name)


def _email_key(v: Column) -> Column:
    e = match_text(v)
    return F.when(e != "", e)


def _name_zip_key(first: Column, last: Column, zip_: Column) -> Column:
    """Name and the digits of the zip, which may be blank."""
    return F.concat(name_key(first, last), F.lit("|"), last_digits(zip_))


def _optional(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def link(jobs: DataFrame, customers: DataFrame, order: str = "ingest") -> DataFrame:
    """id, customer_id, method, outcome of every job: phone, then e-mail, then name and zip.

    Customers are known by ``phone`` and ``alt_phone`` (ten digits each). A signal counts only if all
    its candidates are one person; name and zip needs exactly one candidate. Of several ids of one
    person the lowest by (length, value) is taken. Each key has one row, so a shared key cannot fan
    out, and jobs without a key are dealt out by their rows.
    """
    people = customers.withColumn("alt_phone", _optional(customers, "alt_phone"))
    people = people.groupBy("id").agg(F.max(F.struct(order, "first_name", "last_name", "email", "phone", "alt_phone", "zip")).alias("p")).select("id", "p.*")
    names = F.col("first_name"), F.col("last_name")
    keys = [("phone", phone_key(F.col("phone"))), ("phone", phone_key(F.col("alt_phone"))), ("email", _email_key(F.col("email"))), ("name_zip", _name_zip_key(*names, F.col("zip")))]
    person = F.coalesce(name_key(*names), F.lit(""))
    index = people.select("id", person.alias("person"), F.inline(F.array(*[F.struct(F.lit(s).alias("signal"), k.alias("key")) for s, k in keys]))).where("key is not null")
    by_key = index.groupBy("signal", "key").agg(F.count_distinct("id").alias("ids"), F.count_distinct("person").alias("persons"), F.min(F.struct(F.length("id").alias("n"), F.col("id").alias("id"))).alias("low"))
    fits = (F.col("ids") == 1) | ((F.col("persons") == 1) & (F.col("signal") != "name_zip"))
    by_key = by_key.select("signal", "key", F.when(fits, F.col("low.id")).alias("hit"))
    c = lambda n: F.col(f"customer_{n}")
    own = {"phone": phone_key(c("phone")), "email": _email_key(c("email")), "name_zip": _name_zip_key(c("first_name"), c("last_name"), c("zip"))}
    out = jobs.select("id", *[k.alias(f"k_{s}") for s, k in own.items()])
    for s in SIGNALS:
        found = by_key.where(F.col("signal") == s).select(F.col("key").alias(f"x_{s}"), F.col("hit").alias(f"h_{s}"))
        out = spread_join(out, found, f"k_{s}", f"x_{s}", by=["id"])
    method = F.coalesce(*[F.when(F.col(f"h_{s}").isNotNull(), F.lit(s.replace("_", "+"))) for s in SIGNALS])
    outcome = F.when(method.isNotNull(), "matched").when(F.coalesce(*[F.col(f"x_{s}") for s in SIGNALS]).isNotNull(), "ambiguous").otherwise("unmatched")
    return out.select("id", F.coalesce(*[F.col(f"h_{s}") for s in SIGNALS]).alias("customer_id"), method.alias("method"), outcome.alias("outcome"))


def link_report(linked: DataFrame) -> DataFrame:
    return linked.groupBy("outcome", F.coalesce("method", F.lit("")).alias("method")).agg(F.count(F.lit(1)).alias("n"))


def backfill_phone(customers: DataFrame, jobs: DataFrame, matched: str = "customer_id") -> DataFrame:
    """id, phone, outcome (enriched, ambiguous, no_source) of every customer without a phone.

    The number is the one that the jobs matched to the customer agree on. Only where no matched job
    has a number do the jobs of the same name count, if no other customer without a phone has it.
    """
    number = phone_key(F.col("customer_phone"))
    numbers = lambda by: jobs.select(by.alias("__by"), number.alias("__n")).where("__by is not null and __n is not null").groupBy("__by").agg(F.min("__n").alias("low"), F.max("__n").alias("high"))
    bare = customers.where(phone_key(F.col("phone")).isNull() & phone_key(_optional(customers, "alt_phone")).isNull())
    bare = bare.select(F.col("id").cast("string").alias("id"), name_key(F.col("first_name"), F.col("last_name")).alias("name"))
    alone = bare.groupBy(F.col("name").alias("__a")).agg(F.count(F.lit(1)).alias("same_name"))
    by_id = numbers(F.col(matched).cast("string")).toDF("__i", "low_i", "high_i")
    by_name = numbers(name_key(F.col("customer_first_name"), F.col("customer_last_name"))).join(alone.where("same_name = 1"), F.col("__by") == F.col("__a")).select(F.col("__by").alias("__m"), F.col("low").alias("low_m"), F.col("high").alias("high_m"))
    out = spread_join(spread_join(bare, by_id, "id", "__i", by=["name"]), by_name, "name", "__m", by=["id"])
    by = F.coalesce(F.when(F.col("low_i").isNotNull(), F.struct(F.col("low_i").alias("low"), F.col("high_i").alias("high"))), F.when(F.col("low_m").isNotNull(), F.struct(F.col("low_m").alias("low"), F.col("high_m").alias("high"))))
    out = out.select("id", by.alias("by"))
    agreed = F.col("by.low") == F.col("by.high")
    return out.select("id", F.when(agreed, F.col("by.low")).alias("phone"), F.when(F.col("by").isNull(), "no_source").when(agreed, "enriched").otherwise("ambiguous").alias("outcome"))


def fold_children(children: Sequence[tuple[int, DataFrame, str, str, Column, Column]], parent: str) -> DataFrame:
    """``parent`` and ``notes``: one ordered array of {content, isPrintable} over all child tables.

    Each child is (section, rows, parent column, order column, content, printable). The array is the
    parent's own size; nothing else is gathered.
    """
    common = None
    for section, rows, of, seq, content, printable in children:
        one = rows.select(F.col(of).alias(parent), F.lit(section).alias("section"), F.col(seq).cast("long").alias("seq"), content.alias("content"), printable.alias("isPrintable")).where("trim(content) <> ''")
        common = one if common is None else common.unionByName(one)
    listed = common.groupBy(parent).agg(F.array_sort(F.collect_list(F.struct("section", "seq", "content", "isPrintable"))).alias("all"))
    return listed.select(parent, F.transform("all", lambda n: F.struct(n["content"].alias("content"), n["isPrintable"].alias("isPrintable"))).alias("notes"))


def _clean(c: str) -> Column:
    """One line: runs of white space are one blank; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"[\s\p{Z}]+", " "))


def _words(*parts: Column) -> Column:
    return F.array_join(F.filter(F.array(*parts), lambda x: x != ""), " ")


def compose_notes(notes: DataFrame, parts: DataFrame, payments: DataFrame, job: str = "job_id", seq: str = "seq") -> DataFrame:
    """job and notes: a job's own notes, then its parts, then its payments, as texts.

    A note is its body and, in brackets, its time; it prints if it says so. A part is its number (or
    catalogue number), description and colour behind a dash. A payment is its amount, time, status
    and processor, marked as for reference only. Rows without any of these give no note.
    """
    when = _clean("created_at")
    note = F.when(_clean("body") != "", F.concat(_clean("body"), F.when(when != "", F.concat(F.lit("  ("), when, F.lit(")"))).otherwise("")))
    number = F.coalesce(F.nullif(_clean("part_number"), F.lit("")), _clean("nags_part_number"))
    colour = _clean("nags_colour")
    part = _words(number, _clean("nags_description"), F.when(colour != "", F.concat(F.lit("- "), colour)).otherwise(""))
    amount, paid, via = F.regexp_replace(F.coalesce(F.col("amount").cast("string"), F.lit("")), r"[^0-9.]", ""), _clean("paid_at"), _clean("processor")
    tagged = lambda tag, x: F.when(x != "", F.concat(F.lit(tag), x)).otherwise("")
    payment = _words(tagged("$", amount), tagged("on ", paid), _clean("status"), tagged("via ", via))
    prints = F.coalesce(F.col("print_on_invoice").cast("boolean"), F.lit(False))
    titled = lambda title, x: F.when(x != "", F.concat(F.lit(title), x))
    return fold_children(
        [
            (1, notes, job, seq, note, prints),
            (2, parts, job, seq, titled("Part: ", part), F.lit(False)),
            (3, payments, job, seq, titled("Payment (from v2, reference only): ", payment), F.lit(False)),
        ],
        job,
    )


# Columns that point at another table, and keys that a table may have besides its own.
FK_COLUMN = re.compile(r"^(?P<base>.+?)_(?:id|uuid|guid|key|ref|no|num|number|fk)$", re.I)
PARENT_KEYS = ("id", "uuid", "guid", "code", "number", "_key")


#: Endings of a plural and what the singular has in their place.
PLURAL = (("s", ""), ("es", ""), ("ies", "y"))


def name_forms(name: str) -> set[str]:
    """A name, and what it may be the plural of; names match that share a form, and the values decide."""
    plain = "".join(c for c in name.lower() if c.isascii() and c.isalnum())
    return {plain} | {plain[: -len(end)] + single for end, single in PLURAL if plain.endswith(end) and len(plain) > len(end) + 1}


def candidate_keys(tables: Mapping[str, DataFrame], primary: Mapping[str, str] | None = None, declared: Sequence[tuple[str, str]] = ()) -> list[tuple[str, str, str, str]]:
    """(child table, child column, parent table, parent column) that the names suggest; no data is read."""
    keys = primary or {}
    forms = {t: name_forms(t) for t in tables}
    out = []
    for t, df in tables.items():
        for c in df.columns:
            m = FK_COLUMN.match(c)
            if not m or c == keys.get(t) or (t, c) in declared:
                continue
            base = name_forms(m["base"])
            for parent in (p for p in tables if forms[p] & base):
                found = [k for k in dict.fromkeys([keys.get(parent), *PARENT_KEYS]) if k in tables[parent].columns]
                out += [(t, c, parent, k) for k in found if not (parent == t and k == c)]
    return out


def infer_relationships(tables: Mapping[str, DataFrame], primary: Mapping[str, str] | None = None, declared: Sequence[tuple[str, str]] = (), least: float = 0.85) -> DataFrame:
    """child, parent, confidence of the relations that names suggest and values prove."""
    found = candidate_keys(tables, primary, declared)
    if not found:
        return next(iter(tables.values())).sparkSession.createDataFrame([], "child string, parent string, confidence double")
    kids, tops = list(dict.fromkeys(f[:2] for f in found)), list(dict.fromkeys(f[2:] for f in found))
    load = lambda pairs: [(t, c, tables[t]) for t, c in pairs]
    return infer_keys(load(kids), load(tops), [(kids.index(f[:2]), tops.index(f[2:])) for f in found], least)


def infer_keys(children: Sequence[tuple[str, str, DataFrame]], parents: Sequence[tuple[str, str, DataFrame]], pairs: Sequence[tuple[int, int]], least: float = 0.85) -> DataFrame:
    """Best parent of each child column: share of its distinct values that the parent's key has.

    All candidate pairs run as one job on long rows (column number, value).
    """
    long = lambda tables, name: _union([df.select(F.lit(i).alias(name), F.col(c).cast("string").alias("value")).where("value is not null").distinct() for i, (_, c, df) in enumerate(tables)])
    spark = children[0][2].sparkSession
    wanted = spark.createDataFrame(list(pairs), "child int, parent int")
    values = long(children, "child").join(F.broadcast(wanted), "child")
    sizes = values.groupBy("child", "parent").agg(F.count(F.lit(1)).alias("n"))
    hits = values.join(long(parents, "parent"), ["parent", "value"]).groupBy("child", "parent").agg(F.count(F.lit(1)).alias("k"))
    scored = sizes.join(hits, ["child", "parent"], "left").select("child", "parent", (F.coalesce("k", F.lit(0)) / F.col("n")).alias("confidence"))
    best = scored.where(F.col("confidence") >= least).groupBy("child").agg(F.max(F.struct("confidence", (-F.col("parent")).alias("p"))).alias("b"))
    names = lambda tables, at: F.element_at(F.array(*[F.concat_ws(".", F.lit(t), F.lit(c)) for t, c, _ in tables]), at + 1)
    return best.select(names(children, F.col("child")).alias("child"), names(parents, -F.col("b.p")).alias("parent"), F.round("b.confidence", 4).alias("confidence"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
