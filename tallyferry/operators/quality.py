"""Scrubbing of card numbers and other secrets, redaction, table profiles, fill rates, value shapes."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyferry.functions.shapes import VALUE_SHAPES
from tallyferry.functions.transforms import apply_chain, cell, digits_of, stripped
from tallyferry.functions.variants import kind, records
from tallyferry.operators.storage import spread

# Column name rules, card number prefixes and the number form that is masked.
FORBIDDEN = re.compile(r"(^|_)(cvv|cvc|csc|cvv2|cid|security_?code|card_?pin|pin_?block|track_?[12]|magstripe|mag_?stripe|full_?pan|card_?verification)($|_)", re.I)
CARD = re.compile(r"(^|_)(pan|card_?number|cc_?number|creditcard|credit_?card|account_?number|acct_?number|card_?no)($|_)", re.I)
BANK = re.compile(r"(^|_)(routing_?number|aba|iban|sort_?code|bank_?account)($|_)", re.I)
SENSITIVE = ("password", "passwd", "pwd", "hash", "salt", "token", "secret", "ssn", "social", "card", "cvv", "api_key", "auth")
PERSONAL = re.compile(r"(^|_)(email|e_?mail|phone|mobile|cell|fax|first_?name|last_?name|full_?name|name|address|street|address[12]|city|province|zip|postal|dob|date_?of_?birth|ssn|social|licen[cs]e|driver_?licen[cs]e|policy_?number|claim_?number|vin|insured)($|_)|(^|_)(address|billing|shipping|mailing|home|work)_?state($|_)|(^|_)state_(code|abbr\w*)($|_)", re.I)
IIN = r"^(4\d{12,18}|5[1-5]\d{14}|2(2[2-9]\d|[3-6]\d{2}|7[01]\d|720)\d{12}|3[47]\d{13}|6(011|5\d{2}|4[4-9]\d)\d{12,15}|35(2[89]|[3-8]\d)\d{12,15}|3(0[0-5]|[68]\d)\d{11,16})$"
SSN = r"\b\d{3}-\d{2}-\d{4}\b"
SSN_MASK = "•••-••-####"
BULLETS = "•••• "


def card_digits(v: Column) -> Column:
    """The bare digits of a value that is a card number as a whole, else null."""
    d = F.regexp_replace(stripped(v), "[ -]", "")
    return F.when(d.rlike("^[0-9]{13,19}$") & d.rlike(IIN) & F.call_function("luhn_check", d), d)


def _last_four(d: Column) -> Column:
    return F.when(F.length(d) >= 4, F.concat(F.lit(BULLETS), F.right(d, F.lit(4))))


def scrubbed(name: str, v: Column) -> tuple[Column, Column]:
    """(clean value, action: blocked, masked or null) of a text column by its name and value."""
    if name.startswith("_"):
        return v, F.lit(None).cast("string")
    if FORBIDDEN.search(name):
        return F.lit(None).cast("string"), F.lit("blocked")
    pan, ssn = card_digits(v), F.coalesce(v.rlike(SSN), F.lit(False))
    value = F.when(pan.isNotNull(), _last_four(pan)).when(ssn, F.regexp_replace(v, SSN, SSN_MASK)).otherwise(v)
    action = F.when(pan.isNotNull() | ssn, "masked")
    if BANK.search(name) or CARD.search(name):
        filled = F.coalesce(stripped(v) != "", F.lit(False))
        return F.when(filled, _last_four(digits_of(v))).otherwise(value), F.when(filled, "masked").otherwise(action)
    return value, action


def scrub(df: DataFrame) -> DataFrame:
    texts = {n for n, t in df.dtypes if t == "string"}
    return df.select(*[scrubbed(c, F.col(c))[0].alias(c) if c in texts or FORBIDDEN.search(c) else F.col(c) for c in df.columns])


def scrub_report(df: DataFrame) -> DataFrame:
    """name, blocked, masked, personal of every text column and every forbidden one, in one pass."""
    own = [n for n, t in df.dtypes if t == "string" or FORBIDDEN.search(n)]
    sums = df.agg(*[F.sum(F.when(scrubbed(c, F.col(c).cast("string"))[1] == a, 1).otherwise(0)).alias(f"{c}__{a}") for c in own for a in ("blocked", "masked")])
    count = lambda c, a: F.coalesce(F.col(f"{c}__{a}"), F.lit(0)).cast("long").alias(a)
    return sums.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), count(c, "blocked"), count(c, "masked"), F.lit(bool(PERSONAL.search(c)) and not c.startswith("_")).alias("personal")) for c in own])))


def redact(df: DataFrame, most: int = 200, patterns: Sequence[str] = SENSITIVE) -> DataFrame:
    """``df`` with the values of columns whose name holds a pattern hidden, and long texts cut."""

    def one(c: str, t: str) -> Column:
        if any(p in c.lower() for p in patterns):
            return F.when(F.col(c).isNotNull(), F.lit("<redacted>"))
        cut = F.concat(F.substring(c, 1, most), F.lit("... (+"), F.length(c) - most, F.lit(" chars)"))
        return F.when(F.length(c) > most, cut).otherwise(F.col(c)) if t == "string" else F.col(c)

    return df.select(*[one(c, t).alias(c) for c, t in df.dtypes])


def profile(df: DataFrame, table: str) -> DataFrame:
    """One row per column: count, nulls, distinct, least and greatest (as text), key.

    Distinct counts are exact. Every column is read and grouped on its own, so a column's values are
    shuffled once, as partial counts, and no row is multiplied by the number of columns.
    """

    def one(c: str) -> DataFrame:
        values = df.groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("k"))
        n, filled = F.coalesce(F.sum("k"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("k"))), F.lit(0))
        distinct = F.count("v")
        return values.agg(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), n.alias("n"), (n - filled).alias("nulls"), distinct.alias("distinct_values"), F.min("v").cast("string").alias("least"), F.max("v").cast("string").alias("greatest"), ((distinct == n) & (n > 0)).alias("is_key"))

    out = one(df.columns[0])
    for c in df.columns[1:]:
        out = out.unionByName(one(c))
    return out


def snapshot(tables: Mapping[str, DataFrame], payloads: Mapping[str, str] | None = None) -> DataFrame:
    """table_name, n, columns: the rows of each collection and the names of its fields, sorted.

    ``payloads`` names the column of a table that holds JSON records: its fields are then the keys that any
    record has: one row for each name leaves a task.
    """
    payloads = payloads or {}
    out = None
    for name, df in tables.items():
        if name in payloads:
            record = F.try_parse_json(F.col(payloads[name]).cast("string"))
            keys = F.map_keys(F.from_json(F.when(kind(record) == "OBJECT", F.to_json(record)), "map<string,string>"))
            # one row for each name, and one more that counts the records
            seen = df.select(F.explode(F.concat(F.array(F.lit(None).cast("string")), F.coalesce(keys, F.array().cast("array<string>")))).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("c"))
            one = seen.agg(F.lit(name).alias("table_name"), F.coalesce(F.max(F.when(F.col("k").isNull(), F.col("c"))), F.lit(0)).alias("n"), F.array_join(F.array_sort(F.collect_set("k")), ",").alias("columns"))
        else:
            one = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"), F.lit(",".join(sorted(df.columns))).alias("columns"))
        out = one if out is None else out.unionByName(one)
    return out


def fill_rates(df: DataFrame) -> DataFrame:
    """name, filled, usual: usual columns hold text on at least half of the rows."""
    filled = lambda c: F.count(F.when(F.trim(F.col(c).cast("string")) != "", 1))
    one = df.agg(F.count(F.lit(1)).alias("__n"), *[filled(c).alias(c) for c in df.columns])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("filled"), (F.col(c) >= F.greatest(F.lit(1), F.floor(F.col("__n") / 2))).alias("usual")) for c in df.columns])))


def value_shape(v: Column) -> Column:
    """A type in place of a value."""
    t = F.trim(v)
    n = F.length(t).cast("string")
    shape = F.when(t == "", "")
    for name, test in VALUE_SHAPES:
        hit = t.rlike(test) & (F.length(digits_of(t)) >= 10) if name == "PHONE" else t.rlike(test)
        shape = shape.when(hit, F.concat(F.lit("NUM("), n, F.lit(")")) if name == "NUM" else F.lit(name))
    return shape.otherwise(F.concat(F.lit("TEXT("), n, F.lit(")")))


@dataclass(frozen=True)
class Rule:
    """What a column's values must be: there (not null, not blank), one of ``allowed``, of a length, matching, or any test."""

    column: str
    required: bool = False
    allowed: tuple = ()
    most_chars: int | None = None
    pattern: str | None = None
    test: str | None = None

    def violations(self) -> list[tuple[str, Column]]:
        """(rule, whether a row breaks it); a missing value breaks ``required`` alone."""
        v = F.col(f"`{self.column}`")
        text = v.cast("string")
        there = v.isNotNull() & (stripped(text) != "")
        out = [("required", ~there)] if self.required else []
        out += [("allowed", there & ~text.isin(*map(str, self.allowed)))] if self.allowed else []
        out += [("length", there & (F.length(text) > self.most_chars))] if self.most_chars is not None else []
        out += [("pattern", there & ~text.rlike(self.pattern))] if self.pattern else []
        out += [("test", there & ~F.coalesce(F.expr(self.test), F.lit(False)))] if self.test else []
        return [(f"{self.column}: {name}", F.coalesce(test, F.lit(False))) for name, test in out]


def judged(rows: DataFrame, rules: Sequence[Rule], into: str = "violations") -> DataFrame:
    """``rows`` with the names of all rules that each breaks, in the rules' order: one expression, no pass of its own."""
    missing = sorted({r.column for r in rules} - set(rows.columns))
    if missing:
        raise ValueError(f"rules on absent columns: {missing}")
    tests = [F.when(test, F.lit(name)) for r in rules for name, test in r.violations()]
    return rows.withColumn(into, F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>"))


def split_by_rules(rows: DataFrame, rules: Sequence[Rule], key: str) -> tuple[DataFrame, DataFrame]:
    """The rows that break no rule, and (source_id, stage, message) of the others: one message with all they break."""
    marked = judged(rows, rules, "__broken")
    bad = marked.where(F.size("__broken") > 0)
    errors = bad.select(F.col(key).cast("string").alias("source_id"), F.lit("validate").alias("stage"), F.concat_ws("; ", "__broken").alias("message"))
    return marked.where(F.size("__broken") == 0).drop("__broken"), errors


def rule_counts(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rule, broken, n: how many rows break each rule, in one pass."""
    names = [name for r in rules for name, _ in r.violations()]
    one = judged(rows, rules, "__broken").agg(F.count(F.lit(1)).alias("n"), *[F.count(F.when(F.array_contains("__broken", name), 1)).alias(f"r{k}") for k, name in enumerate(names)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"r{k}").alias("broken"), F.col("n").alias("n")) for k, name in enumerate(names)])))


def suggest_keys(df: DataFrame, most_columns: int = 2, columns: Sequence[str] | None = None, slack: float = 0.1) -> DataFrame:
    """columns (comma-joined), width: the smallest sets of columns without nulls or repeats, single ones first.

    A lattice of sets, one level a round: a set that holds a key is none, and one whose sketch of
    distinct values is more than ``slack`` below the rows is left out. The others are counted exactly.
    Sketches of a level take one pass; an exact test is one partial aggregate over the set's columns.
    """
    names = list(columns or df.columns)
    filled = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"c{k}") for k, c in enumerate(names)]).first()
    n = filled["n"]
    whole = [c for k, c in enumerate(names) if filled[f"c{k}"] == n and n]
    keys: list[tuple[str, ...]] = []
    for width in range(1, most_columns + 1):
        sets = [s for s in combinations(whole, width) if not any(set(k) <= set(s) for k in keys)]
        if not sets:
            break
        sketched = df.agg(*[F.approx_count_distinct(F.struct(*[F.col(c) for c in s]), 0.03).alias(f"s{k}") for k, s in enumerate(sets)]).first()
        for s in (s for k, s in enumerate(sets) if sketched[f"s{k}"] >= (1 - slack) * n):
            if df.groupBy(*s).agg(F.count(F.lit(1)).alias("k")).where("k > 1").isEmpty():
                keys.append(s)
    return df.sparkSession.createDataFrame([(",".join(k), len(k)) for k in keys], "columns string, width int")


#: Steps that a text column's values are tried with.
CASTS = {
    "int": ("int",),
    "decimal": ("decimal",),
    "bool": ("bool",),
    "date": ("to_datetime",),
    "email": ({"email": {"strict": True}},),
    "vin": ({"vin": {"strict": True}},),
}


def cast_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """name, transform, share of a column's filled values that the transform accepts (null if none is filled)."""

    def tried(v: Column, t: Column) -> dict[str, Column]:
        takes = lambda steps: (lambda got: got.value.isNotNull() & got.error.isNull())(apply_chain(cell(v), steps))
        tests = {k: takes(steps) for k, steps in CASTS.items()}
        tests["phone"] = t.rlike(r"^[0-9\s().+-]+$") & F.length(digits_of(v)).between(10, 11)
        tests["zip"] = t.rlike("^[0-9]{5}(-?[0-9]{4})?$")
        return {k: F.when(test, 1.0).otherwise(0.0) for k, test in tests.items()}

    # one row for each cell, so that a test is one expression, whatever the number of columns; cells of one type go together
    types, parts = dict(df.dtypes), []
    for own in dict.fromkeys(types[c] for c in columns):
        named = [F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").alias("v")) for c in columns if types[c] == own]
        cells = spread(df.select(*[F.col(f"`{c}`") for c in columns if types[c] == own])).select(F.inline(F.array(*named)))
        cells = cells.withColumn("t", stripped(F.col("v"))).where("t <> ''")
        tests = tried(F.col("v"), F.col("t"))
        shares = cells.select("name", *[test.alias(k) for k, test in tests.items()]).groupBy("name").agg(*[F.avg(k).alias(k) for k in tests])
        # every column has its rows, of a table without rows too
        asked = df.sparkSession.createDataFrame([(c,) for c in columns if types[c] == own], "name string")
        shares = asked.join(shares, "name", "left")
        parts.append(shares.select("name", F.inline(F.array(*[F.struct(F.lit(k).alias("transform"), F.round(F.col(k), 4).alias("share")) for k in tests]))))
    return reduce(DataFrame.unionByName, parts)


#: Steps by what a column's name ends in, where its values bear them out.
NAMED_STEPS = (("phone", "phone"), ("mobile", "phone"), ("email", "email"), ("vin", "vin"), ("zip", "zip"), ("postcode", "zip"), ("date", "date"), ("_at", "date"), ("_on", "date"))
STEPS = {"phone": ("phone",), "zip": ("postal_code",), "int": ("int",), "decimal": ("decimal",), "bool": ("bool",), "date": ("to_datetime",), "email": ("email",), "vin": ("vin",)}


def suggest_steps(df: DataFrame, columns: Sequence[str] | None = None, least: float = 0.95) -> DataFrame:
    """name, steps (comma-joined), share: the transform chain that each column's type, name and values speak for.

    Columns that are no text need no cast. A text column is trimmed and blanks become null; the cast
    is that of its name if ``least`` of its filled values take it, else the first of whole numbers,
    decimals, truth values and dates that as many take.
    """
    names = list(columns or df.columns)
    texts = [c for c in names if dict(df.dtypes)[c] == "string"]
    spark = df.sparkSession
    plain = spark.createDataFrame([(c, "", None) for c in names if c not in texts], "name string, steps string, share double")
    if not texts:
        return plain
    shares = cast_profile(df, texts).groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("transform", "share"))).alias("s"))  # ten entries a column
    takes = lambda k: F.coalesce(F.col("s")[k], F.lit(0.0)) >= least
    named = [F.when(F.lower("name").endswith(end) & takes(k), F.lit(k)) for end, k in NAMED_STEPS]
    chosen = F.coalesce(*named, *[F.when(takes(k), F.lit(k)) for k in ("int", "decimal", "bool", "date")])
    chain = lambda k: ",".join(("trim", "nullif_empty", *STEPS[k]))
    steps = F.coalesce(*[F.when(F.col("__k") == k, F.lit(chain(k))) for k in STEPS], F.lit("trim,nullif_empty"))
    return plain.unionByName(shares.withColumn("__k", chosen).select("name", steps.alias("steps"), F.col("s")[F.col("__k")].alias("share")))


def record_pages(events: DataFrame, ids: int = 500) -> DataFrame:
    """user_id, page, body: each user's events as JSON payloads, one for each range of ``ids`` event ids, in their order."""
    record = F.concat(F.lit('{"id":'), F.coalesce(F.col("event_id").cast("string"), F.lit("null")), F.lit(',"p":'), F.coalesce("props", F.lit("null")), F.lit("}"))
    listed = F.array_sort(F.collect_list(F.struct(F.col("event_id").alias("i"), record.alias("r"))))
    pages = events.groupBy("user_id", F.floor(F.col("event_id") / ids).alias("page")).agg(F.array_join(F.transform(listed, lambda x: x["r"]), ",").alias("records"))
    return pages.select("user_id", "page", F.concat(F.lit('{"data":['), "records", F.lit("]}")).alias("body"))


def open_pages(pages: DataFrame, record_path: str = "data") -> DataFrame:
    """user_id, event_id, k of every record of the payloads."""
    opened = pages.select("user_id", F.explode(records(F.col("body"), record_path)).alias("r"))
    return opened.select("user_id", F.try_variant_get("r", "$.id", "bigint").alias("event_id"), F.try_variant_get("r", "$.p.k", "bigint").alias("k"))
