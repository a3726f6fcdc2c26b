"""Named row transforms as pairs of Columns.

A transform takes a :class:`Cell` (value and error) and gives a Cell. Bad values become an error
text beside a null, never an exception, so one bad row does not stop a job. ``apply_chain`` folds
named steps from left to right; the first error of a chain wins. All steps but ``strip_html``,
``slugify`` and ``php_unserialize`` (Arrow functions) are built-in expressions.
"""

from __future__ import annotations

import html
import json
import re
import unicodedata
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SPACE = r"[\s\p{Z}\x1C-\x1F\x85]"


class Cell(NamedTuple):
    value: Column
    error: Column


def null_text() -> Column:
    return F.lit(None).cast("string")


def cell(value: Column) -> Cell:
    return Cell(value, null_text())


TRANSFORMS: dict[str, Callable] = {}
#: Steps whose values go to Python.
IN_PYTHON = {"strip_html", "slugify", "php_unserialize"}


def transform(name: str) -> Callable:
    """Register ``fn(value, **params) -> Column or (Column, error Column)`` under a name."""

    def add(fn: Callable) -> Callable:
        TRANSFORMS[name] = fn
        return fn

    return add


@dataclass(frozen=True)
class Context:
    """What a step knows of its run."""

    entity: str = ""
    run_id: str | None = None
    run_time: str | None = None


#: Steps that see the source row and the run besides the value.
ROW_TRANSFORMS: dict[str, Callable] = {}


def row_transform(name: str) -> Callable:
    """Register ``fn(value, row, context, **params) -> Column or (Column, error Column)`` under a name.

    ``row(column)`` is the source row's column; the function gives expressions and sees no values.
    """

    def add(fn: Callable) -> Callable:
        ROW_TRANSFORMS[name] = fn
        TRANSFORMS[name] = fn
        return fn

    return add


def arrow_transform(name: str, returns: str = "string", columns: Sequence[str] = ()) -> Callable:
    """Register a function of Python values as a step: ``fn(value, row, context, **params)``, one value at a time.

    ``row`` is a dict of ``columns`` of the source row. Values come in Arrow batches, only for rows whose
    value is not null; what the function raises becomes the row's error.
    """

    def add(fn: Callable) -> Callable:
        def step(v: Column, row: Callable[[str], Column], context: Context, **params: object) -> tuple[Column, Column]:
            @F.pandas_udf(f"value {returns}, error string")
            def run(values: pd.Series, rows: pd.DataFrame) -> pd.DataFrame:
                got, errors = [], []
                for value, own in zip(values, rows.to_dict("records"), strict=True):
                    try:
                        got.append(None if value is None else fn(value, {c: own[c] for c in columns}, context, **params))
                        errors.append(None)
                    except Exception as e:  # noqa: BLE001 - a bad row must not stop the job
                        got.append(None)
                        errors.append(f"{type(e).__name__}: {e}")
                return pd.DataFrame({"value": pd.Series(got, dtype=object), "error": pd.Series(errors, dtype=object)})

            out = run(text(v), F.struct(F.lit(None).cast("string").alias("__"), *[row(c).alias(c) for c in columns]))
            return out["value"], out["error"]

        ROW_TRANSFORMS[name] = TRANSFORMS[name] = step
        IN_PYTHON.add(name)
        return fn

    return add


def text(v: Column) -> Column:
    return v.cast("string")


def stripped(v: Column) -> Column:
    """Without white space of any alphabet at either end."""
    return F.regexp_replace(text(v), f"^{SPACE}+|{SPACE}+$", "")


def empty_to_null(v: Column) -> Column:
    return F.when(v != "", v)


def digits_of(v: Column) -> Column:
    return F.regexp_replace(text(v), "[^0-9]", "")


#: Numbers as texts; Java's own suffixes (1.0d) are none.
NUMBER = r"(?i)^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)$"


def number_of(t: Column) -> Column:
    """A stripped text as a double, null if it is no number."""
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def is_number(v: Column) -> Column:
    """Whether the column's type is a number: a constant once the plan is analysed."""
    return F.typeof(v).rlike("^(tinyint|smallint|int|bigint|float|double|decimal.*)$")


def _or_error(v: Column, parsed: Column, what: str) -> tuple[Column, Column]:
    """Null and '' stay null; other text that does not parse is an error."""
    bad = v.isNotNull() & (text(v) != "") & parsed.isNull()
    return F.when(text(v) != "", parsed), F.when(bad, F.concat(F.lit(f"{what}: "), text(v)))


@transform("trim")
def trim(v: Column) -> Column:
    return stripped(v)


@transform("lower")
def lower(v: Column) -> Column:
    return F.lower(v)


@transform("upper")
def upper(v: Column) -> Column:
    return F.upper(v)


@transform("title")
def title(v: Column) -> Column:
    """A capital after every sign that is no letter."""
    return F.array_join(F.transform(F.regexp_extract_all(text(v), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1)), F.initcap), "")


@transform("nullif_empty")
def nullif_empty(v: Column) -> Column:
    return F.when(stripped(v) != "", v)


@transform("truncate")
def truncate(v: Column, length: int = 255) -> Column:
    return F.substring(v, 1, length)


@F.pandas_udf(StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


@F.pandas_udf(StringType())
def _ascii(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode(), na_action="ignore")


@transform("strip_html")
def strip_html(v: Column) -> Column:
    """Plain text: scripts and styles become a blank, line ends stay, entities are unescaped."""
    t = F.regexp_replace(text(v), r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>|</p>", "\n")
    return stripped(_unescape(F.regexp_replace(t, "<[^>]+>", "")))


@transform("slugify")
def slugify(v: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(_ascii(text(v))), "[^a-z0-9]+", "-"), "^-+|-+$", "")


@transform("concat")
def concat(v: Column, sep: str = " ") -> Column:
    """``v`` is an array of texts: its trimmed parts that are not blank."""
    return empty_to_null(F.array_join(F.filter(F.transform(v, stripped), lambda x: x != ""), sep))


@transform("split")
def split(v: Column, sep: str = " ", index: int = 0) -> Column:
    return F.try_element_at(F.split(text(v), re.escape(sep) if sep != " " else " "), F.lit(index + 1 if index >= 0 else index))


@transform("int")
def to_int(v: Column) -> tuple[Column, Column]:
    t = stripped(v)
    return _or_error(v, F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("bigint")), "not an integer")


@transform("float")
def to_float(v: Column) -> tuple[Column, Column]:
    return _or_error(v, number_of(stripped(v)), "not a number")


@transform("decimal")
def to_decimal(v: Column, places: int = 2) -> tuple[Column, Column]:
    """Half-even, as ``quantize`` rounds."""
    t = F.regexp_replace(stripped(v), "[$,]", "")
    return _or_error(v, F.bround(t.try_cast("decimal(38,18)"), places).cast(f"decimal(38,{places})"), "not a decimal")


#: Fixed word sets.
TRUE_WORDS = ("1", "true", "t", "yes", "y", "on", "active", "enabled")
FALSE_WORDS = ("0", "false", "f", "no", "n", "off", "inactive", "disabled", "")


@transform("bool")
def to_bool(v: Column) -> tuple[Column, Column]:
    t = F.lower(stripped(v))
    parsed = F.when(t.isin(*TRUE_WORDS), True).when(t.isin(*FALSE_WORDS), False)
    return parsed, F.when(v.isNotNull() & parsed.isNull(), F.concat(F.lit("not a boolean: "), text(v)))


#: Fixed formats, tried in order (month first, then day first).
DATE_FORMATS = ("yyyy-M-d H:m:s", "yyyy-M-d'T'H:m:s", "yyyy-M-d'T'H:m:sXX", "yyyy-M-d", "M/d/yyyy H:m:s", "M/d/yyyy", "d/M/yyyy", "yyyyMMdd")
#: What the casts to a timestamp may see: they also read years, times and longer years, which are no dates here.
ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$"
LONG_YEAR = "[0-9]{5}"


@transform("to_datetime")
def to_datetime(v: Column, formats: Sequence[str] | None = None, at: str | None = None) -> tuple[Column, Column]:
    """Texts by format, then ISO; numbers are Unix seconds. UTC, without a zone; ``at`` pins the time of day."""
    t = stripped(v)
    short = ~t.rlike(LONG_YEAR)
    plain = lambda f: F.when(t.rlike("^[0-9]{8}$"), t) if f == "yyyyMMdd" else F.when(short, t) if f in DATE_FORMATS else t
    cast = F.when(t.rlike(ISO), t).try_cast("timestamp")
    if formats:
        by_text = F.coalesce(*[F.try_to_timestamp(plain(f), F.lit(f)) for f in formats], cast)
    else:
        # what stands behind the first digits tells which formats a text can have
        tried = lambda sign: F.when(short, F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in DATE_FORMATS if sign in f]))
        by_text = F.when(t.rlike("^[0-9]+-"), F.coalesce(tried("-"), cast)).when(t.rlike("^[0-9]+/"), tried("/")).otherwise(F.try_to_timestamp(plain("yyyyMMdd"), F.lit("yyyyMMdd")))
    by_text = by_text.cast("timestamp_ntz")
    zero = F.lit(0)
    by_epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, t.try_cast("decimal(18,6)"))
    parsed = F.when(is_number(v), by_epoch).otherwise(by_text)
    if at:
        parsed = F.to_timestamp_ntz(F.concat(F.date_format(parsed, "yyyy-MM-dd"), F.lit(f" {at}")), F.lit("yyyy-MM-dd HH:mm:ss"))
    nothing = F.coalesce(stripped(v).startswith("0000-00-00"), F.lit(False))
    value, error = _or_error(v, parsed, "unrecognised datetime")
    return F.when(~nothing, value), F.when(~nothing, error)


@transform("to_date")
def to_date(v: Column, formats: Sequence[str] | None = None, at: str | None = None) -> tuple[Column, Column]:
    value, error = to_datetime(v, formats, at)
    return F.to_date(value), error


@transform("now")
def now(v: Column, at: str | None = None) -> Column:
    """The run's time: pass ``at`` to pin it for all entities of a run."""
    return F.lit(at).cast("timestamp_ntz") if at else F.current_timestamp().cast("timestamp_ntz")


@transform("json_encode")
def json_encode(v: Column) -> Column:
    """JSON text of any value; null stays null."""
    listed = F.to_json(F.array(v), {"ignoreNullFields": "false"})
    return F.when(v.isNotNull(), F.substr(listed, F.lit(2), F.length(listed) - 2))


@transform("json_decode")
def json_decode(v: Column, strict: bool = False) -> Column | tuple[Column, Column]:
    parsed = F.try_parse_json(text(v))
    return _or_error(v, parsed, "invalid JSON") if strict else parsed


def php_value(s: str) -> object:
    """Value of a PHP-serialised text with the markers N, b, i, d, s and a; nested arrays to any depth."""
    data, at = s.encode(), 0
    scalars = {b"b": lambda x: x == b"1", b"i": int, b"d": float}

    def upto(sign: bytes) -> bytes:
        nonlocal at
        end = data.index(sign, at)
        part, at = data[at:end], end + 1
        return part

    top: list = []
    # open arrays: what they hold so far, and how many keys and values are still to come
    open_at: list[tuple[list, int]] = [(top, 1)]
    while True:
        values, left = open_at[-1]
        if left == 0:
            open_at.pop()
            if not open_at:
                return top[0]
            at += 1  # the array's closing brace
            open_at[-1][0].append({str(k): v for k, v in zip(values[::2], values[1::2], strict=True)})
            continue
        open_at[-1] = (values, left - 1)
        kind, at = data[at : at + 1], at + 2
        if kind == b"N":
            values.append(None)
        elif kind in scalars:
            values.append(scalars[kind](upto(b";")))
        elif kind == b"s":
            size = int(upto(b":"))
            values.append(data[at + 1 : at + 1 + size].decode())
            at += size + 3
        elif kind == b"a":
            open_at.append(([], 2 * int(upto(b":"))))
            at += 1
        else:
            raise ValueError(kind)


@F.pandas_udf(StringType())
def _php_to_json(s: pd.Series) -> pd.Series:
    def one(x: str | None) -> str | None:
        try:
            return None if x is None else json.dumps(php_value(x), sort_keys=True)
        except (ValueError, IndexError, RecursionError):  # the last: too deep to be written as JSON
            return None

    return s.map(one)


@transform("php_unserialize")
def php_unserialize(v: Column) -> tuple[Column, Column]:
    """Gives JSON text."""
    return _or_error(v, _php_to_json(text(v)), "not serialised")


@transform("phone")
def phone(v: Column, region: str = "US") -> Column:
    d = digits_of(v)
    n = F.length(d)
    out = F.when(d == "", None)
    if region == "US":
        out = out.when((n == 11) & d.startswith("1"), F.concat(F.lit("+"), d)).when(n == 10, F.concat(F.lit("+1"), d))
    return out.when(n > 10, F.concat(F.lit("+"), d)).otherwise(stripped(v))


@transform("digits")
def digits(v: Column, last: int = 0) -> Column:
    d = digits_of(v)
    return empty_to_null(F.right(d, F.lit(last)) if last else d)


@transform("safe_text")
def safe_text(v: Column) -> Column:
    return F.regexp_replace(text(v), r"[`<>\x00-\x08\x0A-\x1F]", "")


@transform("clock")
def clock(v: Column) -> Column:
    t = stripped(v)
    hour = F.when(t.rlike("^[+-]?[0-9]+$"), t.try_cast("int"))
    return F.when(text(v) == "", None).when(hour.between(0, 23), F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00:00"))).otherwise(text(v))


@transform("email")
def email(v: Column, strict: bool = False) -> Column | tuple[Column, Column]:
    t = F.lower(stripped(v))
    ok = F.contains(t, F.lit("@")) & F.contains(F.substring_index(t, "@", -1), F.lit("."))
    value = F.when(ok, t)
    return (value, F.when((t != "") & ~ok, F.concat(F.lit("invalid email: "), text(v)))) if strict else value


@transform("vin")
def vin(v: Column, strict: bool = False) -> Column | tuple[Column, Column]:
    t = empty_to_null(F.upper(F.regexp_replace(text(v), r"[\s-]", "")))
    ok = t.rlike("^[A-HJ-NPR-Z0-9]{17}$")
    return (F.when(ok, t), F.when(~ok, F.concat(F.lit("invalid VIN: "), text(v)))) if strict else t


@transform("nags")
def part_number(v: Column) -> Column:
    return empty_to_null(F.upper(F.regexp_replace(text(v), r"\s", "")))


@transform("postal_code")
def postal_code(v: Column, region: str = "US") -> Column:
    t = F.upper(stripped(v))
    d = digits_of(t)
    plain = empty_to_null(t)
    if region != "US":
        return plain
    return F.when(F.length(d) == 9, F.concat(F.substring(d, 1, 5), F.lit("-"), F.substring(d, 6, 4))).when(F.length(d) == 5, d).otherwise(plain)


@transform("map")
def map_values(v: Column, values: Mapping[object, object], strict: bool = False) -> tuple[Column, Column]:
    """Listed value (a listed null counts), else ``*``, else an error if strict (for null too), else unchanged."""
    t = text(v)
    other = text(F.lit(values["*"])) if "*" in values else null_text() if strict else t
    chain, known = None, F.lit(False)
    for key, to in values.items():
        if key != "*":
            hit = F.coalesce(t == str(key), F.lit(str(key) == "None"))
            chain, known = F.when(hit, text(F.lit(to))) if chain is None else chain.when(hit, text(F.lit(to))), known | hit
    value = other if chain is None else chain.otherwise(other)
    error = F.when(~known, F.concat(F.lit("no mapping for value "), F.coalesce(t, F.lit("null")))) if strict and "*" not in values else null_text()
    return value, error


@transform("coalesce")
def coalesce(v: Column, fallback: object = None) -> Column:
    """``v`` is an array of texts: the first that is neither null nor ''."""
    return F.coalesce(F.get(F.filter(v, lambda x: x.isNotNull() & (x != "")), F.lit(0)), F.lit(fallback))


@transform("lookup")
def lookup(v: Column, **_: object) -> Column:
    raise ValueError("lookup is a join: the mapping compiler resolves it")


def steps_of(chain: Sequence[str | Mapping]) -> list[tuple[str, dict]]:
    """(name, params) of each step; unknown or malformed steps raise ValueError."""
    out = []
    for step in chain:
        name, params = (step, {}) if isinstance(step, str) else next(iter(step.items())) if isinstance(step, Mapping) and len(step) == 1 else (None, None)
        if name not in TRANSFORMS:
            raise ValueError(f"unknown transform step: {step!r}")
        out.append((name, dict(params or {})))
    return out


def apply_chain(start: Cell, chain: Sequence[str | Mapping], row: Callable[[str], Column] = F.col, context: Context | None = None) -> Cell:
    at = start
    for name, params in steps_of(chain):
        seen = (row, context or Context()) if name in ROW_TRANSFORMS else ()
        got = TRANSFORMS[name](at.value, *seen, **params)
        value, error = got if isinstance(got, tuple) else (got, None)
        at = Cell(value, at.error if error is None else F.coalesce(at.error, F.concat(F.lit(f"{name}: "), error)))
    return at


def kind_of(kind: str) -> str:
    """number, boolean, time or text, of a Spark type's name."""
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return "number"
    return "boolean" if kind == "boolean" else "time" if kind.startswith("timestamp") else "text"


def shown(v: Column, kind: str) -> Column:
    """One text per value: numbers as doubles, times to the second, texts without white space around them."""
    of = kind_of(kind)
    if of == "number":
        return text(v.cast("double"))
    return F.date_format(v, "yyyy-MM-dd'T'HH:mm:ss") if of == "time" else stripped(v) if of == "text" else text(v)


def same_value(a: Column, kind_a: str, b: Column, kind_b: str) -> Column:
    """Whether two values are alike across type systems.

    Numbers and booleans compare as numbers, a number and a text as numbers if the text is one, two
    texts as they are ('07001' is not '7001'); null is like null alone.
    """
    kinds = {kind_of(kind_a), kind_of(kind_b)}
    if kinds <= {"number", "boolean"}:
        return a.cast("double").eqNullSafe(b.cast("double"))
    if kinds == {"number", "text"}:
        x, y = (v.cast("double") if kind_of(k) == "number" else number_of(stripped(v)) for v, k in ((a, kind_a), (b, kind_b)))
        return F.coalesce(x == y, a.isNull() & b.isNull())
    if kinds == {"boolean", "text"}:
        return a.isNull() & b.isNull()
    return shown(a, kind_a).eqNullSafe(shown(b, kind_b))


def identifier(v: Column, most: int = 40) -> Column:
    """Lower snake case; a digit in front gets a prefix."""
    t = F.regexp_replace(F.lower(F.regexp_replace(text(v), "[^A-Za-z0-9]+", "_")), "^_+|_+$", "")
    return F.substring(F.when(t.rlike("^[0-9]"), F.concat(F.lit("c_"), t)).otherwise(t), 1, most)


def last_digits(v: Column, n: int = 10) -> Column:
    return F.right(digits_of(F.coalesce(text(v), F.lit(""))), F.lit(n))


def match_text(v: Column) -> Column:
    return F.lower(stripped(F.coalesce(text(v), F.lit(""))))
