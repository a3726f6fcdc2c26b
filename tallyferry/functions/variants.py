"""JSON values of unknown shape as variant Columns."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyferry.functions.paths import json_path


def kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT, BOOLEAN, ... of a variant; null for SQL null."""
    return F.regexp_extract(F.schema_of_variant(v), "^([A-Z]+)", 1)


def member(v: Column, path: str, of: str = "variant") -> Column:
    return F.try_variant_get(v, path, of)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def items(v: Column) -> Column:
    """The elements of a JSON list as array<variant>; null for anything else."""
    return member(v, "$", "array<variant>")


def _step(v: Column, name: str, depth: int = 2) -> Column:
    """What a path part names: a member, an element by number, or the member of each element of a list."""
    quoted = name.replace("\\", "\\\\").replace('"', '\\"')
    inside = lambda x: member(x, f'$["{quoted}"]')  # noqa: E731 - null for all but an object that has it
    if name.isdigit():
        return bind(v, lambda x: F.coalesce(member(x, f"$[{name}]"), inside(x)))
    nothing = F.parse_json(F.lit("null"))
    each = lambda listed: F.to_variant_object(F.transform(listed, lambda x: F.coalesce(_step(x, name, depth - 1) if depth else nothing, nothing)))
    return bind(v, lambda x: bind(items(x), lambda listed: F.when(listed.isNotNull(), each(listed)).otherwise(inside(x))))


@F.pandas_udf(StringType())
def _deep_path(values: pd.Series, paths: pd.Series) -> pd.Series:
    def one(value: str | None, path: str) -> str | None:
        try:
            return None if value is None else json.dumps(json_path(json.loads(value), path))
        except (ValueError, RecursionError):
            return None

    return pd.Series([one(v, p) for v, p in zip(values, paths, strict=True)], dtype=object)


def resolve(v: Column, path: str) -> Column:
    """The variant at a dotted path; list elements by number, a name over a list gives the list of its values.

    Values with lists in three levels or more, directly in each other, leave the JVM as text (other rows send nulls).
    """
    names = path.split(".") if path else []
    deep = F.schema_of_variant(v).rlike("ARRAY<ARRAY<ARRAY<") if any(not n.isdigit() for n in names) else F.lit(False)
    out = v
    for name in names:
        out = _step(out, name)
    if all(n.isdigit() for n in names):
        return out
    return F.when(deep, F.try_parse_json(_deep_path(F.when(deep, F.to_json(v)), F.lit(path)))).otherwise(out)


def as_text(v: Column) -> Column:
    """Scalars as their text, lists and objects as JSON text, JSON null as null."""
    plain = lambda x: F.when(~F.is_variant_null(x), F.to_json(x))
    return bind(v, lambda x: F.when(kind(x) == "STRING", member(x, "$", "string")).otherwise(plain(x)))


def records(body: Column, path: str = "") -> Column:
    """array<variant> of the records at ``path`` of a JSON text: a list's elements, or one object."""
    at = resolve(F.try_parse_json(body), path)
    return F.coalesce(items(at), F.when(kind(at) == "OBJECT", F.array(at)), F.array().cast("array<variant>"))


#: Fixed names of the list inside a payload.
WRAPPERS = ("data", "items", "results", "records", "rows", "hits", "edges", "content", "products", "list")


def payload_shape(body: Column) -> Column:
    """(wrapper, items, fields) of a JSON payload: where its list is, how long, and the first record's sorted names."""
    v = F.try_parse_json(body)
    names = lambda x: F.array_sort(F.json_object_keys(F.to_json(x)))
    shape = lambda wrapper, n, fields: F.struct(F.lit(wrapper).alias("wrapper"), n.alias("items"), F.coalesce(fields, F.array().cast("array<string>")).alias("fields"))
    count = lambda x: F.size(items(x)).cast("long")
    first = lambda x: F.get(items(x), F.lit(0))
    out = F.when(kind(v) == "ARRAY", shape("", count(v), F.when(kind(first(v)) == "OBJECT", names(first(v)))))
    for w in WRAPPERS:
        inner = member(v, f"$.{w}")
        out = out.when((kind(inner) == "ARRAY") & (kind(first(inner)) == "OBJECT"), shape(w, count(inner), names(first(inner))))
    return out.when(kind(v) == "OBJECT", shape("", F.lit(None).cast("long"), names(v))).when(v.isNotNull(), shape("", F.lit(None).cast("long"), F.array().cast("array<string>")))
