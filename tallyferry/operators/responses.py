"""What a target's logged answers say: inserted, skipped or failed; the id it assigned; whether an undo holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, DateType, DecimalType, StructType, TimestampNTZType, TimestampType

from tallyferry.functions.variants import as_text, items, kind, member

#: Fixed names: outcome keys, error keys, identifier fields, and phrases of a conflict.
OK_KEYS = ("succeeded", "success", "ok", "isSuccess")
ERROR_KEYS = ("messages", "errors", "error", "message", "detail", "title")
ID_FIELDS = ("id", "key", "uuid", "guid", "_id")
CONFLICT = ("already exists", "already registered", "duplicate", "conflict")


def _accepted(v: Column) -> Column:
    """The first outcome key that holds a boolean; null if none does."""
    return F.coalesce(*[F.when(kind(member(v, f"$.{k}")) == "BOOLEAN", member(v, f"$.{k}", "boolean")) for k in OK_KEYS])


def _problem(v: Column) -> Column:
    """The first error key with content: a text, a list's texts, or an object's JSON."""

    def one(k: str) -> Column:
        x = member(v, f"$.{k}")
        listed = F.array_join(F.transform(items(x), as_text), "; ")
        text = F.when(kind(x) == "STRING", F.trim(as_text(x))).when(kind(x) == "ARRAY", listed).when(kind(x) == "OBJECT", F.nullif(as_text(x), F.lit("{}")))
        return F.substring(F.nullif(text, F.lit("")), 1, 300)

    return F.coalesce(*[one(k) for k in ERROR_KEYS])


def _assigned(record: Column, preferred: str | None) -> Column:
    """The id in a record, a bare key, or a list of one of these."""

    def of(r: Column) -> Column:
        fields = [F.nullif(as_text(member(r, f"$.{k}")), F.lit("")) for k in ((preferred,) if preferred else ID_FIELDS)]
        bare = F.when(F.trim(as_text(r)) != "", as_text(r))
        return F.when(kind(r).isin("STRING", "BIGINT"), bare).when(kind(r) == "OBJECT", F.coalesce(*fields))

    return F.when(kind(record) == "ARRAY", F.when(F.size(items(record)) == 1, of(F.get(items(record), F.lit(0))))).otherwise(of(record))


def with_outcome(log: DataFrame, status: str = "status", body: str = "body", conflict: str = "skip", preferred: str | None = None) -> DataFrame:
    """``log`` with action, target_id and problem of each answer.

    409 is a skip under ``skip``; other statuses from 400 on fail. A body with a boolean outcome key
    decides for itself: a refusal is a skip only if it reads as a conflict and the policy is
    ``skip``. Every other answer, JSON or not, is an insert.
    """
    out = log.withColumn("__v", F.try_parse_json(F.col(body)))
    out = out.withColumn("__ok", F.when(kind(F.col("__v")) == "OBJECT", _accepted(F.col("__v"))))
    out = out.withColumns({"__p": F.when(~F.col("__ok"), F.coalesce(_problem(F.col("__v")), F.lit("refused"))), "__r": F.when(F.col("__ok"), F.coalesce(member(F.col("__v"), "$.data"), F.col("__v"))).otherwise(F.col("__v"))})
    skips, s = F.lit(conflict == "skip"), F.col(status)
    already = F.lower("__p").rlike("|".join(CONFLICT))
    action = F.when((s == 409) & skips, "skipped").when(s >= 400, "failed").when(skips & already, "skipped").when(F.col("__p").isNotNull(), "failed").otherwise("inserted")
    out = out.withColumn("action", action)
    problem = F.when((F.col("action") != "inserted") & (s >= 400), F.concat(F.lit("HTTP "), s, F.lit(": "), F.substring(F.coalesce(F.col(body), F.lit("")), 1, 300))).otherwise(F.col("__p"))
    return out.withColumns({"target_id": F.when(F.col("action") == "inserted", _assigned(F.col("__r"), preferred)), "problem": problem}).drop("__v", "__ok", "__p", "__r")


def undone(status: Column, body: Column) -> Column:
    """404 and 204 count as undone, of other answers below 400 only JSON that does not refuse."""
    v = F.try_parse_json(body)
    return status.isin(404, 204) | ((status < 400) & v.isNotNull() & F.coalesce(F.when(kind(v) == "OBJECT", _accepted(v)), F.lit(True)))


def as_payload(kind: DataType, v: Column) -> Column:
    """A value as JSON can carry it: times in ISO form (fractions as far as there are any), decimals and bytes as text, inside structures too."""
    if isinstance(kind, StructType):
        return F.when(v.isNotNull(), F.struct(*[as_payload(f.dataType, v[f.name]).alias(f.name) for f in kind.fields]))
    if isinstance(kind, ArrayType):
        return F.transform(v, lambda x: as_payload(kind.elementType, x))
    if isinstance(kind, DateType):
        return F.date_format(v, "yyyy-MM-dd")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.regexp_replace(F.date_format(v, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), "[.]000000$", "")
    if isinstance(kind, BinaryType):
        return F.make_valid_utf8(v.cast("string"))
    return v.cast("string") if isinstance(kind, DecimalType) else v


def payload(rows: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """JSON text of a row's columns, nulls included; bytes that are no UTF-8 become replacement signs."""
    fields = [f for f in rows.schema.fields if columns is None or f.name in columns]
    return F.to_json(F.struct(*[as_payload(f.dataType, F.col(f"`{f.name}`")).alias(f.name) for f in fields]), {"ignoreNullFields": "false"})
