"""Declarative mappings compiled to DataFrame expressions.

An :class:`Entity` names source fields, transform chains and target paths. :func:`build_rows` turns
it into one projection (plus a left join per lookup): accepted rows with nested targets, and an
error text for each row whose first failing field, in field order, rejects it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyferry.functions.transforms import IN_PYTHON, Cell, Context, apply_chain, cell, empty_to_null, null_text, steps_of
from tallyferry.operators.storage import spread, spread_join


IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{0,62}")


@dataclass(frozen=True)
class Field:
    to: str
    source: str | tuple[str, ...] | None = None
    const: object = None
    transform: tuple = ()
    required: bool = False
    default: object = None

    def __post_init__(self) -> None:
        if self.source is None and self.const is None and self.default is None:
            raise ValueError(f"{self.to}: one of source, const or default is needed")
        steps_of(self.transform)


@dataclass(frozen=True)
class Entity:
    name: str
    source: str
    source_key: str
    target: str
    target_key: str
    fields: tuple[Field, ...]
    where: str | None = None
    conflict: str = "error"
    depends_on: tuple[str, ...] = ()
    id_map_from: str | None = None
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.conflict not in ("skip", "update", "error"):
            raise ValueError(f"{self.name}: conflict is skip, update or error")

    @property
    def map_key(self) -> str:
        """The column that names a row in the id map; it may differ from the sort key."""
        return self.id_map_from or self.source_key

    def clock_made(self) -> set[str]:
        """Target roots that a ``now`` step fills: no later run gives the same value."""
        return {str(path_tokens(f.to)[0]) for f in self.fields if any(name == "now" for name, _ in steps_of(f.transform))}

    def lookups(self) -> list[tuple[int, int, dict]]:
        """(field number, step number, params) of every lookup step."""
        return [(i, k, p) for i, f in enumerate(self.fields) for k, (name, p) in enumerate(steps_of(f.transform)) if name == "lookup"]


def fingerprint(entities: Sequence[Entity]) -> str:
    stated = [{k: v for k, v in asdict(e).items() if v or k not in ("not_null", "unique")} for e in entities]
    return hashlib.sha256(json.dumps(stated, sort_keys=True, default=str).encode()).hexdigest()[:16]


def in_order(entities: Sequence[Entity], only: Sequence[str] | None = None) -> list[Entity]:
    """Parents first; asked-for entities pull in what they depend on."""
    by_name = {e.name: e for e in entities}
    if len(by_name) < len(entities):
        raise ValueError("entity names must be unique")
    out: list[Entity] = []

    def visit(name: str, above: tuple[str, ...]) -> None:
        if name in above:
            raise ValueError(f"dependency cycle: {' -> '.join((*above, name))}")
        if name not in by_name:
            raise ValueError(f"unknown entity {name}")
        if by_name[name] in out:
            return
        for parent in (*by_name[name].depends_on, *[p["entity"] for _, _, p in by_name[name].lookups()]):
            if parent in by_name and parent != name:
                visit(parent, (*above, name))
        out.append(by_name[name])

    for name in only or by_name:
        visit(name, ())
    return out


def structural_problems(entity: Entity, source: DataFrame, target: DataFrame | None = None) -> list[str]:
    """What stops a mapping before any row is read: absent source columns, keys, target columns."""
    read = {c for f in entity.fields for c in ((f.source,) if isinstance(f.source, str) else f.source or ())} | {entity.source_key, entity.map_key}
    out = [f"source column {c} is missing" for c in sorted(read - set(source.columns))]
    if target is not None:
        out += [f"target column {c} is missing" for c in sorted(_roots(entity) - set(target.columns))]
        if entity.target_key not in target.columns:
            out.append(f"target key {entity.target_key} is missing")
    return out


def type_problems(entity: Entity, source: DataFrame, target: DataFrame | None = None) -> list[str]:
    """Constraints on columns that no field fills, target names that are no identifiers, and types that the stored column cannot take."""
    roots = _roots(entity) | {entity.target_key}
    out = [f"constrained column {c} is filled by no field" for c in (*entity.not_null, *entity.unique) if c not in roots]
    out += [f"target column {c} is no plain identifier" for c in sorted(_roots(entity)) if not IDENTIFIER.fullmatch(c)]
    if out or target is None or not {c for f in entity.fields for c in ((f.source,) if isinstance(f.source, str) else f.source or ())} <= set(source.columns):
        return out
    own, ids = dict(target.dtypes), source.sparkSession.createDataFrame([], "entity string, source_id string, target_id string")
    given = {c: t for c, t in build_rows(entity, source, ids).dtypes if c not in HIDDEN}
    return [f"target column {c} is {own[c]}, not {t}" for c, t in given.items() if c in own and own[c] != t]


def unmapped(entity: Entity, target: DataFrame) -> list[str]:
    """Target columns that no field fills; the target's own key may stay so."""
    return [c for c in target.columns if c not in _roots(entity) and c != entity.target_key]


def _roots(entity: Entity) -> set[str]:
    return {str(path_tokens(f.to)[0]) for f in entity.fields}


def path_tokens(path: str) -> list[str | int]:
    """``a.b[0].c`` -> ['a', 'b', 0, 'c']."""
    out: list[str | int] = []
    for part in path.split("."):
        m = re.fullmatch(r"([A-Za-z_]\w*)((?:\[\d+\])*)", part)
        if not m:
            raise ValueError(f"bad target path {path!r}")
        out += [m[1], *[int(x) for x in re.findall(r"\d+", m[2])]]
    return out


def _nest(paths: list[tuple[list, Column, bool]], const_leaves: set[str]) -> Column:
    """Struct or array of what lies below; blank array entries go."""
    if len(paths) == 1 and not paths[0][0]:
        return paths[0][1]
    heads = list(dict.fromkeys(t[0][0] for t in paths))
    below = {h: [(t[1:], c, k) for t, c, k in paths if t[0] == h] for h in heads}
    if isinstance(heads[0], int):
        entries = [_nest(below[h], const_leaves) for h in sorted(heads)]
        # an entry with nothing but constants (by leaf name) is blank
        data = [[c for t, c, k in below[h] if not ([x for x in t if isinstance(x, str)][-1:] and [x for x in t if isinstance(x, str)][-1] in const_leaves)] for h in sorted(heads)]
        kept = [F.when(_any([c.isNotNull() & (c.cast("string") != "") for c in cs]), e) if cs else F.when(F.lit(False), e) for cs, e in zip(data, entries, strict=True)]
        return F.array_compact(F.array(*kept))
    return F.struct(*[_nest(below[h], const_leaves).alias(str(h)) for h in heads])


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return F.coalesce(out, F.lit(False))


def _looked_up(df: DataFrame, at: Cell, params: dict, name: str, id_map: DataFrame, by: str, plan_mode: bool) -> tuple[DataFrame, Cell]:
    """A lookup step as a left join on the id map; null keys are dealt out by ``by``."""
    df = df.withColumns({f"{name}_v": empty_to_null(at.value.cast("string")), f"{name}_e": at.error})
    ids = id_map.where((F.col("entity") == params["entity"]) & F.col("source_id").isNotNull()).select(F.col("source_id").alias(f"{name}_s"), F.col("target_id").alias(f"{name}_t"))
    df = spread_join(df, ids, f"{name}_v", f"{name}_s", by=[by])
    v, t = F.col(f"{name}_v"), F.col(f"{name}_t")
    missed = F.when(v.isNotNull() & t.isNull(), F.concat(F.lit(f"lookup: no {params['entity']} for "), v)) if params.get("required", False) and not plan_mode else null_text()
    return df, Cell(F.coalesce(t, v) if plan_mode else t, F.coalesce(F.col(f"{name}_e"), missed))


def build_rows(entity: Entity, source: DataFrame, id_map: DataFrame | None = None, plan_mode: bool = False, run_time: str | None = None, run_id: str | None = None) -> DataFrame:
    """``__key`` (text), ``__order``, ``__error``, ``__clock``, ``__unresolved`` and the target columns of every source row.

    ``id_map`` holds (entity, source_id, target_id), unique by the first two. A lookup that finds
    nothing gives null, or an error where it is ``required``; in plan mode its source value passes
    through and ``__unresolved`` names the entity. ``__clock`` names the targets that fell back to
    ``@now``.
    """
    df = source.where(entity.where) if entity.where else source
    missing = sorted({c for f in entity.fields for c in ((f.source,) if isinstance(f.source, str) else f.source or ())} - set(source.columns))
    if missing:
        raise ValueError(f"source columns missing: {missing}")
    if any(name in IN_PYTHON for f in entity.fields for name, _ in steps_of(f.transform)):
        df = spread(df)
    context = Context(entity.name, run_id, run_time)
    cells: list[Cell] = []
    clock, unresolved = [], []
    for i, f in enumerate(entity.fields):
        steps = [dict([s]) for s in steps_of(f.transform)]
        at = cell(F.lit(f.const)) if f.const is not None else cell(F.array(*[F.col(c).cast("string") for c in f.source]) if isinstance(f.source, tuple) else F.col(f.source) if f.source else null_text())
        k = 0
        while "lookup" in {n for s in steps for n in s}:
            cut = next(j for j, s in enumerate(steps) if "lookup" in s)
            at, name = apply_chain(at, steps[:cut], context=context), f"__lk{i}_{k}"
            df, at = _looked_up(df, at, steps[cut]["lookup"], name, id_map, entity.source_key, plan_mode)
            unresolved.append(F.when(F.col(f"{name}_v").isNotNull() & F.col(f"{name}_t").isNull(), F.lit(steps[cut]["lookup"]["entity"])))
            steps, k = steps[cut + 1 :], k + 1
        at = apply_chain(at, steps, context=context)
        if f.default is not None:
            now = f.default == "@now"
            default = (F.lit(run_time).cast("timestamp_ntz") if run_time else F.current_timestamp().cast("timestamp_ntz")) if now else F.lit(f.default)
            if now:
                clock.append(F.when(at.value.isNull(), F.lit(str(path_tokens(f.to)[0]))))
            at = Cell(F.coalesce(at.value, default), at.error)
        if f.required:
            at = Cell(at.value, F.coalesce(at.error, F.when(at.value.isNull(), F.lit("required field resolved to null"))))
        cells.append(Cell(at.value, F.when(at.error.isNotNull(), F.concat(F.lit(f"{f.to}: "), at.error))))
    # staged, so that nested chains are computed once
    names = lambda tests: F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")
    staged = df.select(F.col(entity.map_key).cast("string").alias("__key"), F.col(entity.source_key).alias("__order"), names(clock).alias("__clock"), names(unresolved).alias("__unresolved"), *[c.value.alias(f"__v{i}") for i, c in enumerate(cells)], *[c.error.alias(f"__e{i}") for i, c in enumerate(cells)])
    roots: dict[str, list] = {}
    consts: dict[str, set[str]] = {}
    for i, f in enumerate(entity.fields):
        tokens = path_tokens(f.to)
        roots.setdefault(str(tokens[0]), []).append((tokens[1:], F.col(f"__v{i}"), f.const is not None))
        if f.const is not None:
            consts.setdefault(str(tokens[0]), set()).add([t for t in tokens if isinstance(t, str)][-1])
    error = F.coalesce(*[F.col(f"__e{i}") for i in range(len(cells))])
    return staged.select(*HIDDEN[:2], error.alias("__error"), *HIDDEN[3:], *[_nest(paths, consts.get(root, set())).alias(root) for root, paths in roots.items()])


#: Columns of built rows that are no target columns.
HIDDEN = ("__key", "__order", "__error", "__clock", "__unresolved")


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where("__error is null").drop(*HIDDEN)


def rejected(rows: DataFrame, entity: str, stage: str = "transform") -> DataFrame:
    """entity, source_id, stage, message of the rows that failed."""
    return rows.where("__error is not null").select(F.lit(entity).alias("entity"), F.col("__key").alias("source_id"), F.lit(stage).alias("stage"), F.col("__error").alias("message"))


def error_summary(errors: DataFrame) -> DataFrame:
    return errors.groupBy("entity", "stage", "message").agg(F.count(F.lit(1)).alias("n"))


def plan_report(entity: Entity, source: DataFrame, target: DataFrame, id_map: DataFrame | None = None) -> DataFrame:
    """One row: rows, accepted, failed, keys that the target has; nothing is written."""
    rows = build_rows(entity, source, id_map, plan_mode=True)
    known = target.select(F.col(entity.target_key).cast("string").alias("__t")).distinct().withColumn("__has", F.lit(1))
    joined = spread_join(rows.withColumn("__k", F.col(entity.target_key).cast("string")), known, "__k", "__t", by=["__key"])
    ok = F.col("__error").isNull()
    return joined.agg(F.count(F.lit(1)).alias("source_rows"), F.count(F.when(ok, 1)).alias("would_write"), F.count(F.when(~ok, 1)).alias("would_fail"), F.count(F.when(ok & F.col("__has").isNotNull(), 1)).alias("existing_keys"))


def plan(entity: Entity, source: DataFrame, target: DataFrame, id_map: DataFrame | None = None, limit: int = 0, failures: int = 50, samples: int = 5) -> DataFrame:
    """part, name, value: the dry run of an entity as a report; nothing is written.

    ``problem`` rows alone if the mapping cannot run; else ``unmapped`` target columns, the ``count``
    of rows, of failed ones and of keys that the target has, the first ``failure`` messages and
    ``sample`` rows (JSON) by source key, and for each entity with ``unresolved`` lookups their
    number. ``limit`` takes the first rows by source key.
    """
    spark = source.sparkSession
    problems = structural_problems(entity, source, target)
    schema = "part string, name string, value string"
    if problems:
        return spark.createDataFrame([("problem", str(i), p) for i, p in enumerate(problems)], schema)
    own = source.where(entity.where) if entity.where else source
    own = own.orderBy(entity.source_key).limit(limit) if limit else own
    rows = build_rows(entity, own, id_map, plan_mode=True)
    out = spark.createDataFrame([("unmapped", c, None) for c in unmapped(entity, target)], schema)
    if entity.target_key in rows.columns:
        counts = plan_report(entity, own, target, id_map).select("source_rows", "would_fail", "existing_keys")
    else:
        counts = rows.agg(F.count(F.lit(1)).alias("source_rows"), F.count("__error").alias("would_fail"))
    out = out.unionByName(counts.select(F.inline(F.array(*[F.struct(F.lit("count").alias("part"), F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in counts.columns]))))
    bad = rows.where("__error is not null").orderBy("__order", "__key").limit(failures)
    out = out.unionByName(bad.select(F.lit("failure").alias("part"), F.col("__key").alias("name"), F.col("__error").alias("value")))
    good = rows.where("__error is null").orderBy("__order", "__key").limit(samples)
    as_json = F.to_json(F.struct(*[F.col(c) for c in rows.columns if c not in HIDDEN]), {"ignoreNullFields": "false"})
    out = out.unionByName(good.select(F.lit("sample").alias("part"), F.col("__key").alias("name"), as_json.alias("value")))
    lost = rows.select(F.explode("__unresolved").alias("name")).groupBy("name").agg(F.count(F.lit(1)).cast("string").alias("value"))
    return out.unionByName(lost.select(F.lit("unresolved").alias("part"), "name", "value"))
