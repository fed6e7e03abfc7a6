"""Checks of VARIANT records against a field specification, typed corrections, and paths of a schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """One field of a record: its JSON kind (STRING, BIGINT, DOUBLE, BOOLEAN, DATE, ARRAY, OBJECT), whether it must be there, allowed values, bounds."""

    path: str
    kind: str
    required: bool = True
    allowed: tuple[str, ...] = ()
    least: str | None = None
    most: str | None = None


def _right_kind(v: Column, kind: str) -> Column:
    seen = F.schema_of_variant(v)
    if kind in ("ARRAY", "OBJECT"):
        return seen.startswith(kind)
    if kind == "DATE":
        return (seen == "STRING") & F.try_to_date(F.try_variant_get(v, "$", "string"), "yyyy-MM-dd").isNotNull()
    if kind == "DOUBLE":
        return seen.isin("BIGINT", "DOUBLE", "FLOAT") | seen.startswith("DECIMAL")
    return seen == kind


def bound(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def violations(record: Column, fields: list[Field]) -> Column:
    """Sorted messages ``path: what``: missing, wrong type (nothing is coerced), not allowed, out of range. Further keys are ignored.

    A field that is optional may be null or absent.
    """

    def message(f: Field, v: Column) -> Column:
        absent = v.isNull() | (F.schema_of_variant(v) == "VOID")
        said = F.when(absent, F.lit("missing") if f.required else F.lit(None).cast("string")).when(~_right_kind(v, f.kind), "wrong type")
        text = F.try_variant_get(v, "$", "string")
        if f.allowed:
            said = said.when(~text.isin(*f.allowed), "not allowed")
        value = F.try_to_date(text, "yyyy-MM-dd") if f.kind == "DATE" else F.try_variant_get(v, "$", "double") if f.kind in ("BIGINT", "DOUBLE") else text
        for bound, outside in ((f.least, lambda a, b: a < b), (f.most, lambda a, b: a > b)):
            if bound is not None:
                said = said.when(outside(value, F.lit(bound).cast("date" if f.kind == "DATE" else "double" if f.kind in ("BIGINT", "DOUBLE") else "string")), "out of range")
        return F.concat(F.lit(f"{f.path}: "), said)

    def checked(r: Column, f: Field) -> Column:
        return bound(F.try_variant_get(r, f"$.{f.path}", "variant"), lambda v: message(f, v))

    # The record is parsed once and each field read from it once.
    return F.array_sort(F.array_compact(bound(record, lambda r: F.array(*[checked(r, f) for f in fields]))))


def corrected(value: Column, kind: str) -> Column:
    """A correction typed by its field; blank gives null, and what cannot be read too."""
    return F.nullif(F.trim(value), F.lit("")).try_cast(kind)


def schema_paths(schema: T.StructType, prefix: str = "") -> set[str]:
    """Dotted paths of a schema, through structs and the elements of arrays."""
    out = set()
    for f in schema.fields:
        path = f"{prefix}.{f.name}" if prefix else f.name
        out.add(path)
        kind = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        if isinstance(kind, T.StructType):
            out |= schema_paths(kind, path)
    return out


def eligible_fields(schema: T.StructType, metadata: set[str]) -> list[str]:
    """Leaf paths of a row that may be validated: in the schema, no metadata, no containers."""
    out = []
    for f in schema.fields:
        if f.name in metadata:
            continue
        if isinstance(f.dataType, T.StructType):
            out += [f"{f.name}.{p}" for p in eligible_fields(f.dataType, metadata)]
        elif not isinstance(f.dataType, (T.ArrayType, T.MapType)):
            out.append(f.name)
    return out


def tuned_workers(rates: Column, start: int, step: int, least: int, most: int, ratio: float = 1.05) -> Column:
    """Workers after each of an array of upload rates: a step up while the rate grows by ``ratio``, a step down when it falls by it."""
    state = F.struct(F.array().cast("array<int>").alias("done"), F.lit(start).alias("workers"), F.lit(None).cast("double").alias("last"))

    def fold(s: Column, rate: Column) -> Column:
        move = F.when(s["last"].isNull() | (rate >= s["last"] * ratio), step).when(rate * ratio < s["last"], -step).otherwise(0)
        now = F.greatest(F.lit(least), F.least(F.lit(most), s["workers"] + move))
        return F.struct(F.array_append(s["done"], now).alias("done"), now.alias("workers"), rate.cast("double").alias("last"))

    return F.aggregate(rates, state, fold, lambda s: s["done"])
