"""Rows of answers by their schema: identity, values, and the confidence of every leaf in the shape of the values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions.text import identity_pair

LEAF = "struct<field_confidence_logprobs:double,field_confidence_ratio:double>"


def confidence_tree(value: Column, kind: T.DataType, by_pointer: Column, path: Column) -> Column:
    """Mirrors ``value`` of type ``kind``: each leaf is replaced by the struct that the map ``by_pointer`` has for its JSON pointer.

    A leaf that the map lacks has null measures; a null struct's leaves are looked up like others, a null array stays null.
    """
    if isinstance(kind, T.StructType):
        escaped = lambda name: name.replace("~", "~0").replace("/", "~1")
        return F.struct(*[confidence_tree(value.getField(f.name), f.dataType, by_pointer, F.concat(path, F.lit(f"/{escaped(f.name)}"))).alias(f.name) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v, k: confidence_tree(v, kind.elementType, by_pointer, F.concat(path, F.lit("/"), k.cast("string"))))
    none = F.struct(F.lit(None).cast("double").alias("field_confidence_logprobs"), F.lit(None).cast("double").alias("field_confidence_ratio"))
    return F.coalesce(F.try_element_at(by_pointer, path).cast(LEAF), none)


def default_rows(df: DataFrame, answer: str, reference: str, by_pointer: str | None = None) -> DataFrame:
    """One row an answer (a struct): its fields, field_confidence if there is a map of pointers, and the identity of the reference.

    Fields called image_name or file_name give way to the identity. Rows whose map is empty or null have no confidence.
    """
    kind = df.schema[answer].dataType
    pair = identity_pair(F.col(reference))
    columns = [F.col(f"{answer}.{f.name}").alias(f.name) for f in kind.fields if f.name not in ("image_name", "file_name")]
    if by_pointer:
        tree = confidence_tree(F.col(answer), kind, F.col(by_pointer), F.lit(""))
        columns.append(F.when(F.size(by_pointer) > 0, tree).alias("field_confidence"))
    return df.select(*columns, pair["image_name"].alias("image_name"), pair["file_name"].alias("file_name"))


def line_rows(df: DataFrame, answer: str, reference: str, by_pointer: str | None = None, lines: str = "page_lines") -> DataFrame:
    """One row a line of an answer's array ``lines``: the line's fields, the page's, both confidences in one struct, the identity.

    Of fields that both have the page's count.
    """
    kind = df.schema[answer].dataType
    inner = kind[lines].dataType.elementType
    page = [f for f in kind.fields if f.name != lines]
    own = [f for f in inner.fields if f.name not in {p.name for p in page}]
    each = df.select("*", F.posexplode(F.col(f"{answer}.{lines}")).alias("_at", "_line"))
    pair = identity_pair(F.col(reference))
    columns = [F.col(f"_line.{f.name}").alias(f.name) for f in own] + [F.col(f"{answer}.{f.name}").alias(f.name) for f in page]
    if by_pointer:
        tree = lambda c, f, at: confidence_tree(c, f.dataType, F.col(by_pointer), F.concat(at, F.lit(f"/{f.name}"))).alias(f.name)
        place = F.concat(F.lit(f"/{lines}/"), F.col("_at").cast("string"))
        leaves = [tree(F.col(f"_line.{f.name}"), f, place) for f in own] + [tree(F.col(f"{answer}.{f.name}"), f, F.lit("")) for f in page]
        columns.append(F.when(F.size(by_pointer) > 0, F.struct(*leaves)).alias("field_confidence"))
    columns = [c for c in columns]
    return each.select(*columns, pair["image_name"].alias("image_name"), pair["file_name"].alias("file_name"))


#: What makes rows of an answer, by the name of its schema; others have one row.
HANDLERS: dict[str, Callable[..., DataFrame]] = {"TextPage": line_rows}


def rows_of(schema_name: str, df: DataFrame, answer: str, reference: str, by_pointer: str | None = None) -> DataFrame:
    return HANDLERS.get(schema_name, default_rows)(df, answer, reference, by_pointer)


def resolved(name: str, schemas: dict[str, T.StructType], aliases: dict[str, str] | None = None) -> T.StructType:
    """The schema of a name or alias in any case; an unknown one raises."""
    known = {k.lower(): v for k, v in schemas.items()}
    short = {k.lower(): v.lower() for k, v in (aliases or {}).items()}
    key = name.strip().lower()
    if (key := short.get(key, key)) not in known:
        raise KeyError(f"no schema {name!r}; there are {', '.join(sorted(schemas))}")
    return known[key]
