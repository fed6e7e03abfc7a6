"""Flattening and exploding of nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.operators.order import cut


def lines(df: DataFrame, text: str, number: str = "line_number", value: str = "line") -> DataFrame:
    """One row a line of ``text``, numbered from 1; rows without text give none."""
    return df.select(*[c for c in df.columns if c != text], F.posexplode(F.split(F.col(text), "\n")).alias("_k", value)).withColumn(number, (F.col("_k") + 1).cast("long")).drop("_k")


def page_lines(df: DataFrame, column: str = "page_lines") -> DataFrame:
    """One row for each struct of an array column, its fields beside the row's; ``page_line_number`` is its place, from 1, whatever was given."""
    fields = [f for f in df.schema[column].dataType.elementType.names if f != "page_line_number"]
    rest = [c for c in df.columns if c not in (column, *fields)]
    out = df.select(*rest, F.posexplode(column).alias("_k", "_line"))
    return out.select(*rest, *[F.col(f"_line.{f}").alias(f) for f in fields], (F.col("_k") + 1).cast("long").alias("page_line_number"))


def gathered(df: DataFrame, key: str, order: str, fields: list[str], name: str = "items") -> DataFrame:
    """The inverse: a row a key with its rows as an array of structs in ``order``.

    A key's rows become one value, so they must fit into a task: for pages and conversations, not for keys without bound.
    """
    return df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, *[f for f in fields if f != order]))), lambda s: s).alias(name))


def flat_columns(schema: T.StructType, prefix: str = "") -> list[tuple[str, Column]]:
    """Dotted name and column of every leaf of a struct schema; an array is a leaf, an empty struct too."""
    out = []
    for f in schema.fields:
        path = f"{prefix}.{f.name}" if prefix else f.name
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            out += flat_columns(f.dataType, path)
        else:
            out.append((path, F.col(".".join(f"`{p}`" for p in path.split(".")))))
    return out


def flattened(df: DataFrame) -> DataFrame:
    """All leaves of nested structs as columns with dotted names."""
    return df.select(*[c.alias(n) for n, c in flat_columns(df.schema)])


def variant_leaves(df: DataFrame, key: str, column: str, depth: int | None = None) -> DataFrame:
    """key, path, kind, value: leaves of a VARIANT object, paths dotted; ``depth`` stops after so many levels.

    Arrays and empty objects stay leaves. A level is one explode, so nothing is parsed in Python; without ``depth`` each level
    is checkpointed, and they end when none holds objects.
    """
    view = df.select(F.col(key).alias("key"), F.lit("").alias("path"), F.col(column).alias("v"))
    leaves = None
    level = 0
    while depth is None or level < depth:
        level += 1
        kind = F.schema_of_variant("v")
        inner = view.where(kind.startswith("OBJECT<") & (F.to_json("v") != "{}"))
        done = view.where(~(kind.startswith("OBJECT<") & (F.to_json("v") != "{}")))
        leaves = done if leaves is None else leaves.unionByName(done)
        if depth is None and inner.isEmpty():
            return leaves.select("key", "path", F.schema_of_variant("v").alias("kind"), F.coalesce(F.try_variant_get("v", "$", "string"), F.to_json("v")).alias("value"))
        each = df.sparkSession.sql("SELECT t.key, t.path AS above, e.key AS name, e.value AS v FROM {inner} t, LATERAL variant_explode(t.v) e", inner=inner)
        view = each.select("key", F.when(F.col("above") == "", F.col("name")).otherwise(F.concat_ws(".", "above", "name")).alias("path"), "v")
        view = cut(view) if depth is None else view
    return leaves.unionByName(view).select("key", "path", F.schema_of_variant("v").alias("kind"), F.coalesce(F.try_variant_get("v", "$", "string"), F.to_json("v")).alias("value"))


def placeholder(df: DataFrame, reason: Column | None = None) -> DataFrame:
    """Rows marked as failed, with a reason (``failed`` without one)."""
    return df.withColumns({"failed": F.lit(True), "failure_reason": F.coalesce(reason, F.lit("failed")) if reason is not None else F.lit("failed")})


def marked_success(df: DataFrame) -> DataFrame:
    """failed and failure_reason filled in where rows lack them."""
    out = df if "failed" in df.columns else df.withColumn("failed", F.lit(None).cast("boolean"))
    out = out if "failure_reason" in out.columns else out.withColumn("failure_reason", F.lit(None).cast("string"))
    return out.withColumns({"failed": F.coalesce("failed", F.lit(False)), "failure_reason": F.coalesce("failure_reason", F.lit(""))})
