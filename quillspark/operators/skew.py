"""Joins in which one key may hold a large share of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key counts as hot from this share of all rows on, so there are at most as many hot keys as its inverse.
SHARE = 1 / 1000


def any_null(on: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.isnull(c) for c in on])


def hot_keys(rows: DataFrame, on: list[str], share: float = SHARE) -> DataFrame:
    """The keys that hold more than ``share`` of all rows, at any size of the table: at most 1 / ``share`` of them, so that they
    may be broadcast. Rows with a null key count in the total, but null is no key."""
    return _many(rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n_of_key")), on, share)


def _many(counts: DataFrame, on: list[str], share: float) -> DataFrame:
    total = counts.agg(F.sum("_n_of_key").alias("_n_of_all"))
    many = F.col("_n_of_key") > F.col("_n_of_all") * share
    return counts.where(~any_null(on)).crossJoin(F.broadcast(total)).where(many).select(*on)


def lookup(rows: DataFrame, dimension: DataFrame, on: list[str], how: str = "inner", share: float = SHARE, size: str | None = None) -> DataFrame:
    """``rows`` joined with ``dimension``, which has at most one row for a key, without a task that gets a whole hot key.

    Hot keys are counted first, with an aggregate that combines before the shuffle; where ``dimension`` is an aggregate of
    ``rows`` itself, its column ``size`` may tell the number of rows of each key instead. What ``dimension`` says of hot keys
    is broadcast (at most 1 / ``share`` rows); all other rows are joined by shuffle; rows with a null key, which match
    nothing, are not shuffled at all. ``how`` is inner, left, left_semi or left_anti. ``rows`` is read several times: give a table
    that is cheap to read again. Repeated rows stay; an empty side gives what the join gives. Columns are those of the join.
    """
    hot = _many(dimension.select(*on, F.col(size).alias("_n_of_key")), on, share) if size else hot_keys(rows, on, share)
    own = dimension.join(F.broadcast(hot), on, "left_semi")
    known = rows.where(~any_null(on))
    # Marked rather than parted by semi- and anti-joins: each marking gives all rows, whatever share of them is hot.
    marked = known.join(F.broadcast(hot.withColumn("_is_hot", F.lit(True))), on, "left")
    out = marked.where("_is_hot IS NULL").drop("_is_hot").join(dimension, on, how)
    out = out.unionByName(marked.where("_is_hot").drop("_is_hot").join(F.broadcast(own), on, how))
    if how in ("left", "left_anti"):
        out = out.unionByName(rows.where(any_null(on)), allowMissingColumns=True)
    return out
