"""Walks between two bounds, each step after the one before, without a task that holds a whole walk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators.order import cut, with_index

#: Steps that are put together in one array.
CHUNK = 256


def _then(f: Column, g: Column) -> Column:
    """What f and then g do: a step adds ``a`` and stays from ``lo`` to ``hi``, and so do two of them."""
    within = lambda v: F.least(g["hi"], F.greatest(g["lo"], v + g["a"]))
    return F.struct((f["a"] + g["a"]).alias("a"), within(f["lo"]).alias("lo"), within(f["hi"]).alias("hi"))


def _applied(x: Column, f: Column) -> Column:
    return F.least(f["hi"], F.greatest(f["lo"], x + f["a"]))


def walked(steps: DataFrame, index: str, chunk: int = CHUNK) -> DataFrame:
    """``index`` and ``value``: where a walk is after each step.

    ``steps`` has ``index`` (0, 1, 2 and so on), a, lo and hi (long): a step adds a and stays from lo to hi; one with lo equal
    to hi begins anew. Steps compose, so the steps of a chunk are put together into one, those of the chunks again, until one
    is left; then chunks are walked through from where each begins. No task holds more than a chunk.
    """
    level = steps.select(F.col(index).cast("long").alias("i"), F.struct(*[F.col(c).cast("long").alias(c) for c in ("a", "lo", "hi")]).alias("f"))
    levels = []
    while True:
        held = level.groupBy(F.floor(F.col("i") / chunk).alias("g")).agg(F.array_sort(F.collect_list(F.struct("i", "f"))).alias("fs"))
        levels.append(cut(held))
        first = F.struct(F.lit(0).cast("long").alias("a"), F.lit(-(2**62)).alias("lo"), F.lit(2**62).alias("hi"))
        level = levels[-1].select(F.col("g").alias("i"), F.aggregate("fs", first, lambda s, e: _then(s, e["f"])).alias("f"))
        if levels[-1].limit(2).count() < 2:
            break
    # The first step of all begins anew, so it does not matter from where.
    starts = steps.sparkSession.range(1).select(F.col("id").alias("g"), F.lit(0).cast("long").alias("x"))
    for held in reversed(levels):
        state = F.struct(F.array().cast("array<struct<i:bigint,before:bigint,after:bigint>>").alias("done"), F.col("x").alias("x"))

        def on(s: Column, e: Column) -> Column:
            after = _applied(s["x"], e["f"])
            return F.struct(F.array_append(s["done"], F.struct(e["i"].alias("i"), s["x"].alias("before"), after.alias("after"))).alias("done"), after.alias("x"))

        each = held.join(starts, "g").select(F.explode(F.aggregate("fs", state, on, lambda s: s["done"])).alias("e")).select("e.*")
        starts = each.select(F.col("i").alias("g"), F.col("before").alias("x"))
    return each.select(F.col("i").alias(index), F.col("after").alias("value"))


def tuned(df: DataFrame, user: str, order: str, rate: str, start: int, step: int, least: int, most: int, ratio: float = 1.05, chunk: int = CHUNK) -> DataFrame:
    """user, order, rate, workers: ``schema.tuned_workers`` row by row, for users with any number of rates.

    A step up while the rate grows by ``ratio``, one down when it falls by it: the move follows from a rate and the one before,
    so the workers are a walk. A rate that is null moves nothing, and the one after it steps up. ``order`` should be total
    within a user; null users are one user; an empty table gives an empty one.
    """
    held = with_index(df.select(user, order, rate), user, order, name="_i").withColumn("_g", F.floor(F.col("_i") / chunk))
    here = F.struct(F.col(user).alias("u"), F.col(rate).cast("double").alias("r"))
    ends = held.where((F.col("_i") + 1) % chunk == 0).select((F.col("_g") + 1).alias("_g"), here.alias("_end"))
    within = Window.partitionBy("_g").orderBy("_i")
    rows = held.join(ends, "_g", "left").withColumn("_last", F.coalesce(F.lag(here).over(within), F.col("_end")))
    first = F.col("_last").isNull() | ~F.col("_last.u").eqNullSafe(F.col(user))
    last, now = F.col("_last.r"), F.col(rate).cast("double")
    move = F.when(last.isNull() | (now >= last * ratio), step).when(now * ratio < last, -step).otherwise(0)
    begin = F.lit(max(least, min(most, start + step)))
    steps = rows.select("_i", F.when(first, 0).otherwise(move).alias("a"), F.when(first, begin).otherwise(least).alias("lo"), F.when(first, begin).otherwise(most).alias("hi"))
    workers = walked(steps, "_i", chunk).select("_i", F.col("value").cast("int").alias("_workers"))
    return held.join(workers, "_i").select(user, order, rate, F.col("_workers").alias("workers"))
