"""Choosing what to validate next, and exact samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ucb_scores(state: DataFrame, blend: float = 0.5, weight: float = 0.25) -> DataFrame:
    """``state`` (field, size, selected, scored) with quota, deficit, uncertainty and score of each field.

    The quota blends an even share with the share of items; the deficit is what selection so far lacks of it; the rest is
    an upper confidence bound. Exhausted fields count too.
    """
    one = state.agg(F.count(F.lit(1)).alias("_g"), F.sum("size").alias("_n"), F.sum("selected").alias("_t"))
    t = F.col("_t").cast("double")
    held = state.join(F.broadcast(one), F.lit(True))
    quota = (1 - blend) / F.col("_g") + blend * F.try_divide(F.col("size").cast("double"), F.col("_n"))
    deficit = quota - F.col("selected") / F.greatest(t, F.lit(1.0))
    unsure = F.sqrt(2 * F.log(F.greatest(t, F.lit(2.0))) / (F.col("scored") + 1))
    return held.withColumns({"quota": quota, "deficit": deficit, "uncertainty": unsure, "score": deficit + weight * unsure}).drop("_g", "_n", "_t")


def exact_sample(df: DataFrame, key: Column, fraction: float, seed: int = 7) -> DataFrame:
    """Exactly max(1, min(n, round(n * fraction))) rows, drawn by a seeded hash of ``key``; halves round to even.

    Rows are counted by the hash's first 16 bits: ranges below the last one are taken whole, and only of that the smallest
    hashes are sought.
    """
    hashed = F.xxhash64(F.lit(seed), key)
    first = F.shiftright(hashed, 48)
    counts = sorted((r["part"], r["n"]) for r in df.groupBy(first.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    n = sum(c for _, c in counts)
    left = max(1, min(n, round(n * fraction)))
    for part, here in counts:
        if here >= left:
            return df.where(first < part).union(df.where(first == part).orderBy(hashed, key).limit(left))
        left -= here
    return df


def random_pick(pairs: DataFrame, done: DataFrame, keys: list[str], seed: int = 7) -> DataFrame:
    """One row of ``pairs`` not in ``done``, each as likely: that of the least seeded hash of its keys; none if none is left."""
    drawn = F.md5(F.concat_ws("|", F.lit(str(seed)), *keys).cast("binary"))
    return unvalidated(pairs, done, keys).orderBy(drawn, *keys).limit(1)


def unvalidated(pairs: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return pairs.join(done.select(*keys).distinct(), keys, "left_anti")
