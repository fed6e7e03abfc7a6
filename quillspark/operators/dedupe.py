"""Duplicates resolved by explicit order columns, with ledgers of what was done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators.order import with_index
from quillspark.operators.skew import lookup


def first_successful(df: DataFrame, key: str, failed: Column, seq: str) -> DataFrame:
    """One row a key: the first that did not fail, else the first; ``position`` is the order of the key's first row.

    So a later success takes the place of a failed row. Rows with a null key all stay, at their own place. The winner comes
    from an aggregate (it combines before the shuffle), so a key with a third of the rows makes no hot task.
    """
    rows = df.withColumn("_failed", failed)
    keyed = rows.where(F.col(key).isNotNull())
    whole = F.struct(*[F.col(c) for c in df.columns])
    won = keyed.groupBy(F.col(key).alias("_key")).agg(F.min_by(whole, F.struct("_failed", seq)).alias("_row"), F.min(seq).alias("position"))
    alone = rows.where(F.col(key).isNull()).select(*df.columns, F.col(seq).alias("position"))
    return won.select("_row.*", "position").unionByName(alone)


def ledger(df: DataFrame, key: str, failed: Column, seq: str, keep_all: bool = False) -> DataFrame:
    """``df`` with ``action`` and ``kept_seq``: what happened to each row, and the row that was kept before it came.

    kept: a key's first row; replaced_failed_duplicate: the first success after only failures; skipped_duplicate: any other;
    with ``keep_all`` every later row is included_duplicate. Rows without a key are kept.
    """
    alone = df.where(F.col(key).isNull()).withColumns({"action": F.lit("kept"), "kept_seq": F.lit(None).cast(df.schema[seq].dataType)})
    rows = df.where(F.col(key).isNotNull()).withColumn("_failed", failed)
    # What came before a row follows from its key's first row and first success, so no key's rows are gathered.
    firsts = rows.groupBy(key).agg(F.min(seq).alias("_first"), F.min(F.when(~F.col("_failed"), F.col(seq))).alias("_ok"), F.count(F.lit(1)).alias("_n"))
    first, ok = (F.when(F.col(c) < F.col(seq), F.col(c)) for c in ("_first", "_ok"))
    later = F.when(F.lit(keep_all), "included_duplicate").when(ok.isNull() & ~F.col("_failed"), "replaced_failed_duplicate").otherwise("skipped_duplicate")
    out = lookup(rows, firsts, [key], size="_n").withColumns({"action": F.when(first.isNotNull(), later).otherwise("kept"), "kept_seq": first if keep_all else F.coalesce(ok, first)})
    return out.select(*alone.columns).unionByName(alone)


def combine_counts(df: DataFrame, key: str, failed: Column, seq: str) -> DataFrame:
    """One row: rows, keys, duplicates and replaced, as the first-successful policy counts them (a replacement is a duplicate too)."""
    per = df.withColumn("_failed", failed).where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min_by("_failed", seq).alias("first_failed"), F.bool_or(~F.col("_failed")).alias("any_ok"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"), F.count_if(F.col("first_failed") & F.col("any_ok")).alias("replaced")
    )


def first_valid(df: DataFrame, key: str, valid: Column, seq: str) -> DataFrame:
    """The earliest valid row of each key; invalid rows never stand in the way."""
    return df.where(valid & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*[F.col(c) for c in df.columns]), seq).alias("_row")).select("_row.*")


def duplicate_audit(df: DataFrame, key: str, order: str) -> DataFrame:
    """Every row after the first of its key, with the kept row's place: kept_index and skipped_index, from 1, in ``order``.

    Keys that are null are no duplicates.
    """
    placed = with_index(df.select(key, order), order, key).withColumn("index", F.col("index") + 1)
    kept = placed.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("index").alias("kept_index"), F.count(F.lit(1)).alias("_n"))
    return lookup(placed.where(F.col(key).isNotNull()), kept, [key], size="_n").where("index > kept_index").select(key, order, "kept_index", F.col("index").alias("skipped_index"))


def first_reason(df: DataFrame, key: str, reason: str, seq: str) -> DataFrame:
    """key, reason: the first reason of each key."""
    return df.where(F.col(key).isNotNull() & F.col(reason).isNotNull()).groupBy(key).agg(F.min_by(reason, seq).alias("reason"))


def last_reason(df: DataFrame, key: str, reason: str, seq: str) -> DataFrame:
    """key, reason: the last reason of each key."""
    return df.where(F.col(key).isNotNull() & F.col(reason).isNotNull()).groupBy(key).agg(F.max_by(reason, seq).alias("reason"))


def prefer_source(df: DataFrame, keys: list[str], source: str, preferred: str, seq: str) -> DataFrame:
    """One row for each combination of ``keys``: the first of the preferred source, else the last of any.

    ``position`` is the place of the key's first row. Null parts of a key equal each other.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    best = F.col(source) == preferred
    won = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.min_by(row, F.when(best, F.col(seq))).alias("_a"), F.max_by(row, F.col(seq)).alias("_b"), F.bool_or(F.coalesce(best, F.lit(False))).alias("_any"), F.min(seq).alias("position")
    )
    return won.select(F.when(F.col("_any"), F.col("_a")).otherwise(F.col("_b")).alias("_row"), "position").select("_row.*", "position")


def upsert(current: DataFrame, changes: DataFrame, key: str, seq: str, keep: list[str] | None = None) -> DataFrame:
    """The table after the changes: a key's row of largest ``seq`` wins, and the columns in ``keep`` stay as first set.

    A row of either table may come first or last; nulls in a kept column never overwrite a value.
    """
    both = current.unionByName(changes, allowMissingColumns=True)
    first = {c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(seq))) for c in keep or []}
    rest = [c for c in both.columns if c != key]
    return both.groupBy(key).agg(*[first[c].alias(c) if c in first else F.max_by(c, seq).alias(c) for c in rest])
