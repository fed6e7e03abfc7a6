"""Coverage of expected against produced items: what is covered, missing or extra, and how gaps are filled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-null values of ``key``."""
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def keyed_status(expected: DataFrame, produced: DataFrame, key: str, produced_key: str | None = None) -> DataFrame:
    """key, status: every distinct key of either side as covered, missing or extra."""
    e = present(expected, key).select(F.col(key).alias("key"), F.lit(True).alias("e"))
    p = present(produced, produced_key or key).select(F.col(produced_key or key).alias("key"), F.lit(True).alias("p"))
    status = F.when(F.col("p").isNull(), "missing").when(F.col("e").isNull(), "extra").otherwise("covered")
    return e.join(p, "key", "full").select("key", status.alias("status"))


def coverage_report(expected: DataFrame, produced: DataFrame, key: str, produced_key: str | None = None) -> DataFrame:
    """One row: expected, covered, missing, extra (distinct keys) and ratio = covered / expected, null if none is expected.

    One full outer join of two distinct key sets; null keys do not count.
    """
    is_ = lambda s: F.count_if(F.col("status") == s)
    out = keyed_status(expected, produced, key, produced_key).agg(
        F.count_if(F.col("status") != "extra").alias("expected"), is_("covered").alias("covered"), is_("missing").alias("missing"), is_("extra").alias("extra")
    )
    return out.withColumn("ratio", F.round(F.try_divide(F.col("covered").cast("double"), F.col("expected")), 6))


def missing_keys(expected: DataFrame, produced: DataFrame, key: str, produced_key: str | None = None) -> DataFrame:
    """Distinct expected keys that were not produced."""
    other = present(produced, produced_key or key).select(F.col(produced_key or key).alias("_other"))
    return present(expected, key).join(other, F.col(key) == F.col("_other"), "left_anti")


def restrict(df: DataFrame, names: DataFrame | None, key: Column, name: str, none_keeps: bool = True) -> DataFrame:
    """Rows whose ``key`` is among ``names``; without names all rows or none, as ``none_keeps`` says."""
    if names is None:
        return df if none_keeps else df.limit(0)
    return df.join(names.select(F.col(name).alias("_name")).distinct(), key == F.col("_name"), "left_semi")


def continue_with(inputs: DataFrame, existing: DataFrame, key: Column, name: str) -> DataFrame:
    """Inputs that are not in the dataset yet; inputs without a key are new."""
    return inputs.join(existing.select(F.col(name).alias("_name")).distinct(), key == F.col("_name"), "left_anti")


def restriction_report(df: DataFrame, names: DataFrame, key: Column, name: str) -> DataFrame:
    """One row: requested, matched, missing (distinct names) and kept (rows)."""
    asked = present(names, name).select(F.col(name).alias("_name"))
    counted = df.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    both = asked.join(counted, F.col("_name") == F.col("_key"), "left")
    return both.agg(
        F.count(F.lit(1)).alias("requested"), F.count("_key").alias("matched"), F.count_if(F.col("_key").isNull()).alias("missing"), F.coalesce(F.sum("n"), F.lit(0)).alias("kept")
    )


def finalized(expected: DataFrame, dataset: DataFrame, reasons: DataFrame, key: str, dataset_key: str) -> DataFrame:
    """key, failed, failure_reason: the dataset's rows and a failed placeholder for every expected key without one.

    ``reasons`` has key and reason, a row a key; a key without a reason gets missing_successful_output.
    """
    rows = dataset.select(F.col(dataset_key).alias("key"), F.lit(False).alias("failed"), F.lit("").alias("failure_reason"))
    gaps = missing_keys(expected, dataset, key, dataset_key).select(F.col(key).alias("key"))
    named = gaps.join(reasons.select(F.col("key"), "reason"), "key", "left")
    return rows.unionByName(named.select("key", F.lit(True).alias("failed"), F.coalesce("reason", F.lit("missing_successful_output")).alias("failure_reason")))


def failed_keys(expected: DataFrame, successful: DataFrame, failures: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """key, reason: expected keys without success; if there is none, every failed key that does not start with ``<``.

    That fallback may name keys that succeeded later; ``strict`` leaves it out. ``successful`` has ``key``, ``failures`` key
    and reason (one a key). Reasons default to missing_success_output.
    """
    gaps = missing_keys(expected, successful, key).select(F.col(key).cast("string").alias("key"), F.lit(True).alias("gap"))
    held = failures.select(F.col("key").cast("string").alias("key"), "reason")
    out = gaps.join(held, "key", "full")
    if strict:
        return out.where("gap").select("key", F.coalesce("reason", F.lit("missing_success_output")).alias("reason"))
    gap_count = gaps.agg(F.count(F.lit(1)).alias("gaps"))  # one row
    out = out.join(F.broadcast(gap_count), F.lit(True))
    chosen = F.col("gap") | ((F.col("gaps") == 0) & ~F.col("key").startswith("<"))
    return out.where(chosen).select("key", F.coalesce("reason", F.when(F.col("gap"), "missing_success_output"), F.lit("unknown_failure")).alias("reason"))


def recovered(report: DataFrame, expected: DataFrame, dataset: DataFrame, extra: DataFrame, key: str) -> DataFrame:
    """The coverage report after ``extra`` rows fill gaps: only those of ``extra`` that were missing are appended."""
    gaps = missing_keys(expected, dataset, key)
    filled = dataset.select(key).unionByName(extra.select(key).join(gaps, key, "left_semi"))
    return coverage_report(expected, filled, key)


def resolved_once(local: DataFrame, cloud: DataFrame, name: str) -> DataFrame:
    """name, status, local_count, cloud_count: names on either side, and how often each side has them."""
    l, c = (d.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias(a)) for d, a in ((local, "local_count"), (cloud, "cloud_count")))
    both = l.join(c, name, "full")
    status = F.when(F.col("cloud_count").isNull(), "local_only").when(F.col("local_count").isNull(), "cloud_only").otherwise("both")
    return both.select(name, status.alias("status"), F.coalesce("local_count", F.lit(0)).alias("local_count"), F.coalesce("cloud_count", F.lit(0)).alias("cloud_count"))
