"""Batch jobs: chunk tables, states, progress and costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.text import chunk_label, failed_state, provider_of_batch, state, succeeded


def state_rollup(chunks: DataFrame, job: str, status: str) -> DataFrame:
    """job, n, state: failed or succeeded once all chunks have ended, else running; empty where a state could not be read."""
    s = F.col(status)
    done = succeeded(s) | failed_state(s)
    out = chunks.groupBy(job).agg(F.count(F.lit(1)).alias("n"), F.bool_and(done).alias("_all"), F.bool_or(failed_state(s)).alias("_failed"), F.bool_or(F.coalesce(s, F.lit("")).startswith("ERROR:")).alias("_error"))
    rolled = F.when(F.col("_error"), "").when(F.col("_all"), F.when(F.col("_failed"), "failed").otherwise("succeeded")).otherwise("running")
    return out.select(job, "n", rolled.alias("state"))


def state_counts(chunks: DataFrame, status: str) -> DataFrame:
    """state, n, finished: chunks by state."""
    return chunks.groupBy(state(F.col(status)).alias("state")).agg(F.count(F.lit(1)).alias("n"), F.bool_or(succeeded(F.col(status)) | failed_state(F.col(status))).alias("finished")).orderBy("state")


def request_total(jobs: DataFrame, chunks: DataFrame, job: str, count: str, retries: Column | None = None) -> DataFrame:
    """job, total: the job's own count, else the sum of its chunks' (without those ``retries`` picks), else null."""
    held = chunks if retries is None else chunks.where(~retries)
    summed = held.groupBy(job).agg(F.sum(count).alias("_sum"))
    return jobs.join(summed, job, "left").select(job, F.coalesce(F.col(count), "_sum").alias("total"))


def progress(df: DataFrame, ended: list[str], total: str) -> DataFrame:
    """``df`` with processed, ratio and line: the sum of the ended requests over the total, as ``10/20 (50.00%)``."""
    done = sum((F.coalesce(F.col(c), F.lit(0)) for c in ended), F.lit(0))
    ratio = F.when(F.col(total) > 0, done / F.col(total)).otherwise(0.0)
    return df.withColumns({"processed": done, "ratio": F.round(ratio, 6), "line": F.format_string("%d/%d (%.2f%%)", done.cast("long"), F.col(total).cast("long"), ratio * 100)})


def readiness(df: DataFrame, status: str, processed: str, total: str) -> DataFrame:
    """A success whose requests are not all processed yet is finalizing."""
    return df.withColumn("readiness", F.when(succeeded(F.col(status)) & (F.col(processed) < F.col(total)), "finalizing").otherwise(F.lower(state(F.col(status)))))


def linked_chunks(parent: DataFrame, child: DataFrame, job: str, name: str, index: str) -> DataFrame:
    """The parents' chunks and those chunks of their retries that they do not have by name, numbered on from the largest index."""
    new = child.join(parent.select(job, name), [job, name], "left_anti")
    most = parent.groupBy(job).agg(F.max(index).alias("_most"))
    place = F.row_number().over(Window.partitionBy(job).orderBy(index, name))
    moved = new.join(most, job, "left").withColumn(index, (F.coalesce("_most", F.lit(0)) + place).cast(parent.schema[index].dataType)).drop("_most")
    return parent.unionByName(moved, allowMissingColumns=True)


def replaced_chunks(chunks: DataFrame, rerun: DataFrame, job: str, index: str) -> DataFrame:
    """Entries of a rerun take the place of those with their index; others are appended."""
    return chunks.join(rerun.select(job, index), [job, index], "left_anti").unionByName(rerun)


def updated_status(chunks: DataFrame, status: DataFrame, name: str, column: str = "status") -> DataFrame:
    """``chunks`` with the new status by ``name``, where there is one, and ``changed``."""
    new = status.select(name, F.col(column).alias("_new"))
    out = chunks.join(new, name, "left")
    changed = F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col(column))
    return out.withColumn("changed", changed).withColumn(column, F.coalesce("_new", column)).drop("_new")


def newest_first(df: DataFrame, created: str, updated: str, key: str, limit: int | None = None) -> DataFrame:
    """Rows by their creation time, or their update where that is blank, newest first, ties by key."""
    when = F.coalesce(F.nullif(F.col(created).cast("string"), F.lit("")), F.col(updated).cast("string"))
    out = df.orderBy(when.desc(), F.col(key))
    return out.limit(max(1, limit)) if limit is not None else out


def cost_estimate(df: DataFrame, expected: str, rate: float) -> DataFrame:
    return df.withColumn("cost", F.col(expected) / 1000 * rate)


def retrieved_state(missing: Column) -> Column:
    return F.when(missing == 0, "retrieved_complete").otherwise("retrieved_partial")


def run_providers(runs: DataFrame, batches: DataFrame, run: str, provider: str, name: str, fallback: str | None = None) -> DataFrame:
    """run, provider, source, mixed: the provider of each run: its own, if known, else what all of its batches' names tell,
    else ``fallback``. ``mixed`` are two batch names that tell unlike things (or one that tells none), where that decided; of
    a run without record and batches it is empty.

    One aggregate over the batches, which keeps a witness of each provider; runs without batches have their own or the fallback.
    """
    told = provider_of_batch(F.col(name))
    per = batches.groupBy(run).agg(
        F.min(told).alias("_least"), F.max(told).alias("_most"), F.count_if(told.isNull()).alias("_odd"),
        F.min_by(name, told).alias("_a"), F.max_by(name, told).alias("_b"), F.min(F.when(told.isNull(), F.col(name))).alias("_c"),
    )
    own = F.lower(F.trim(F.col(provider)))
    own = F.when(own.isin("gemini", "anthropic"), own)
    agreed = F.coalesce((F.col("_least") == F.col("_most")) & (F.col("_odd") == 0), F.lit(False))
    held = runs.join(per, run, "left")
    clash = F.when(own.isNull() & ~agreed, F.array_compact(F.array("_a", F.when(F.col("_odd") > 0, F.col("_c")).otherwise(F.col("_b")))))
    source = F.when(own.isNotNull(), "record").when(agreed, "batches").when(F.lit(fallback).isNotNull(), "fallback")
    return held.select(run, F.coalesce(own, F.when(agreed, F.col("_least")), F.lit(fallback)).alias("provider"), source.alias("source"), clash.alias("mixed"))


def chunk_entries(chunks: DataFrame, job: str, index: str, **given: Column) -> DataFrame:
    """job, and the fields of a chunk's record: its index, the job's number of chunks, its label, and ``given`` ones."""
    totals = chunks.groupBy(job).agg(F.count(F.lit(1)).alias("total_chunks"))
    held = chunks.join(totals, job)
    return held.select(job, F.col(index).cast("long").alias("chunk_index"), "total_chunks", chunk_label(F.col(index), F.col("total_chunks")).alias("chunk_label"), *[c.alias(n) for n, c in given.items()])


def job_records(entries: DataFrame, job: str) -> DataFrame:
    """job, num_batches, request_count, request_bytes, batch_job_names: a job's record of its chunk entries, names in their order."""
    names = F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "batch_job_name"))), lambda c: c["batch_job_name"])
    return entries.groupBy(job).agg(F.count(F.lit(1)).alias("num_batches"), F.sum("request_count").alias("request_count"), F.sum("request_bytes").alias("request_bytes"), names.alias("batch_job_names"))


def tasks(log: DataFrame, key: str, updated: str, limit: int) -> DataFrame:
    """The last state of each task of a log of changes, created and started when it first was, newest first."""
    rest = [c for c in log.columns if c not in (key, updated, "created_at", "started_at")]
    first = lambda c: F.min_by(c, F.when(F.nullif(F.col(c), F.lit("")).isNotNull(), F.col(updated))).alias(c)
    now = log.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.max_by(c, updated).alias(c) for c in rest], first("created_at"), first("started_at"), F.max(updated).alias(updated))
    return now.orderBy(F.desc(updated), key).limit(max(1, limit))
