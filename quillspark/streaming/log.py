"""Structured Streaming forms of growing logs: running counters, continuation, first-seen keys, windowed counts."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.sources.tables import exists


def event_stream(spark: SparkSession, folder: str, schema, name: str, per_trigger: int | None = None) -> DataFrame:
    """A Parquet table of a folder as a stream of files; ``name`` is the table's file or folder.

    A batch takes all files that are there, or ``per_trigger`` of them.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"*{name}*")
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).parquet(folder)


def running_counts(stream: DataFrame, column: str) -> DataFrame:
    """column, n: counts that grow with the log; written in complete mode."""
    return stream.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def windowed_counts(stream: DataFrame, time: str, column: str, window: str = "1 day", late: str = "1 day") -> DataFrame:
    """Counts by window and value; state older than ``late`` is dropped. Event time must be a timestamp with time zone."""
    held = stream.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    return held.groupBy(F.window("_t", window), column).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), column, "n")


def first_seen(stream: DataFrame, key: str, time: str, late: str = "1 day") -> DataFrame:
    """Rows whose key has not come within the watermark: continuation of a log without its repeats."""
    return stream.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late).dropDuplicatesWithinWatermark([key]).drop("_t")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of our own only where that is unset and all runs on this machine."""
    told = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not told and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return told or os.path.join(tempfile.gettempdir(), "checkpoints", "quillspark")


def drained(df: DataFrame, spark: SparkSession, name: str, mode: str = "complete", keys: list[str] | None = None) -> DataFrame:
    """What is there now, through the stream's operators, as a Parquet table in the folder of spark.checkpoint.dir.

    Executors write the batches, each to a folder of its own number, so a batch that runs again replaces itself; the stream's
    checkpoint stands beside them, and nothing passes through the driver. With ``keys`` (those of an aggregate) only what a
    batch changed is written, in update mode, and reading takes the last row of each key. Else in append mode all batches are
    the result, and in complete mode the last one is. Without input the table is empty.
    """
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    mode = "update" if keys else mode
    last = []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/table/_batch={number}")
        last[:] = [number]

    query = df.writeStream.foreachBatch(write).queryName(name).outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    if not last:
        spark.createDataFrame([], df.schema).write.parquet(f"{path}/table/_batch=0")
    if mode == "complete":
        return spark.read.schema(df.schema).parquet(f"{path}/table/_batch={last[0] if last else 0}")
    out = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_batch", T.LongType())]) if keys else df.schema).parquet(f"{path}/table")
    if not keys:
        return out.select(*df.columns)
    rest = [c for c in df.columns if c not in keys]
    return out.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_row")).select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def append_new(batch: DataFrame, path: str, batch_id: str, key: str, order: str, buckets: int = 64) -> DataFrame:
    """Appends to the dataset at ``path`` the rows of ``batch`` whose key it has not: of each key the first in ``order``.

    A ledger, hidden beside the data, holds the keys, in folders by bucket of their hash and by batch. Only the buckets that the batch
    touches are read, and never what the batch itself wrote: run again, after a failure at any point, it writes the same rows
    in the same place. Rows without a key are left out. Returns the keys that it took for known ones.
    """
    spark = batch.sparkSession
    rows = batch.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*batch.columns), order).alias("_row")).select("_row.*").withColumn("_bucket", _bucket(key, buckets))
    touched = [r["_bucket"] for r in rows.select("_bucket").distinct().collect()]  # at most ``buckets``
    ledger = T.StructType().add(batch.schema[key]).add("_bucket", T.IntegerType()).add("_batch", T.StringType())
    if exists(spark, f"{path}/_keys"):
        known = spark.read.schema(ledger).parquet(f"{path}/_keys").where(F.col("_bucket").isin(touched) & (F.col("_batch") != batch_id)).select(key, "_bucket")
    else:
        known = spark.createDataFrame([], ledger).select(key, "_bucket")
    new = rows.join(known, [key, "_bucket"], "left_anti")
    new.drop("_bucket").select(*batch.columns).write.mode("overwrite").parquet(f"{path}/_batch={batch_id}")
    # The ledger follows the data: a batch that fails between them leaves keys out, and is run again.
    written = spark.read.schema(batch.schema).parquet(f"{path}/_batch={batch_id}")
    keys = written.select(key, _bucket(key, buckets).alias("_bucket"), F.lit(batch_id).alias("_batch")).repartition("_bucket")
    keys.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket", "_batch").parquet(f"{path}/_keys")
    return known


def append_batches(stream: DataFrame, path: str, checkpoint: str, seen: str, order: str | None = None, buckets: int = 64):
    """Micro-batches appended to a dataset (``appended`` reads it), without the keys (column ``seen``) that it has already.

    Batches are told apart by their checkpoint and number, so that several streams, or one started anew, may follow each other.
    """
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def write(batch: DataFrame, number: int) -> None:
        append_new(batch, path, f"{run}-{number}", seen, order or seen, buckets)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The dataset that ``append_batches`` wrote, with ``_batch``: which batch a row came with."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("_batch", T.StringType())])).parquet(path)


def field_state(decisions: DataFrame, field: str, score: str) -> DataFrame:
    """field, selected, scored, score_sum: what a sampler knows of each field, growing with every decision; complete mode."""
    return decisions.groupBy(F.col(field).alias("field")).agg(F.count(F.lit(1)).alias("selected"), F.count(score).alias("scored"), F.coalesce(F.sum(score), F.lit(0.0)).alias("score_sum"))


def status_changes(stream: DataFrame, key: str, status: str, time: str) -> DataFrame:
    """key, status, since: the latest status of each job; in update mode only jobs with news come out of a batch."""
    return stream.groupBy(key).agg(F.max_by(status, time).alias(status), F.max(time).alias("since"))
