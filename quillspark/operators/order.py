"""Global order without a single task: indexes and even splits by ranges."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """``df`` checkpointed to the folder of spark.checkpoint.dir; one of our own only where that is unset and all runs on this machine."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        told = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not told and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(told or os.path.join(tempfile.gettempdir(), "checkpoints", "quillspark"))
    return df.checkpoint()


def with_index(df: DataFrame, *order: str, name: str = "index") -> DataFrame:
    """``df`` with each row's place from 0 in ``order`` (which should be total).

    Rows are dealt by ranges of ``order`` and numbered within them; the sizes of the ranges before, a row a partition, are
    added. The dealing is checkpointed, as another run could draw other ranges.
    """
    ranged = cut(df.repartitionByRange(*[F.col(c) for c in order]).withColumn("_part", F.spark_partition_id()))
    sizes = {r["_part"]: r["n"] for r in ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = [], 0
    for part in sorted(sizes):
        before.append((part, total))
        total += sizes[part]
    table = df.sparkSession.createDataFrame(before or [(0, 0)], "_part int, _before long")
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.withColumn("_at", within).join(F.broadcast(table), "_part").withColumn(name, F.col("_at") - 1 + F.col("_before")).drop("_part", "_at", "_before")


def even_chunks(df: DataFrame, chunks: int, *order: str) -> DataFrame:
    """``df`` with chunk (from 1) and chunks: contiguous runs in ``order``, the first ones longer by one where it doesn't divide."""
    held = with_index(df, *order, name="_i")
    total = held.agg(F.count(F.lit(1)).alias("_n"))
    n, k = F.col("_n"), F.greatest(F.least(F.lit(chunks).cast("long"), F.col("_n")), F.lit(1))
    small, more = F.floor(n / k), n % k
    edge = more * (small + 1)
    chunk = F.when(F.col("_i") < edge, F.floor(F.col("_i") / (small + 1))).otherwise(more + F.floor((F.col("_i") - edge) / small))
    return held.join(F.broadcast(total), F.lit(True)).withColumns({"chunk": (chunk + 1).cast("long"), "chunks": k}).drop("_i", "_n")
