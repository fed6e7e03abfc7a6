"""What several corpus operators share: tables, cutting lineage, null-safe keys."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores added until no column of ``df`` is called like it, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of our own only where that is unset and all runs on this machine."""
    told = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not told and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return told or os.path.join(tempfile.gettempdir(), "checkpoints", "quillspark")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends here, and lost executors cost nothing."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def forget(df: DataFrame) -> None:
    """Deletes what ``written`` wrote; for tables of a loop that nothing reads any more."""
    if path := getattr(df, "_written", None):
        jvm = df.sparkSession._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def held_out(doc_id: Column) -> Column:
    """True for the rows that no classifier learns from: crc32 of the id as text, modulo 5, is 0 (a null id counts as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """doc_id, text and label of at most ``rows`` labelled texts outside the held-out fold: those whose ids hash lowest.

    At most ``rows`` ids are broadcast, and of rows that share an id each different text counts once. Null ids, labels other
    than 0 and 1, and ids labelled both ways are left out.
    """
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("_most"))
        .where("label = _most").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).drop("_most")
    )
    held = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id").withColumn("_hash", F.xxhash64("text"))
    # Repeated rows meet before the shuffle, so an id with a third of all rows is no hot group.
    each = held.groupBy("doc_id", "label", "_hash").agg(F.min("text").alias("text"))
    return each.orderBy(F.xxhash64("doc_id"), "doc_id", "_hash").limit(rows).select("doc_id", "text", "label")


#: Rows of which a task holds texts as Python values at once.
SLICE = 512


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``SLICE`` at most, without a copy: what is made of a batch is small then, however large
    the batches are that Spark sends."""
    for batch in batches:
        yield from (batch.slice(k, SLICE) for k in range(0, batch.num_rows, SLICE))


def mapped(df: DataFrame, of, schema: T.StructType) -> DataFrame:
    """``df.mapInArrow(of, schema)`` for columns of any names; the batches' columns are told by their places, and hold at most
    ``SLICE`` rows."""
    inside = [f"c{k}" for k in range(len(schema))]

    def renamed(batches):
        for batch in of(slices(batches)):
            yield pa.RecordBatch.from_arrays(batch.columns, names=inside)

    out = T.StructType([T.StructField(n, f.dataType) for n, f in zip(inside, schema.fields, strict=True)])
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))]).mapInArrow(renamed, out).toDF(*schema.names)


def scored(documents: DataFrame, name: str, model) -> DataFrame:
    """``documents`` with the double column ``name``: what ``model.score`` gives for each batch of whole texts.

    The model is broadcast; its size is bounded by the sample that it was fitted to. A column called ``name`` is replaced.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    kept = documents.drop(name)
    where = kept.columns.index("text")

    def of(batches):
        for batch in batches:
            scores = pa.array(sent.value.score(batch.column(where).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, name])

    return mapped(kept, of, T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())]))
