"""Records that a processing run writes: manifest rows, request lines, metadata columns, job summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import custom_id, identity, media_type
from quillspark.operators import responses

#: Columns of a manifest record, with their types.
MANIFEST = {
    "image_name": "string", "image_reference": "string", "status": "string", "source": "string", "provider": "string", "model": "string", "attempts": "int",
    "failure_reason": "string", "generation_seconds": "double", "total_seconds": "double", "rows_written": "int", "duplicate_action": "string", "recorded_at": "string",
}


def manifest_records(df: DataFrame, **given: Column) -> DataFrame:
    """The manifest's columns: ``given`` ones, typed, null where nothing is given; further ones follow."""
    known = [given.get(c, F.lit(None)).cast(t).alias(c) for c, t in MANIFEST.items()]
    return df.select(*known, *[c.alias(n) for n, c in given.items() if n not in MANIFEST])


def request_lines(df: DataFrame, key: str, prompt: str, temperature: float = 0.0) -> DataFrame:
    """key, value: a request a row, as a JSON line with contents and generation settings."""
    file = F.struct(media_type(F.col(key)).alias("mimeType"), F.col(key).alias("fileUri"))
    parts = F.array(F.struct(F.lit(prompt).alias("text"), F.lit(None).cast(file_type()).alias("fileData")), F.struct(F.lit(None).cast("string").alias("text"), file.alias("fileData")))
    request = F.struct(F.array(F.struct(F.lit("user").alias("role"), parts.alias("parts"))).alias("contents"), F.struct(F.lit(temperature).alias("temperature")).alias("generationConfig"))
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(F.col(key).alias("key"), request.alias("request"))).alias("value"))


def file_type() -> str:
    return "struct<mimeType:string,fileUri:string>"


def manifest_lines(df: DataFrame, key: str) -> DataFrame:
    """key, mime_type, custom_id of each request."""
    return df.select(F.col(key).alias("key"), media_type(F.col(key)).alias("mime_type"), custom_id(F.col(key)).alias("custom_id"))


def response_columns(df: DataFrame, response: str, logprobs: bool = True) -> DataFrame:
    """``df`` with thoughts (null if empty) and, if asked, avg_logprobs of a VARIANT response."""
    out = df.withColumn("thoughts", responses.response_thoughts(F.col(response)))
    return out.withColumn("avg_logprobs", responses.mean_logprob(F.col(response))) if logprobs else out


def job_summary(jobs: DataFrame, job: str, status: str, succeeded: str, failed: str) -> DataFrame:
    """job, status, detail: retrieved states shown as one, and counts as text where they are known."""
    shown = F.when(F.col(status).startswith("retrieved_"), "retrieved").otherwise(F.col(status))
    counts = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.concat_ws(" ", F.col(c).cast("string"), F.lit(n))) for c, n in ((succeeded, "succeeded"), (failed, "failed"))]))
    return jobs.select(job, shown.alias("status"), F.array_join(counts, ", ").alias("detail"))


def recovery_errors(failures: DataFrame, key: str, reason: str) -> DataFrame:
    return failures.select(identity(F.col(key)).alias("image_name"), F.col(key).alias("key"), F.col(reason).alias("failure_reason")).orderBy("key")


def single_row(df: DataFrame) -> DataFrame:
    """``df``, which must have exactly one row: reading it fails otherwise. At most two rows are looked at."""
    n = df.limit(2).agg(F.count(F.lit(1)).alias("_n"))
    held = F.when(F.col("_n") == 1, True).otherwise(F.raise_error(F.concat(F.lit("expected one row, found "), F.when(F.col("_n") > 1, "more").otherwise("none"))).cast("boolean"))
    return n.where(held).join(df.limit(2), F.lit(True), "left").drop("_n")
