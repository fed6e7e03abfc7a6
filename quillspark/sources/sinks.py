"""Writers of datasets, manifests and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators.nested import flattened
from quillspark.sources.tables import exists


def append_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object a row, appended to the dataset folder; nulls are written."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("append").text(path)


def append_delimited(df: DataFrame, spark: SparkSession, path: str, delimiter: str = "$") -> None:
    """Nested columns flattened with dots, appended in the column order of what is there: others dropped, absent ones empty."""
    flat = flattened(df)
    there = spark.read.csv(path, header=True, sep=delimiter).columns if exists(spark, path) else flat.columns
    aligned = flat.select(*[F.col(f"`{c}`") if c in flat.columns else F.lit(None).cast("string").alias(c) for c in there])
    aligned.write.mode("append").csv(path, header=True, sep=delimiter)


def swapped(df: DataFrame, path: str, kind: str) -> None:
    """The dataset at ``path`` replaced by ``df``: written beside it first, then both are renamed, then the old one goes.

    A failed write leaves the old dataset as it was; between the two renames, which only rename folders, none is there. The
    old data may be read by ``df``.
    """
    spark, tag = df.sparkSession, uuid.uuid4().hex
    df.write.format(kind).save(f"{path}.new-{tag}")
    at = lambda name: spark._jvm.org.apache.hadoop.fs.Path(name)
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    old = fs.exists(at(path))
    if old and not fs.rename(at(path), at(f"{path}.old-{tag}")):
        raise OSError(f"{path} could not be renamed")
    if not fs.rename(at(f"{path}.new-{tag}"), at(path)):
        raise OSError(f"{path}.new-{tag} could not be renamed")
    if old:
        fs.delete(at(f"{path}.old-{tag}"), True)


def rewrite(df: DataFrame, path: str) -> None:
    """The JSON dataset replaced."""
    swapped(df, path, "json")


def versioned_copy(df: DataFrame, root: str, version: int, operation: str) -> str:
    """current and versions/vNNN_<operation> below ``root``; gives the version's path."""
    path = f"{root}/versions/v{version:03d}_{operation}"
    df.write.mode("errorifexists").parquet(path)
    swapped(df.sparkSession.read.parquet(path), f"{root}/current", "parquet")
    return path


def one_json(df: DataFrame, path: str) -> None:
    """Each row of a small report as one JSON line of one file, replaced as a whole."""
    swapped(df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).coalesce(1), path, "text")


def summary(summarised: DataFrame, manifest_path: str, path: str, generated_at: Column | None = None) -> None:
    """A processing summary with the manifest that it was read from and the time of writing."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssxxx") if generated_at is None else generated_at
    one_json(summarised.withColumns({"manifest_path": F.lit(manifest_path), "generated_at": now}), path)


def report_csv(df: DataFrame, path: str, preferred: list[str]) -> None:
    """Records as CSV: the preferred columns that there are, in that order, then the others by name."""
    first = [c for c in preferred if c in df.columns]
    df.select(*first, *sorted(set(df.columns) - set(first))).write.mode("overwrite").csv(path, header=True)


def duplicate_report(audit: DataFrame, root: str, key: str = "name") -> None:
    """An audit of skipped inputs as JSONL and CSV, and a manifest row ``duplicate_skipped`` for each."""
    append_json_lines(audit, f"{root}/duplicates_jsonl")
    audit.write.mode("append").csv(f"{root}/duplicates_csv", header=True)
    append_json_lines(audit.select(F.col(key).alias("image_name"), F.lit("duplicate_skipped").alias("status"), F.lit(0).alias("rows_written")), f"{root}/manifest")


def decisions(df: DataFrame, path: str, columns: list[str]) -> None:
    """Validation decisions as CSV with exactly ``columns``, in their order; absent ones are empty."""
    df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]).write.mode("overwrite").csv(path, header=True)


def decisions_metadata(made: DataFrame, path: str, **facts: str) -> None:
    """The sidecar of decisions: the facts given, and how many were made."""
    one_json(made.agg(F.count(F.lit(1)).alias("decision_count")).withColumns({k: F.lit(v) for k, v in facts.items()}), path)


def append_event(events: DataFrame, path: str) -> None:
    """job_id, event_type and payload appended to an event table; payloads are JSON text."""
    payload = F.col("payload") if dict(events.dtypes)["payload"] == "string" else F.to_json("payload")
    events.withColumn("payload", payload).write.mode("append").parquet(path)


def collect_run(selected: DataFrame, rejected: DataFrame, missing: DataFrame, report: DataFrame, root: str) -> None:
    """The four results of a collection, each sorted by key."""
    for name, df in (("selected_outputs", selected), ("rejected_output_keys", rejected), ("missing_page_keys", missing)):
        df.orderBy("key").write.mode("overwrite").json(f"{root}/{name}")
    report.write.mode("overwrite").json(f"{root}/coverage_report")
