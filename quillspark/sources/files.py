"""Lenient and strict readers of line-based datasets, and listings of files."""

from __future__ import annotations

import codecs
import csv
import io
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.functions.text import IDENTITY_COLUMNS, row_identity
from quillspark.sources.tables import exists


def json_lines(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """file, value (VARIANT): the objects of a JSONL dataset; blank, malformed and non-object lines are skipped."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("value"))
    kept = lines.where(F.col("value").isNotNull() & F.schema_of_variant("value").startswith("OBJECT"))
    return kept.limit(limit) if limit is not None else kept


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line, value: every line of text files with its number in its file, from 1.

    Lines are numbered within the blocks that a file is read in, and the sizes of the blocks before are added.
    """
    read = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_at"), "value")
    blocks = read.groupBy("file", "block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.withColumn("_before", before).drop("_n")
    return read.join(blocks, ["file", "block"]).select("file", (F.col("_at") - F.col("_first") + F.col("_before") + 1).alias("line"), "value")


def json_lines_strict(spark: SparkSession, path: str) -> DataFrame:
    """The same, but a malformed or non-object line raises when it is read, naming its file and number."""
    lines = numbered_lines(spark, path).where(F.trim("value") != "")
    v = F.try_parse_json("value")
    good = v.isNotNull() & F.schema_of_variant(v).startswith("OBJECT")
    return lines.select("file", F.when(good, v).otherwise(F.raise_error(F.concat(F.lit("no JSON object in line "), F.col("line").cast("string"), F.lit(" of "), F.col("file")))).alias("value"))


def preview(spark: SparkSession, path: str, limit: int, kind: str = "jsonl") -> DataFrame:
    """The first ``limit`` rows: of JSONL the objects (file, line, value) among the first ``limit`` physical lines; of CSV comma-separated records."""
    if kind == "csv":
        return spark.read.csv(path, header=True, inferSchema=False).limit(limit)
    lines = numbered_lines(spark, path).where(F.col("line") <= limit).withColumn("value", F.try_parse_json("value"))
    return lines.where(F.col("value").isNotNull() & F.schema_of_variant("value").startswith("OBJECT"))


def processing_records(spark: SparkSession, path: str) -> DataFrame:
    """file, value: the objects of one manifest; none where there is no such file."""
    if not exists(spark, path):
        return spark.createDataFrame([], "file string").select("file", F.try_parse_json("file").alias("value"))
    return json_lines(spark, path)


def image_coverage(spark: SparkSession, path: str) -> DataFrame:
    """One row: row_count (non-blank lines, malformed ones too) and names (distinct identities) of a JSONL dataset, from one
    scan: a row a name and one for what has none meet, and are counted."""
    value = F.try_parse_json("value")
    named = row_identity(*[F.try_variant_get("v", f"$.{c}", "string") for c in IDENTITY_COLUMNS])
    lines = spark.read.text(path).where(F.trim("value") != "").select(value.alias("v")).select(named.alias("name"))
    per = lines.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count("name").alias("names"))


def manifests(spark: SparkSession, root: str, name: str = "image_processing_manifest.jsonl") -> DataFrame:
    """manifest_path, value: the objects of all manifests below a folder; none where it has none."""
    read = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).format("text").schema("value string")
    held = read.load(root).select(F.col("_metadata.file_path").alias("manifest_path"), F.try_parse_json("value").alias("value"))
    return held.where(F.col("value").isNotNull() & F.schema_of_variant("value").startswith("OBJECT"))


def batch_manifest(spark: SparkSession, path: str) -> DataFrame:
    """key, custom_id, mime_type of a strict manifest: a line without a key, or with an odd custom_id, raises."""
    rows = json_lines_strict(spark, path)
    got = lambda name: F.trim(F.try_variant_get("value", f"$.{name}", "string"))
    said = lambda ok, c, what: F.when(ok, c).otherwise(F.raise_error(F.concat(F.lit(f"{what} in "), F.to_json("value"))).cast("string"))
    key, custom = got("key"), got("custom_id")
    return rows.select(
        said(F.coalesce(key != "", F.lit(False)), key, "no key").alias("key"), said(F.coalesce(custom.rlike("^[A-Za-z0-9_-]{1,64}$"), F.lit(False)), custom, "no valid custom_id").alias("custom_id"),
        F.coalesce(F.nullif(got("mime_type"), F.lit("")), F.lit("application/octet-stream")).alias("mime_type"),
    )


def requests_size(spark: SparkSession, path: str) -> DataFrame:
    """One row: requests (lines that are not blank) and bytes of request files."""
    files = spark.read.format("binaryFile").load(path).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    return spark.read.text(path).where(F.trim("value") != "").agg(F.count(F.lit(1)).alias("requests")).join(files)


def prediction_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line, value: every non-blank line as text, with its number in the file; malformed ones stay, to be reported."""
    return numbered_lines(spark, path).where(F.trim("value") != "")


def delimited(spark: SparkSession, path: str, delimiter: str = "$") -> DataFrame:
    """A delimited dataset with a header, every value a string; empty cells are empty strings."""
    return spark.read.csv(path, header=True, sep=delimiter, inferSchema=False, nullValue=None, emptyValue="", quote='"', escape='"', multiLine=True)


def _records(body: pa.Buffer) -> Iterator[dict]:
    """The records of a comma-separated file, read as they are asked for; bytes that are no UTF-8 raise before the first."""
    decoder, view = codecs.getincrementaldecoder("utf-8-sig")(), memoryview(body)
    try:
        for at in range(0, len(view), 1 << 20):
            decoder.decode(view[at : at + (1 << 20)])
        decoder.decode(b"", True)
    except UnicodeDecodeError:
        body.to_pybytes().decode("utf-8-sig")  # tells the place in the file
    yield from csv.DictReader(io.TextIOWrapper(pa.BufferReader(body), "utf-8-sig", newline=""))


CELLS = "path string, modified timestamp, place long, cells map<string,string>, error string"


def headed_files(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """path, modified, place, cells, error: the records of all comma-separated files below a folder, each by its own header.

    ``cells`` maps a file's column names, in its order, to texts; cells beyond the header are dropped, missing ones null.
    ``place`` counts a file's records from 1. A file that cannot be read or decoded gives one row with its error and no
    cells, after the records before it, and does not disturb the others. Quoted cells may hold line ends, so a file is read by
    one task; files are at most 2 GB. Without files, or without the folder, there are no rows.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], CELLS)

    kinds = [pa.string(), pa.timestamp("us", "UTC"), pa.int64(), pa.map_(pa.string(), pa.string()), pa.string()]

    def rows(name: str, when, body: pa.Buffer) -> Iterator[tuple]:
        try:
            for place, cells in enumerate(_records(body), 1):
                yield name, when, place, [(k, v) for k, v in cells.items() if k is not None], None
        except (ValueError, csv.Error) as e:
            yield name, when, None, None, f"{type(e).__name__}: {e}"

    def of(batches):
        for batch in batches:
            # The contents stay in the batch, and a file's records are Python values 5,000 at a time.
            for name, when, body in zip(*batch.columns, strict=True):
                read = rows(name.as_py(), when.as_py(), body.as_buffer())
                while some := list(islice(read, 5_000)):
                    columns = zip(*some, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["path", "modified", "place", "cells", "error"])

    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return read.select("path", "modificationTime", "content").mapInArrow(of, CELLS)


def headings(rows: DataFrame) -> list[str]:
    """The names of all columns of ``headed_files``, in the order in which the files, by path, first have them."""
    names = rows.select("path", F.posexplode(F.map_keys("cells")).alias("at", "name")).groupBy("name").agg(F.min(F.struct("path", "at")).alias("first"))
    return [r["name"] for r in names.orderBy("first").collect()]  # a row a column


def validations(spark: SparkSession, path: str, glob: str = "*_validations.csv") -> DataFrame:
    """Decisions of all validation files below a folder: the union of their columns, as texts, then _validation_path, _run,
    _mtime (seconds) and _place. Files that cannot be read are left out; a column that a file lacks is null there."""
    rows = headed_files(spark, path, glob).where("error IS NULL")
    run = F.element_at(F.split("path", "/"), -2)
    meta = [F.col("path").alias("_validation_path"), run.alias("_validation_run"), F.unix_micros("modified").cast("double") / 1e6, F.col("place").alias("_validation_place")]
    meta[2] = meta[2].cast("string").alias("_validation_mtime")
    return rows.select(*[F.col("cells")[n].alias(n) for n in headings(rows)], *meta)


def report_validations(spark: SparkSession, path: str, glob: str = "*_validations.csv") -> DataFrame:
    """The same for reports: labels in lower case, blank ones ``nan``. No files, or none with column_name, raise."""
    rows = validations(spark, path, glob)
    if "column_name" not in rows.columns:
        raise ValueError(f"no validations with a column_name below {path}")
    label = F.col("label") if "label" in rows.columns else F.lit(None).cast("string")
    return rows.withColumn("label", F.lower(F.coalesce(F.nullif(label, F.lit("")), F.lit("nan"))))


def united(sources: dict[str, DataFrame]) -> DataFrame:
    """The sources' rows with _source (a name) and _order (its place): all columns by name, in first-seen order, null where a
    source lacks one. Columns of one name should be of one type."""
    out = None
    for order, (name, df) in enumerate(sources.items()):
        held = df.withColumns({"_source": F.lit(name), "_order": F.lit(order)})
        out = held if out is None else out.unionByName(held, allowMissingColumns=True)
    rest = [c for c in out.columns if c not in ("_source", "_order")]
    return out.select(*rest, "_source", "_order")


def request_keys(lines: DataFrame, value: str = "value") -> DataFrame:
    """Distinct trimmed keys of request lines; malformed lines are skipped."""
    key = F.trim(F.try_variant_get(F.try_parse_json(value), "$.key", "string"))
    return lines.select(key.alias("key")).where("key IS NOT NULL AND key != ''").distinct()


def listing(spark: SparkSession, path: str, extensions: list[str] | None = None, glob: str | None = None) -> DataFrame:
    """path, length, modified: files below a folder; hidden AppleDouble files are left out."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = (read.option("pathGlobFilter", glob) if glob else read).load(path).select("path", "length", F.col("modificationTime").alias("modified"))
    name = F.element_at(F.split("path", "/"), -1)
    files = files.where(~name.startswith("._"))
    return files.where(F.lower(F.regexp_extract(name, r"(\.[A-Za-z0-9]+)$", 1)).isin(extensions)) if extensions else files


def year_lookup(spark: SparkSession, path: str, delimiter: str = ";") -> DataFrame:
    """sbid, year: a delimited mapping by header, in any case; rows without two integers are dropped, the last row of an sbid wins."""
    raw = spark.read.csv(path, header=True, sep=delimiter, inferSchema=False)
    names = {c.strip().lower().lstrip("﻿"): c for c in raw.columns}
    order = F.monotonically_increasing_id()
    held = raw.select(F.expr(f"try_cast(trim(`{names['sbid']}`) AS BIGINT)").alias("sbid"), F.expr(f"try_cast(trim(`{names['year']}`) AS INT)").alias("year"), order.alias("_o"))
    return held.where("sbid IS NOT NULL AND year IS NOT NULL").groupBy("sbid").agg(F.max_by("year", "_o").alias("year"))


def row_count(spark: SparkSession, path: str, kind: str) -> int:
    """Rows of a dataset file: non-blank lines of JSONL (malformed ones too), records of CSV without the header; else 0."""
    if kind == "jsonl":
        return spark.read.text(path).where(F.trim("value") != "").count()
    return delimited(spark, path).count() if kind == "csv" else 0
