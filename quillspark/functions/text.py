"""Column functions over reference strings, names, states and messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Columns that may identify a row, in order of preference.
IDENTITY_COLUMNS = ["image_name", "file_name", "source_path", "gcs_object", "gcs_uri", "relative_path", "blob_name"]
#: What marks a message as a passing failure of a service.
TRANSIENT_MARKERS = ["503", "unavailable", "resource_exhausted", "rate limit", "429", "internal", "deadline", "timed out", "timeout", "connection reset", "connection error", "temporarily", "backend error"]
#: What marks a message as a failure that no retry mends.
FATAL_MARKERS = ["token limit", "quota", "permission", "unauthorized", "forbidden", "invalid api key", "invalid_api_key", "billing"]
#: What models' names begin with, by provider.
MODEL_STARTS = {
    "gemini": ["gemini-", "models/gemini-", "publishers/google/models/gemini-"],
    "anthropic": ["claude-", "anthropic/claude-"],
    "openai": ["openai/", "models/gpt-", "gpt-", "o1", "o3", "o4", "o5"],
}
#: States of batch jobs that ended well, and that failed.
SUCCESS_STATES = ["JOB_STATE_SUCCEEDED", "SUCCEEDED", "ENDED"]
FAILURE_STATES = ["JOB_STATE_FAILED", "FAILED", "ERRORED", "JOB_STATE_PARTIALLY_SUCCEEDED", "PARTIALLY_SUCCEEDED", "JOB_STATE_CANCELLED", "JOB_STATE_CANCELED", "CANCELLED", "CANCELED", "EXPIRED", "JOB_STATE_EXPIRED"]


#: What counts as white space at the ends of a text: the code points of class White_Space and the four separators.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def stripped(c: Column) -> Column:
    """A text without any white space at its ends, not blanks alone."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def identity(ref: Column) -> Column:
    """Base name of a path or object URI; null for null, blank and ``.``. A URI of a bucket alone gives the bucket."""
    path = F.regexp_replace(F.trim(ref.cast("string")), "/+$", "")
    name = F.regexp_extract(path, "[^/]*$", 0)
    return F.when(~name.isin("", "."), name)


def row_identity(*refs: Column) -> Column:
    """First identity among several references."""
    return F.coalesce(*map(identity, refs))


def upgraded_identity(image_name: Column, *others: Column) -> Column:
    """image_name as it is unless null or empty, else the first identity of the others."""
    return F.coalesce(F.nullif(image_name, F.lit("")), row_identity(*others))


def identity_pair(ref: Column) -> Column:
    """Struct of image_name and file_name (the trimmed reference); a blank reference, or one without a name, raises."""
    name = identity(ref)
    return F.struct(F.when(name.isNotNull(), name).otherwise(F.raise_error(F.concat(F.lit("no identity in reference: "), F.coalesce(ref, F.lit("<null>")))).cast("string")).alias("image_name"), F.trim(ref).alias("file_name"))


def object_key(ref: Column, bucket: str) -> Column:
    """Object of ``gs://bucket/object`` in this bucket, or a plain key without leading slashes; null if empty or elsewhere."""
    uri = F.regexp_extract(F.trim(ref), r"^gs://([^/]*)/?(.*)$", 1)
    key = F.when(F.trim(ref).startswith("gs://"), F.when(uri == bucket, F.regexp_extract(F.trim(ref), r"^gs://([^/]*)/?(.*)$", 2))).otherwise(F.trim(ref))
    return F.nullif(F.regexp_replace(key, "^/+", ""), F.lit(""))


def bucket_of(uri: Column) -> Column:
    return F.nullif(F.regexp_extract(uri, r"^gs://([^/]+)", 1), F.lit(""))


def field_name(c: Column) -> Column:
    """Trimmed, lower case, runs of blanks, dashes and underscores as one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"[\s_-]+", "_"), "^_+|_+$", "")


def leaf(path: Column) -> Column:
    """What follows the last dot."""
    return F.regexp_extract(path, r"[^.]*$", 0)


def top_level(path: Column) -> Column:
    return F.regexp_extract(path, r"^[^.]*", 0)


def slug(c: Column) -> Column:
    """Safe for file names: letters, digits, dots, dashes; anything else as one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.trim(c), r"[^a-zA-Z0-9.-]+", "_"), "^_+|_+$", "")


def folder_number(path: Column) -> Column:
    """The number of five or more digits in a path: the last in the deepest folder that has one, else the first in the file's stem.

    Null without one, and for a path of a single component.
    """
    parts = F.split(F.regexp_replace(path, "^/+|/+$", ""), "/")
    folders = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    found = F.filter(F.transform(folders, lambda p: F.regexp_extract_all(p, F.lit(r"(\d{5,})"), F.lit(1))), lambda m: F.size(m) > 0)
    in_folder = F.try_element_at(F.try_element_at(found, F.lit(-1)), F.lit(-1))
    stem = F.regexp_replace(F.try_element_at(parts, F.lit(-1)), r"\.[^.]*$", "")
    in_stem = F.nullif(F.regexp_extract(stem, r"(\d{5,})", 1), F.lit(""))
    return F.when(F.size(parts) > 1, F.coalesce(in_folder, in_stem)).cast("long")


def year_matches(year: Column, token: int) -> Column:
    """An exact year from 1000 on; a shorter token matches the years that end like it."""
    return year == token if token >= 1000 else year % 100 == token % 100


def custom_id(key: Column, prefix: str = "gcs_") -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(key.cast("binary"), 256), 1, 40))


def chunk_label(index: Column, total: Column) -> Column:
    return F.format_string("chunk_%03d_of_%03d", index, total)


def part_file(stem: str, index: Column, total: Column, extension: str = "jsonl") -> Column:
    return F.format_string(f"{stem}.part%03d-of-%03d.{extension}", index, total)


def part_of(name: Column) -> Column:
    """The inverse: struct of index and total, null for other names."""
    index, total = (F.nullif(F.regexp_extract(name, r"\.part(\d+)-of-(\d+)\.[^.]+$", k), F.lit("")) for k in (1, 2))
    return F.when(index.isNotNull(), F.struct(index.cast("int").alias("index"), total.cast("int").alias("total")))


def run_time(name: Column) -> Column:
    """ISO time of a run name that holds YYYYMMDD_HHMMSS, else the empty string."""
    d = F.regexp_extract(name, r"(\d{8})_(\d{6})", 0)
    iso = F.concat_ws("", *[x for k, n, sep in ((1, 4, "-"), (5, 2, "-"), (7, 2, "T"), (10, 2, ":"), (12, 2, ":"), (14, 2, "")) for x in (F.substring(d, k, n), F.lit(sep))])
    return F.when(d != "", iso).otherwise(F.lit(""))


def state(c: Column) -> Column:
    """Last dotted segment of a state, UNKNOWN for null and blank."""
    return F.coalesce(F.nullif(leaf(F.trim(c)), F.lit("")), F.lit("UNKNOWN"))


def succeeded(c: Column) -> Column:
    return F.upper(state(c)).isin(SUCCESS_STATES)


def failed_state(c: Column) -> Column:
    """Failure states; a partial success is one."""
    return F.upper(state(c)).isin(FAILURE_STATES)


def location_of(batch: Column) -> Column:
    """Segment after ``locations`` in a resource name."""
    return F.nullif(F.regexp_extract(batch, r"(?:^|/)locations/([^/]+)", 1), F.lit(""))


def provider_of(model: Column) -> Column:
    """The provider that a model's name tells, null if none."""
    m = F.lower(stripped(model))
    starts = lambda names: F.coalesce(m.rlike("^(" + "|".join(names) + ")"), F.lit(False))
    return F.coalesce(*[F.when(starts(names), provider) for provider, names in MODEL_STARTS.items()])


def provider_of_batch(name: Column) -> Column:
    """The provider that a batch's name tells: one that numbers its batches, or one that names them as resources; else null."""
    return F.when(name.startswith("msgbatch_"), "anthropic").when(name.startswith("projects/") | name.contains("/locations/") | name.startswith("batches/"), "gemini")


def page_number(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"^page_(\d+)\.[A-Za-z0-9]+$", 1), F.lit("")).cast("long")


def compact_error(*parts: Column, limit: int = 500) -> Column:
    """Messages with white space collapsed, blanks and repeats dropped, joined by ``; ``, cut to ``limit`` with ``...``."""
    tidy = F.array_compact(F.array(*[blank_to_null(F.regexp_replace(p, r"\s+", " ")) for p in parts]))
    joined = F.array_join(F.array_distinct(tidy), "; ")
    return F.when(F.length(joined) > limit, F.concat(F.substring(joined, 1, limit - 3), F.lit("..."))).otherwise(joined)


def redacted(message: Column, secrets: list[str]) -> Column:
    """Secrets of 8 or more characters replaced."""
    return reduce(lambda m, s: F.replace(m, F.lit(s), F.lit("[redacted]")), (s for s in secrets if len(s) >= 8), message)


def _marked(message: Column, markers: list[str]) -> Column:
    low = F.lower(F.coalesce(message, F.lit("")))
    return reduce(lambda a, b: a | b, (F.contains(low, F.lit(m)) for m in markers))


def transient(message: Column) -> Column:
    """A failure that a retry may pass."""
    return _marked(message, TRANSIENT_MARKERS)


def fatal(message: Column) -> Column:
    """A failure that ends the run."""
    return _marked(message, FATAL_MARKERS)


def backoff_seconds(attempt: Column, initial: float = 2.0, most: float = 30.0, jitter: Column | None = None) -> Column:
    """Seconds to wait after an attempt, from 1: doubled each time up to ``most``; an attempt below 1 waits like the first."""
    base = F.least(F.lit(initial) * F.pow(F.lit(2.0), F.greatest(attempt - 1, F.lit(0))), F.lit(max(initial, most)))
    return base + jitter if jitter is not None else base


def stringified(c: Column) -> Column:
    """Text of a value; null and NaN are empty."""
    s = c.cast("string")
    return F.when(s.isNull() | (s == "NaN"), "").otherwise(s)


def media_type(name: Column) -> Column:
    ext = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))
    return (
        F.when(ext.isin("jpg", "jpeg"), "image/jpeg").when(ext == "png", "image/png").when(ext.isin("tif", "tiff"), "image/tiff")
        .when(ext == "webp", "image/webp").when(ext == "gif", "image/gif").when(ext == "bmp", "image/bmp").otherwise("application/octet-stream")
    )


def in_suffixed_folder(path: Column, suffix: str = "_fp") -> Column:
    """Whether a folder of the path, not the file itself, ends with the suffix."""
    parts = F.split(path, "/")
    return F.exists(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: p.endswith(suffix))
