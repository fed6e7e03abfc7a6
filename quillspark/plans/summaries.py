"""Counters, distributions, completeness and listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import text, values
from quillspark.operators import aggregates
from quillspark.sources.tables import table


def q06_status_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.value_counts(table(spark, sf_dir, "events"), "event_type")


def q07_numeric_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.distributions(table(spark, sf_dir, "events"), "value", by="event_type")


def q08_processing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.processing_summary(table(spark, sf_dir, "events"), "user_id", "event_type", "value")


def q09_grouping_sets_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.grouping_summary(table(spark, sf_dir, "documents"), "lang", "source", "n_chars")


def q10_field_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return aggregates.completeness(both, ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"])


#: Column names to classify, as fixed values.
CATALOGUE = ["image_name", "patient.name", "File-Name", "total_tokens", "hospital stay.date", "processing_seconds", "page_lines.text", "failed", "diagnosis"]


def q11_schema_vs_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part is called by one of the catalogue's names, in another writing."""
    k = F.col("p_partkey")
    name = F.element_at(F.array(*map(F.lit, CATALOGUE)), (k % len(CATALOGUE) + 1).cast("int"))
    names = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.repeat(F.lit(" "), (k % 3).cast("int")), name).alias("path"))
    kind = values.schema_field(F.col("path"), ["image_name", "file_name"], ["failed"], ["token", "seconds"])
    return names.select("p_partkey", "path", text.field_name(F.col("path")).alias("normalised"), text.leaf(text.field_name(F.col("path"))).alias("leaf"), kind.alias("kind"))


def q17_first_failure_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.operators.dedupe import first_reason

    return first_reason(table(spark, sf_dir, "events").where("value < 40"), "user_id", "event_type", "event_id")


def q18_last_wins_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.operators.dedupe import last_reason

    return last_reason(table(spark, sf_dir, "events"), "user_id", "event_type", "event_id")


def q53_failure_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.failure_reasons(table(spark, sf_dir, "events").where("value < 5"), "user_id", "event_type", examples=3)


def q42_prefix_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.regexp_replace("url", "^https?://", "").alias("path"), "page_id")
    return aggregates.prefix_choices(pages, "path", "page_id", limit=12)


def q43_folder_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.path_summary(table(spark, sf_dir, "pages").select(F.regexp_replace("url", "^https?://", "").alias("path")), "path")


def q54_ancestor_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.ancestors(table(spark, sf_dir, "pages").select(F.regexp_replace("url", "^https?://", "").alias("path")), "path")


QUERIES = {f.__name__: f for f in (q06_status_counter, q07_numeric_distribution, q08_processing_summary, q09_grouping_sets_summary, q10_field_completeness, q11_schema_vs_metadata, q17_first_failure_reason, q18_last_wins_reason, q42_prefix_choices, q43_folder_summary, q53_failure_diagnostics, q54_ancestor_folders)}

_DISTRIBUTION = "count(value) AS n, round(min(value), 6) AS min, round(max(value), 6) AS max, round(avg(value), 6) AS mean, round(median(value), 6) AS median"
_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
_PATHS = "p AS (SELECT string_split(regexp_replace(url, '^https?://', ''), '/') AS a FROM pages)"
ORACLE_SQL = {
    "q06_status_counter": "SELECT event_type AS value, count(*) AS n FROM events WHERE trim(event_type) <> '' GROUP BY 1",
    "q07_numeric_distribution": f"SELECT 'total' AS grp, {_DISTRIBUTION} FROM events UNION ALL SELECT event_type, {_DISTRIBUTION} FROM events GROUP BY 1",
    "q08_processing_summary": f"""
        SELECT count(*) AS records, count(DISTINCT user_id) AS items, {_DISTRIBUTION},
               (SELECT string_agg(s, ',' ORDER BY s) FROM (SELECT event_type || '=' || count(*) AS s FROM events GROUP BY event_type)) AS statuses
        FROM events
    """,
    "q09_grouping_sets_summary": "SELECT lang, source, CAST(grouping(lang, source) AS BIGINT) AS level, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS total FROM documents GROUP BY GROUPING SETS ((), (lang), (source))",
    "q10_field_completeness": f"""
        WITH b AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)), u AS (
            {" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (trim(CAST({c} AS VARCHAR)) <> '') AS populated, count(*) AS rows FROM b" for c in _COLUMNS)})
        SELECT column_name, populated, rows - populated AS missing, round(populated / rows * 100, 4) AS completeness,
               row_number() OVER (ORDER BY round(populated / rows * 100, 4), column_name) AS rank FROM u
    """,
    "q11_schema_vs_metadata": f"""
        WITH c AS (SELECT p_partkey, repeat(' ', p_partkey % 3) || [{", ".join(f"'{n}'" for n in CATALOGUE)}][p_partkey % {len(CATALOGUE)} + 1] AS path FROM part),
        n AS (SELECT p_partkey, path, regexp_replace(regexp_replace(lower(trim(path)), '[\\s_-]+', '_', 'g'), '^_+|_+$', '', 'g') AS normalised FROM c),
        l AS (SELECT *, regexp_extract(normalised, '[^.]*$') AS leaf FROM n)
        SELECT *, CASE WHEN normalised IN ('image_name', 'file_name') OR leaf IN ('image_name', 'file_name') THEN 'identifier'
                       WHEN normalised = 'failed' OR leaf = 'failed' OR contains(normalised, 'token') OR contains(normalised, 'seconds') THEN 'metadata' ELSE 'schema' END AS kind FROM l
    """,
    "q17_first_failure_reason": "SELECT user_id, arg_min(event_type, event_id) AS reason FROM events WHERE value < 40 GROUP BY 1",
    "q18_last_wins_reason": "SELECT user_id, arg_max(event_type, event_id) AS reason FROM events GROUP BY 1",
    "q42_prefix_choices": """
        WITH g AS (SELECT regexp_extract(regexp_replace(url, '^https?://', ''), '^[^/]*') AS prefix, count(*) AS n, max(page_id) AS latest FROM pages GROUP BY 1)
        SELECT *, row_number() OVER (ORDER BY latest DESC, prefix) AS rank FROM g QUALIFY rank <= 12
    """,
    "q43_folder_summary": f"""
        WITH {_PATHS}, e AS (SELECT a, lower(regexp_extract(a[-1], '\\.([A-Za-z0-9]+)$', 1)) AS x, array_to_string(a[:-2], '/') AS f FROM p),
        k AS (SELECT 'extension' AS kind, CASE WHEN x = '' THEN '<none>' ELSE x END AS name FROM e UNION ALL SELECT 'depth', lpad(CAST(len(a) - 1 AS VARCHAR), 3, '0') FROM e
              UNION ALL SELECT 'folder', CASE WHEN f = '' THEN '.' ELSE f END FROM e)
        SELECT kind, name, count(*) AS n FROM k GROUP BY 1, 2
    """,
    "q53_failure_diagnostics": """
        WITH d AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS item, event_type AS reason FROM events WHERE value < 5)
        SELECT reason, count(*) AS n, array_to_string(list_sort(list(item))[:3], ',') AS examples FROM d GROUP BY 1
    """,
    "q54_ancestor_folders": f"""
        WITH {_PATHS}, u AS (SELECT a, unnest(range(0, len(a))) AS k FROM p)
        SELECT CASE WHEN k = 0 THEN '' ELSE array_to_string(a[:k], '/') END AS folder, count(*) AS n FROM u GROUP BY 1
    """,
}
