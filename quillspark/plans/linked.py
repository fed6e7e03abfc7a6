"""Manifests, requests, datapoints, mappings and job lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import text
from quillspark.operators import links, manifest
from quillspark.sources.tables import table


def q59_request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "part").select(F.concat(F.lit("gs://b/page_"), F.col("p_partkey").cast("string"), F.when(F.col("p_size") % 2 == 0, ".png").otherwise(".tiff")).alias("key"))
    lines, ids = manifest.request_lines(keys, "key", "Read it."), manifest.manifest_lines(keys, "key")
    return ids.join(lines, "key").select("key", "mime_type", "custom_id", F.get_json_object("value", "$.request.contents[0].parts[1].fileData.mimeType").alias("sent_type"), F.get_json_object("value", "$.request.contents[0].parts[0].text").alias("prompt"))


def q60_manifest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = manifest.manifest_records(
        table(spark, sf_dir, "events"), image_name=F.concat(F.lit("i"), F.col("user_id").cast("string")), status=F.when(F.col("event_type") == "error", "failed").otherwise("success"),
        total_seconds=F.col("value"), attempts=F.col("event_id") % 3 + 1, failure_reason=F.when(F.col("event_type") == "error", "timeout"), event=F.col("event_id"),
    )
    return held.groupBy("status", "attempts", "failure_reason").agg(F.count(F.lit(1)).alias("n"), F.count("provider").alias("providers"), F.max("event").alias("last_event"))


def q61_datapoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select(F.concat(F.lit("gs://b/"), F.col("s_suppkey").cast("string"), F.lit(".png")).alias("image_name"), F.struct("s_name", F.when(F.col("s_nationkey") > 4, F.col("s_nationkey")).alias("nation")).alias("patient"), F.array("s_suppkey").alias("ids"))
    index = table(spark, sf_dir, "part").select(F.concat((F.col("p_partkey") * 2).cast("string"), F.lit(".png")).alias("image_name"))
    return links.datapoints(supplier, index, text.identity(F.col("image_name")), "image_name")


def q62_duplicate_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.duplicate_names(table(spark, sf_dir, "pages"), "url")


def q63_resolved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    mapping = customers.where("c_custkey % 3 != 0").select(F.concat(F.lit("id"), F.col("c_custkey").cast("string")).alias("custom_id"), F.col("c_name").alias("key"))
    results = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("id"), F.col("o_custkey").cast("string")).alias("custom_id"))
    return links.resolved_keys(results, mapping).select("o_orderkey", "key")


def q64_retry_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") * 3).alias("source_a"), F.when(F.col("o_orderkey") % 4 != 1, F.col("o_orderkey") - 1).alias("source_b"))
    return links.with_parent(jobs, "o_orderkey", ["source_a", "source_b"]).select("o_orderkey", "parent")


def q65_visible_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run"), "l_linenumber", F.when((F.col("l_linenumber") == 1) & (F.col("l_orderkey") % 2 == 0), "current").otherwise("legacy").alias("kind"))
    return links.visible(sets, "run", "kind").groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("run").alias("runs"))


def q66_job_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "JOB_STATE_SUCCEEDED").when(F.col("o_orderstatus") == "O", F.when(F.col("o_orderkey") % 5 == 0, "x.JOB_STATE_EXPIRED").otherwise("retrieved_partial"))
    jobs = table(spark, sf_dir, "orders").select("o_orderkey", status.alias("status"), (F.col("o_custkey") % 2).alias("missing"))
    return links.transitions(links.poll_candidates(jobs, "status"), "status", "missing").groupBy("next_status").agg(F.count(F.lit(1)).alias("n"))


def q67_model_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.model_search(table(spark, sf_dir, "part"), " BRAND#1", "p_name", "p_brand", limit=30).select("p_name", "p_brand")


def q68_cache_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    first = links.cache_hits(events.where("event_id % 2 = 0"), spark.createDataFrame([], "signature string"), ["user_id", "event_type"])
    return links.cache_hits(events.where("event_id % 2 = 1"), first, ["event_type", "user_id"]).groupBy("hit").agg(F.count(F.lit(1)).alias("n"))


def q69_job_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "retrieved_partial").otherwise("running").alias("status"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("ok"), F.when(F.col("o_orderkey") % 5 == 0, F.lit(4)).alias("bad"))
    return manifest.job_summary(held, "o_orderkey", "status", "ok", "bad")


QUERIES = {f.__name__: f for f in (q59_request_lines, q60_manifest_records, q61_datapoints, q62_duplicate_names, q63_resolved_keys, q64_retry_parents, q65_visible_datasets, q66_job_transitions, q67_model_search, q68_cache_hits, q69_job_summaries)}

ORACLE_SQL = {
    "q59_request_lines": """
        WITH k AS (SELECT 'gs://b/page_' || p_partkey || CASE WHEN p_size % 2 = 0 THEN '.png' ELSE '.tiff' END AS key, CASE WHEN p_size % 2 = 0 THEN 'image/png' ELSE 'image/tiff' END AS mime_type FROM part)
        SELECT key, mime_type, 'gcs_' || left(sha256(key), 40) AS custom_id, mime_type AS sent_type, 'Read it.' AS prompt FROM k
    """,
    "q60_manifest_records": """
        SELECT CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status, CAST(event_id % 3 + 1 AS INTEGER) AS attempts, CASE WHEN event_type = 'error' THEN 'timeout' END AS failure_reason,
               count(*) AS n, CAST(0 AS BIGINT) AS providers, max(event_id) AS last_event FROM events GROUP BY 1, 2, 3
    """,
    "q61_datapoints": """
        WITH s AS (SELECT s_suppkey || '.png' AS name, s_name, s_nationkey FROM supplier WHERE s_suppkey || '.png' IN (SELECT p_partkey * 2 || '.png' FROM part))
        SELECT name, 'patient.s_name' AS field, s_name AS value FROM s UNION ALL SELECT name, 'patient.nation', CAST(s_nationkey AS VARCHAR) FROM s WHERE s_nationkey > 4
    """,
    "q62_duplicate_names": """
        SELECT nullif(nullif(regexp_extract(regexp_replace(trim(url), '/+$', ''), '[^/]*$'), ''), '.') AS name, count(*) AS n FROM pages GROUP BY 1 HAVING count(*) > 1 AND name IS NOT NULL
    """,
    "q63_resolved_keys": "SELECT o_orderkey, coalesce(c_name, 'id' || o_custkey) AS key FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 3 <> 0",
    "q64_retry_parents": """
        WITH j AS (SELECT o_orderkey AS k FROM orders)
        SELECT k AS o_orderkey, coalesce((SELECT p.k FROM j p WHERE p.k = j.k * 3), (SELECT p.k FROM j p WHERE p.k = CASE WHEN j.k % 4 <> 1 THEN j.k - 1 END)) AS parent FROM j
    """,
    "q65_visible_datasets": """
        WITH s AS (SELECT l_orderkey AS run, CASE WHEN l_linenumber = 1 AND l_orderkey % 2 = 0 THEN 'current' ELSE 'legacy' END AS kind FROM lineitem)
        SELECT kind, count(*) AS n, count(DISTINCT run) AS runs FROM s WHERE kind = 'current' OR run NOT IN (SELECT run FROM s WHERE kind = 'current') GROUP BY 1
    """,
    "q66_job_transitions": """
        SELECT CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_custkey % 2 = 0 THEN 'retrieved_complete' ELSE 'retrieved_partial' END ELSE 'failed' END AS next_status, count(*) AS n
        FROM orders WHERE o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_orderkey % 5 = 0) GROUP BY 1
    """,
    "q67_model_search": "SELECT p_name, p_brand FROM part WHERE contains(lower(p_name), 'brand#1') OR contains(lower(p_brand), 'brand#1') ORDER BY p_name, p_brand LIMIT 30",
    "q68_cache_hits": """
        SELECT (user_id, event_type) IN (SELECT (user_id, event_type) FROM events WHERE event_id % 2 = 0) AS hit, count(*) AS n FROM events WHERE event_id % 2 = 1 GROUP BY 1
    """,
    "q69_job_summaries": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'retrieved' ELSE 'running' END AS status,
               concat_ws(', ', CASE WHEN o_orderkey % 2 = 0 THEN o_custkey || ' succeeded' END, CASE WHEN o_orderkey % 5 = 0 THEN '4 failed' END) AS detail FROM orders
    """,
}
