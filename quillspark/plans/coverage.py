"""Coverage: orders are the expected items, line items what was produced."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import text
from quillspark.operators import aggregates, coverage, order
from quillspark.sources.tables import table


def q01_coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.coverage_report(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")


def q02_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = coverage.missing_keys(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")
    return aggregates.sample_keys(gaps, "o_orderkey", 10)


def q03_full_coverage_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    early = table(spark, sf_dir, "orders").where("o_orderdate < '1996-01-01'")
    late = table(spark, sf_dir, "lineitem").where("l_shipdate >= '1995-07-01'")
    status = coverage.keyed_status(early, late, "o_orderkey", "l_orderkey")
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def q21_chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    todo = coverage.continue_with(table(spark, sf_dir, "orders").select("o_orderkey"), lines, F.col("o_orderkey"), "l_orderkey")
    chunks = order.even_chunks(todo, 7, "o_orderkey")
    return chunks.groupBy("chunk").agg(
        text.chunk_label(F.first("chunk").cast("int"), F.first("chunks").cast("int")).alias("label"), F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


def q20_even_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.even_chunks(table(spark, sf_dir, "orders").select("o_orderkey"), 7, "o_orderkey").groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"))


def q28_finalize_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    reasons = orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("key"), F.lit("cancelled").alias("reason"))
    rows = coverage.finalized(orders, coverage.present(table(spark, sf_dir, "lineitem"), "l_orderkey"), reasons, "o_orderkey", "l_orderkey")
    return rows.groupBy("failed", "failure_reason").agg(F.count(F.lit(1)).alias("n"), F.sum("key").alias("key_sum"))


def q29_failed_retry_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    expected = coverage.present(lines, "l_orderkey").select(F.col("l_orderkey").alias("key"))
    failures = lines.where("l_linenumber >= 6").groupBy(F.col("l_orderkey").alias("key")).agg(F.min("l_returnflag").alias("reason"))
    return coverage.failed_keys(expected, expected, failures, "key").groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("least"))


def q48_restrict_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "benchmark").select((F.col("item_id") * 13).alias("name"))
    return coverage.restriction_report(table(spark, sf_dir, "documents"), asked, F.col("doc_id"), "name")


def q51_gap_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = (table(spark, sf_dir, t) for t in ("orders", "lineitem"))
    expected = orders.select(F.col("o_orderkey").alias("key"))
    early = lines.where("l_linenumber <= 2").select(F.col("l_orderkey").alias("key"))
    late = lines.where("l_linenumber > 2").select(F.col("l_orderkey").alias("key"))
    return coverage.recovered(coverage.coverage_report(expected, early, "key"), expected, early, late, "key")


def q52_resolved_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    local = lines.where("l_returnflag = 'A'").select(F.col("l_partkey").alias("name"))
    cloud = lines.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("name"))
    out = coverage.resolved_once(local, cloud, "name")
    return out.groupBy("status").agg(F.count(F.lit(1)).alias("names"), F.count_if(F.col("local_count") > 1).alias("local_dups"), F.count_if(F.col("cloud_count") > 1).alias("cloud_dups"))


QUERIES = {f.__name__: f for f in (q01_coverage_report, q02_missing_keys, q03_full_coverage_outer, q20_even_chunks, q21_chunk_plan, q28_finalize_failed, q29_failed_retry_fallback, q48_restrict_list, q51_gap_recovery, q52_resolved_once)}

_REPORT = """
    SELECT count(*) FILTER (e.k IS NOT NULL) AS expected, count(*) FILTER (e.k IS NOT NULL AND p.k IS NOT NULL) AS covered,
           count(*) FILTER (p.k IS NULL) AS missing, count(*) FILTER (e.k IS NULL) AS extra,
           round(count(*) FILTER (e.k IS NOT NULL AND p.k IS NOT NULL) / count(*) FILTER (e.k IS NOT NULL), 6) AS ratio
    FROM e FULL JOIN p ON e.k = p.k
"""
_CHUNKED = """
    n AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS n FROM t),
    c AS (SELECT k, CASE WHEN i < (n % 7) * (n // 7 + 1) THEN i // (n // 7 + 1) ELSE n % 7 + (i - (n % 7) * (n // 7 + 1)) // (n // 7) END + 1 AS chunk FROM n)
"""
ORACLE_SQL = {
    "q01_coverage_report": f"WITH e AS (SELECT DISTINCT o_orderkey k FROM orders), p AS (SELECT DISTINCT l_orderkey k FROM lineitem) {_REPORT}",
    "q02_missing_keys": """
        WITH m AS (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))
        SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rank FROM m ORDER BY 1 LIMIT 10
    """,
    "q03_full_coverage_outer": """
        WITH e AS (SELECT DISTINCT o_orderkey k FROM orders WHERE o_orderdate < '1996-01-01'),
        p AS (SELECT DISTINCT l_orderkey k FROM lineitem WHERE l_shipdate >= '1995-07-01')
        SELECT CASE WHEN p.k IS NULL THEN 'missing' WHEN e.k IS NULL THEN 'extra' ELSE 'covered' END AS status, count(*) AS n
        FROM e FULL JOIN p ON e.k = p.k GROUP BY 1
    """,
    "q20_even_chunks": f"WITH t AS (SELECT o_orderkey k FROM orders), {_CHUNKED} SELECT chunk, count(*) AS n, min(k) AS first_key FROM c GROUP BY 1",
    "q21_chunk_plan": f"""
        WITH t AS (SELECT o_orderkey k FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')), {_CHUNKED}
        SELECT chunk, printf('chunk_%03d_of_%03d', chunk, 7) AS label, count(*) AS n, min(k) AS first_key, max(k) AS last_key FROM c GROUP BY 1
    """,
    "q28_finalize_failed": """
        WITH p AS (SELECT DISTINCT l_orderkey k FROM lineitem),
        rows AS (SELECT k, false AS failed, '' AS failure_reason FROM p UNION ALL
                 SELECT o_orderkey, true, CASE WHEN o_orderstatus = 'F' THEN 'cancelled' ELSE 'missing_successful_output' END FROM orders WHERE o_orderkey NOT IN (SELECT k FROM p))
        SELECT failed, failure_reason, count(*) AS n, CAST(sum(k) AS BIGINT) AS key_sum FROM rows GROUP BY 1, 2
    """,
    "q29_failed_retry_fallback": """
        WITH f AS (SELECT CAST(l_orderkey AS VARCHAR) AS key, min(l_returnflag) AS reason FROM lineitem WHERE l_linenumber >= 6 GROUP BY 1)
        SELECT reason, count(*) AS n, min(key) AS least FROM f GROUP BY 1
    """,
    "q48_restrict_list": """
        WITH b AS (SELECT DISTINCT item_id * 13 AS name FROM benchmark)
        SELECT count(*) AS requested, count(d.doc_id) AS matched, count(*) FILTER (d.doc_id IS NULL) AS missing, count(d.doc_id) AS kept
        FROM b LEFT JOIN documents d ON b.name = d.doc_id
    """,
    "q51_gap_recovery": f"WITH e AS (SELECT DISTINCT o_orderkey k FROM orders), p AS (SELECT DISTINCT l_orderkey k FROM lineitem WHERE l_linenumber <= 2 OR l_orderkey IN (SELECT o_orderkey FROM orders)) {_REPORT}",
    "q52_resolved_once": """
        WITH l AS (SELECT l_partkey k, count(*) n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1), c AS (SELECT l_partkey k, count(*) n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
        SELECT CASE WHEN c.k IS NULL THEN 'local_only' WHEN l.k IS NULL THEN 'cloud_only' ELSE 'both' END AS status, count(*) AS names,
               count(*) FILTER (l.n > 1) AS local_dups, count(*) FILTER (c.n > 1) AS cloud_dups
        FROM l FULL JOIN c ON l.k = c.k GROUP BY 1
    """,
}
