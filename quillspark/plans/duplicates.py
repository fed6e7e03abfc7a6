"""Duplicates: events of one user and day are attempts at one item, errors are failures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import aggregates, dedupe, jobs
from quillspark.sources.tables import table


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("user_id") % 50 != 0, F.concat_ws("/", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")))
    return table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value", key.alias("item"))


FAILED = "event_type = 'error'"


def q12_first_successful(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.first_successful(attempts(spark, sf_dir), "item", F.expr(FAILED), "event_id").select("item", "event_id", "event_type", "position")


def q13_duplicate_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.ledger(attempts(spark, sf_dir), "item", F.expr(FAILED), "event_id").select("event_id", "action", "kept_seq")


def q14_provide_all_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.combine_counts(attempts(spark, sf_dir), "item", F.expr(FAILED), "event_id")


def q15_first_valid_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.first_valid(attempts(spark, sf_dir), "item", F.expr(f"value > 20 AND NOT ({FAILED})"), "event_id").select("item", "event_id")


def q16_rejected_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = attempts(spark, sf_dir).where("item IS NOT NULL")
    return aggregates.rejected_only(held, "item", F.expr(f"value > 20 AND NOT ({FAILED})"), "event_type")


def q27_validation_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 4 == 0, "cloud").otherwise("local").alias("source"), (F.col("user_id") % 40).alias("validator"), "event_type")
    return dedupe.prefer_source(held, ["validator", "event_type"], "source", "cloud", "event_id")


def q45_latest_job_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("created"), F.lit("1997-01-01").alias("updated"))
    return jobs.newest_first(held, "created", "updated", "o_orderkey", limit=25)


def q46_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    old, new = events.where("event_id % 3 != 0"), events.where("event_id % 3 = 0")
    started = lambda d: d.withColumn("started", F.when(F.col("event_type") != "view", F.col("event_id")))
    return dedupe.upsert(started(old), started(new), "user_id", "event_id", keep=["started"])


QUERIES = {f.__name__: f for f in (q12_first_successful, q13_duplicate_ledger, q14_provide_all_counts, q15_first_valid_per_key, q16_rejected_reasons, q27_validation_dedupe, q45_latest_job_order, q46_upsert)}

_A = "a AS (SELECT event_id, event_type, value, CASE WHEN user_id % 50 <> 0 THEN user_id || '/' || strftime(ts, '%Y-%m-%d') END AS item, event_type = 'error' AS failed FROM events)"
ORACLE_SQL = {
    "q12_first_successful": f"""
        WITH {_A}, r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY failed, event_id) AS rn, min(event_id) OVER (PARTITION BY item) AS position FROM a WHERE item IS NOT NULL)
        SELECT item, event_id, event_type, position FROM r WHERE rn = 1 UNION ALL SELECT item, event_id, event_type, event_id FROM a WHERE item IS NULL
    """,
    "q13_duplicate_ledger": f"""
        WITH {_A}, w AS (SELECT *, min(event_id) OVER b AS f, min(CASE WHEN NOT failed THEN event_id END) OVER b AS ok FROM a
                         WINDOW b AS (PARTITION BY item ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT event_id, CASE WHEN item IS NULL OR f IS NULL THEN 'kept' WHEN ok IS NULL AND NOT failed THEN 'replaced_failed_duplicate' ELSE 'skipped_duplicate' END AS action,
               CASE WHEN item IS NOT NULL THEN coalesce(ok, f) END AS kept_seq FROM w
    """,
    "q14_provide_all_counts": f"""
        WITH {_A}, p AS (SELECT item, count(*) AS n, arg_min(failed, event_id) AS ff, bool_or(NOT failed) AS ok FROM a WHERE item IS NOT NULL GROUP BY 1)
        SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys, CAST(sum(n - 1) AS BIGINT) AS duplicates, count(*) FILTER (ff AND ok) AS replaced FROM p
    """,
    "q15_first_valid_per_key": f"WITH {_A} SELECT item, min(event_id) AS event_id FROM a WHERE value > 20 AND NOT failed AND item IS NOT NULL GROUP BY 1",
    "q16_rejected_reasons": f"WITH {_A} SELECT item, event_type, count(*) AS n FROM a WHERE item IS NOT NULL AND item NOT IN (SELECT item FROM a WHERE value > 20 AND NOT failed AND item IS NOT NULL) GROUP BY 1, 2",
    "q27_validation_dedupe": """
        WITH h AS (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'cloud' ELSE 'local' END AS source, user_id % 40 AS validator, event_type FROM events),
        r AS (SELECT *, row_number() OVER (PARTITION BY validator, event_type ORDER BY source, CASE WHEN source = 'cloud' THEN event_id ELSE -event_id END) AS rn,
                     min(event_id) OVER (PARTITION BY validator, event_type) AS position FROM h)
        SELECT event_id, source, validator, event_type, position FROM r WHERE rn = 1
    """,
    "q45_latest_job_order": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS created, '1997-01-01' AS updated
        FROM orders ORDER BY coalesce(nullif(created, ''), updated) DESC, o_orderkey LIMIT 25
    """,
    "q46_upsert": """
        SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value,
               min(CASE WHEN event_type <> 'view' THEN event_id END) AS started FROM events GROUP BY 1
    """,
}
