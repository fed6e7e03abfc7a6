"""Schema checks, statistics and chunk tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import schema
from quillspark.operators import aggregates, jobs, walks
from quillspark.sources.tables import table


def q70_integer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.integer_stats(table(spark, sf_dir, "documents"), "n_chars")


def q71_distinct_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.distinct_prefixes(table(spark, sf_dir, "pages").select(F.regexp_replace("url", "^https?://", "").alias("path")), "path", 40)


def q72_ordered_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.ordered_distinct(table(spark, sf_dir, "events"), "user_id", "event_id")


#: What an order record must be like, as fixed values.
FIELDS = [
    schema.Field("status", "STRING", allowed=("F", "O")), schema.Field("when", "DATE", least="1996-01-01", most="1999-12-31"), schema.Field("total", "DOUBLE", most="250000"),
    schema.Field("customer.id", "BIGINT"), schema.Field("note", "STRING", required=False),
]


def q73_schema_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    record = F.struct(
        F.col("o_orderstatus").alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("when"), F.col("o_totalprice").alias("total"),
        F.when(k % 10 != 0, F.struct(F.col("o_custkey").alias("id"))).alias("customer"), F.lit("x").alias("further"),
    )
    held = table(spark, sf_dir, "orders").select(schema.violations(F.parse_json(F.to_json(record)), FIELDS).alias("v"))
    return held.groupBy(F.array_join("v", "; ").alias("violations")).agg(F.count(F.lit(1)).alias("n"))


def q74_tuned_workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each step needs the one before, so a user's rates are one array, in one task: numbers alone, of which a task holds tens of millions."""
    rates = table(spark, sf_dir, "events").groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "value"))), lambda s: s["value"]).alias("rates"))
    return rates.select("user_id", F.array_join(schema.tuned_workers(F.col("rates"), 8, 4, 1, 24, ratio=1.0), ",").alias("workers"))


def q124_worker_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, a row an event: users with any number of rates, whose steps are composed chunk by chunk."""
    return walks.tuned(table(spark, sf_dir, "events"), "user_id", "event_id", "value", 8, 4, 1, 24, ratio=1.0)


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") % 200).alias("job"), F.col("l_linenumber").alias("chunk")).agg(F.count(F.lit(1)).alias("requests"), F.max("l_returnflag").alias("flag"))


def q75_request_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = spark.range(0, 220).select(F.col("id").alias("job"), F.when(F.col("id") % 4 == 0, F.col("id") + 1000).alias("requests"))
    return jobs.request_total(heads, _chunks(spark, sf_dir), "job", "requests", retries=F.col("chunk") > 5)


def q76_state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.when(F.col("l_returnflag") == "A", "x.JOB_STATE_SUCCEEDED").when(F.col("l_returnflag") == "R", "JOB_STATE_FAILED").when(F.col("l_linenumber") < 3, " ").otherwise("JOB_STATE_RUNNING")
    return jobs.state_counts(table(spark, sf_dir, "lineitem").select(state.alias("s")), "s")


def q77_linked_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = _chunks(spark, sf_dir).withColumn("name", F.concat_ws("-", F.col("job").cast("string"), F.col("chunk").cast("string")))
    parents, children = held.where("chunk <= 4").select("job", "name", "chunk"), held.where("chunk >= 3").select("job", "name", "chunk")
    return jobs.linked_chunks(parents, children, "job", "name", "chunk")


def q78_status_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    new = orders.where("o_orderkey % 3 = 0").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, "F").otherwise("P").alias("status"))
    out = jobs.updated_status(orders.select("o_orderkey", F.col("o_orderstatus").alias("status")), new, "o_orderkey")
    return out.groupBy("status", "changed").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (q70_integer_stats, q71_distinct_prefixes, q72_ordered_distinct, q73_schema_validation, q74_tuned_workers, q124_worker_steps, q75_request_totals, q76_state_counts, q77_linked_chunks, q78_status_update)}

_CHUNKS = "c AS (SELECT l_orderkey % 200 AS job, l_linenumber AS chunk, count(*) AS requests FROM lineitem GROUP BY 1, 2)"
ORACLE_SQL = {
    "q70_integer_stats": "SELECT count(n_chars) AS n, CAST(sum(n_chars) AS BIGINT) AS total, min(n_chars) AS min, max(n_chars) AS max, round(avg(n_chars), 6) AS mean, round(median(n_chars), 6) AS median FROM documents",
    "q71_distinct_prefixes": "SELECT DISTINCT regexp_extract(regexp_replace(url, '^https?://', ''), '^([^/]+)/', 1) AS prefix FROM pages WHERE prefix <> '' ORDER BY 1 LIMIT 40",
    "q72_ordered_distinct": "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1",
    "q73_schema_validation": """
        WITH v AS (SELECT list_sort(list_filter([
            CASE WHEN o_orderkey % 10 = 0 THEN 'customer.id: missing' END, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'status: not allowed' END,
            CASE WHEN o_totalprice > 250000 THEN 'total: out of range' END, CASE WHEN CAST(o_orderdate AS DATE) NOT BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' THEN 'when: out of range' END], lambda x: x IS NOT NULL)) AS v FROM orders)
        SELECT array_to_string(v, '; ') AS violations, count(*) AS n FROM v GROUP BY 1
    """,
    "q74_tuned_workers": """
        WITH RECURSIVE e AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
        w AS (SELECT user_id, i, value, 12 AS workers FROM e WHERE i = 1
              UNION ALL SELECT e.user_id, e.i, e.value, greatest(1, least(24, w.workers + CASE WHEN e.value >= w.value THEN 4 ELSE -4 END)) FROM w JOIN e ON e.user_id = w.user_id AND e.i = w.i + 1)
        SELECT user_id, string_agg(CAST(workers AS VARCHAR), ',' ORDER BY i) AS workers FROM w GROUP BY 1
    """,
    "q124_worker_steps": """
        WITH RECURSIVE e AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
        w AS (SELECT user_id, event_id, i, value, 12 AS workers FROM e WHERE i = 1
              UNION ALL SELECT e.user_id, e.event_id, e.i, e.value, greatest(1, least(24, w.workers + CASE WHEN e.value >= w.value THEN 4 ELSE -4 END)) FROM w JOIN e ON e.user_id = w.user_id AND e.i = w.i + 1)
        SELECT user_id, event_id, value, workers FROM w
    """,
    "q75_request_totals": f"""
        WITH {_CHUNKS}, s AS (SELECT job, sum(requests) AS n FROM c WHERE chunk <= 5 GROUP BY 1)
        SELECT h.job, CAST(CASE WHEN h.job % 4 = 0 THEN h.job + 1000 ELSE n END AS BIGINT) AS total FROM (SELECT unnest(range(0, 220)) AS job) h LEFT JOIN s USING (job)
    """,
    "q76_state_counts": """
        SELECT CASE l_returnflag WHEN 'A' THEN 'JOB_STATE_SUCCEEDED' WHEN 'R' THEN 'JOB_STATE_FAILED' ELSE CASE WHEN l_linenumber < 3 THEN 'UNKNOWN' ELSE 'JOB_STATE_RUNNING' END END AS state,
               count(*) AS n, l_returnflag IN ('A', 'R') AS finished FROM lineitem GROUP BY 1, 3
    """,
    "q77_linked_chunks": f"""
        WITH {_CHUNKS}, p AS (SELECT *, max(chunk) OVER (PARTITION BY job) AS most FROM c WHERE chunk <= 4), n AS (SELECT * FROM c WHERE chunk > 4)
        SELECT job, job || '-' || chunk AS name, chunk FROM p
        UNION ALL SELECT n.job, n.job || '-' || n.chunk, CAST(coalesce((SELECT max(chunk) FROM p WHERE p.job = n.job), 0) + row_number() OVER (PARTITION BY n.job ORDER BY n.chunk) AS INTEGER) FROM n
    """,
    "q78_status_update": """
        WITH o AS (SELECT o_orderstatus AS old, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus WHEN o_orderkey % 2 = 0 THEN 'F' ELSE 'P' END AS status FROM orders)
        SELECT status, status <> old AS changed, count(*) AS n FROM o GROUP BY 1, 2
    """,
}
