"""Streaming queries, drained to what is there now."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators.sampling import ucb_scores
from quillspark.sources.tables import table
from quillspark.streaming import log, sampler


def q50_stream_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    stream = log.event_stream(spark, sf_dir, schema, "events")
    return log.drained(log.running_counts(stream, "event_type"), spark, "q50_stream_counter", keys=["event_type"])


def q79_stream_sampler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events are decisions on their type as field, in a stream; the state that they leave scores the fields."""
    stream = log.event_stream(spark, sf_dir, table(spark, sf_dir, "events").schema, "events")
    score = F.when(F.col("value") > 10, F.when(F.col("value") > 50, 1.0).otherwise(0.5))
    state = log.drained(log.field_state(stream.withColumn("score", score), "event_type", "score"), spark, "q79_stream_sampler", keys=["field"])
    sizes = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("field")).agg(F.count(F.lit(1)).alias("size"))
    out = ucb_scores(sizes.join(state, "field"))
    return out.select("field", "size", "selected", "scored", F.round("score_sum", 6).alias("score_sum"), F.round("score", 6).alias("score"))


def q80_stream_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = log.event_stream(spark, sf_dir, table(spark, sf_dir, "events").schema, "events")
    return log.drained(log.status_changes(stream, "user_id", "event_type", "event_id"), spark, "q80_stream_status", keys=["user_id"])


def q105_stream_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' events are decisions about fields that the sampler chooses: types of parts, in two datasets."""
    part = table(spark, sf_dir, "part")
    catalogue = part.groupBy((F.col("p_partkey") % 2).alias("dataset"), F.col("p_type").alias("field")).agg(F.count_if(F.col("p_size") < 9).alias("size"))
    stream = log.event_stream(spark, sf_dir, table(spark, sf_dir, "events").schema, "events")
    score = F.when(F.col("value") > 10, F.when(F.col("value") > 50, 1.0).otherwise(0.5))
    out = sampler.choices(stream.withColumns({"score": score, "dataset": F.col("user_id") % 3}), catalogue, "dataset", "user_id", "event_id", "score")
    return log.drained(out, spark, "q105_stream_choices", "append").withColumn("accuracy", F.round("accuracy", 6))


def q106_stream_continuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user, by two runs into one dataset: one of the first half of the events, then one of all."""
    events = table(spark, sf_dir, "events")
    half = events.agg((F.max("event_id") / 2).alias("half")).first()["half"]
    path = f"{log.shared_dir(spark)}/q106-{uuid.uuid4().hex}"
    for run, wanted in ((1, F.col("event_id") < half), (2, F.lit(True))):
        stream = log.event_stream(spark, sf_dir, events.schema, "events").where(wanted).select("user_id", "event_id", "event_type", F.lit(run).alias("run"))
        log.append_batches(stream, path, f"{path}-checkpoint-{run}", "user_id", "event_id", buckets=16).awaitTermination()
    return log.appended(spark, path, stream.schema).drop("_batch")


QUERIES = {f.__name__: f for f in (q50_stream_counter, q79_stream_sampler, q80_stream_status, q105_stream_choices, q106_stream_continuation)}
ORACLE_SQL = {
    "q50_stream_counter": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
    "q79_stream_sampler": """
        WITH f AS (SELECT event_type AS field, count(*) AS size, count(*) AS selected, count(*) FILTER (value > 10) AS scored,
                          coalesce(sum(CASE WHEN value > 50 THEN 1.0 ELSE 0.5 END) FILTER (value > 10), 0) AS score_sum FROM events GROUP BY 1),
        t AS (SELECT *, count(*) OVER () AS g, CAST(sum(size) OVER () AS DOUBLE) AS n, CAST(sum(selected) OVER () AS DOUBLE) AS t FROM f)
        SELECT field, size, selected, scored, CAST(round(score_sum, 6) AS DOUBLE) AS score_sum,
               round(0.5 / g + 0.5 * size / n - selected / greatest(t, 1) + 0.25 * sqrt(2 * ln(greatest(t, 2)) / (scored + 1)), 6) AS score FROM t
    """,
    "q80_stream_status": "SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS since FROM events GROUP BY 1",
    "q105_stream_choices": """
        WITH RECURSIVE c AS (SELECT p_partkey % 2 AS dataset, p_type AS field, count(*) FILTER (p_size < 9) AS size FROM part GROUP BY ALL),
        l AS (SELECT dataset, list(field ORDER BY field) AS fields, list(size ORDER BY field) AS sizes, sum(size)::DOUBLE AS total FROM c GROUP BY 1),
        d AS (SELECT user_id, event_id, CASE WHEN value > 50 THEN 1.0 WHEN value > 10 THEN 0.5 END::DOUBLE AS score, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
        s AS (
          SELECT u.user_id, 0::BIGINT AS k, fields, sizes, total, list_transform(fields, lambda f: 0::BIGINT) AS n, list_transform(fields, lambda f: 0::BIGINT) AS m,
                 list_transform(fields, lambda f: 0::DOUBLE) AS sums, NULL::BIGINT AS event_id, NULL::BIGINT AS g, NULL::BIGINT AS item, NULL::DOUBLE AS accuracy
          FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN l ON l.dataset = u.user_id % 3
          UNION ALL
          SELECT user_id, k, fields, sizes, total,
                 list_transform(n, lambda x, i: x + CASE WHEN i = g THEN 1 ELSE 0 END), list_transform(m, lambda x, i: x + CASE WHEN i = g AND score IS NOT NULL THEN 1 ELSE 0 END),
                 list_transform(sums, lambda x, i: x + CASE WHEN i = g THEN coalesce(score, 0) ELSE 0 END), event_id, g, n[g], (sums[g] + 1) / (m[g] + 2)
          FROM (SELECT *, list_position(scores, list_max(list_filter(scores, lambda x: x > -1e9))) AS g FROM (
            SELECT s.user_id, s.k + 1 AS k, fields, sizes, total, n, m, sums, d.event_id, d.score,
                   list_transform(sizes, lambda size, i: CASE WHEN n[i] >= size THEN -1e10 ELSE round(0.5 / len(sizes) + 0.5 * size / total - n[i] / greatest(list_sum(n), 1)::DOUBLE
                     + 0.25 * sqrt(2 * ln(greatest(list_sum(n), 2)) / (m[i] + 1)), 9) END) AS scores
            FROM s JOIN d ON d.user_id = s.user_id AND d.k = s.k + 1))
        )
        SELECT user_id, event_id, fields[g] AS field, item, round(accuracy, 6) AS accuracy FROM s WHERE k > 0
    """,
    "q106_stream_continuation": """
        WITH f AS (SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1)
        SELECT user_id, event_id, event_type, CASE WHEN event_id < (SELECT max(event_id) / 2 FROM events) THEN 1 ELSE 2 END AS run FROM f JOIN events USING (user_id, event_id)
    """,
}
