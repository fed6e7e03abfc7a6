"""Nested and semi-structured records, model responses, token spans and confidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import confidence, jobs, nested, responses
from quillspark.sources.tables import table


def q30_text_page_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.lines(table(spark, sf_dir, "documents").select("doc_id", "text"), "text").select("doc_id", "line_number", "line")


def q31_conversation_nested_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = nested.gathered(table(spark, sf_dir, "conversations"), "conv_id", "turn", ["role", "text"], "page_lines")
    return nested.page_lines(held).select("conv_id", "page_line_number", "turn", "role", "text")


def q32_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "long")
    return table(spark, sf_dir, "events").select(k.alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


def q33_variant_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    record = F.to_json(F.struct(F.col("p_partkey").alias("id"), F.struct(F.col("p_brand").alias("brand"), F.struct(F.col("p_size").alias("size"), F.col("p_type").alias("type")).alias("body")).alias("part"), F.array("p_size", "p_size").alias("sizes")))
    leaves = nested.variant_leaves(part.select("p_partkey", F.parse_json(record).alias("v")), "p_partkey", "v", depth=3)
    return leaves.select("key", "path", "value")


def q34_record_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction lines built from events: some malformed, keyless, failed, empty, or with answers that are no objects."""
    e = F.col("event_id")
    key = F.concat(F.lit("k"), (e % 997).cast("string"))
    answer = lambda text: F.concat(F.lit('{"key":"'), key, F.lit('","response":{"candidates":[{"avgLogprobs":-0.25,"content":{"parts":[{"text":"hm","thought":true},{"text":"'), F.lit(text), F.lit('"}]}}]}}'))
    line = (
        F.when(e % 11 == 0, F.lit("{broken")).when(e % 11 == 1, F.lit("[1]")).when(e % 11 == 2, F.lit('{"response":{}}')).when(e % 11 == 3, F.concat(F.lit('{"key":"'), key, F.lit('","error":{"code":5}}')))
        .when(e % 11 == 4, F.concat(F.lit('{"key":"'), key, F.lit('"}'))).when(e % 11 == 5, answer("  ")).when(e % 11 == 6, answer("[2]")).otherwise(answer('{\\"a\\":1}'))
    )
    lines = table(spark, sf_dir, "events").select("event_id", line.alias("line"))
    selected, rejected = responses.collected(lines, "line", ["event_id"])
    got = selected.groupBy(F.lit("valid").alias("reason"), F.col("text"), F.round("mean_logprob", 6).alias("logprob")).agg(F.count(F.lit(1)).alias("n"))
    lost = rejected.groupBy("reason").agg(F.sum("n").alias("n")).select("reason", F.lit(None).cast("string").alias("text"), F.lit(None).cast("double").alias("logprob"), "n")
    return got.unionByName(lost)


def q39_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "benchmark").select("item_id", F.posexplode(F.split("text", " ")).alias("place", "token"))
    return confidence.token_spans(tokens, "item_id", "place", "token").select("item_id", F.col("place").cast("long").alias("place"), "start", "stop")


def q40_interval_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "benchmark").select("item_id", F.posexplode(F.split("text", " ")).alias("place", "token"))
    spans = confidence.token_spans(tokens, "item_id", "place", "token")
    leaves = tokens.groupBy("item_id").agg(F.sum(F.char_length("token")).alias("size")).select("item_id", F.explode(F.sequence(F.lit(0), F.floor(F.col("size") / 17))).alias("leaf"))
    leaves = leaves.select("item_id", "leaf", (F.col("leaf") * 17).alias("start"), (F.col("leaf") * 17 + 17).alias("stop"))
    return confidence.widest_overlap(spans, leaves, "item_id", "place").select("item_id", F.col("place").cast("long").alias("place"), "leaf", F.col("overlap").cast("long").alias("overlap"))


def q41_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.explode("embedding").alias("e")).select("vec_id", F.col("label").cast("string").alias("leaf"), (-F.abs(F.col("e").cast("double"))).alias("logprob"))
    out = confidence.leaf_confidence(each, "vec_id", "leaf", "logprob")
    return out.select("vec_id", "leaf", F.round("logprob", 6).alias("logprob"), F.round("ratio", 6).alias("ratio"))


def q44_state_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", F.when(F.col("o_orderkey") % 7 == 0, "JOB_STATE_FAILED").otherwise("x.JOB_STATE_SUCCEEDED")).when(F.col("o_orderstatus") == "O", "JOB_STATE_SUCCEEDED").otherwise("RUNNING")
    rolled = jobs.state_rollup(table(spark, sf_dir, "orders").select("o_custkey", status.alias("status")), "o_custkey", "status")
    return rolled.groupBy("state").agg(F.count(F.lit(1)).alias("jobs"), F.sum("n").alias("chunks"))


def q58_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count_if(F.col("o_orderstatus") == "F").alias("succeeded"), F.count_if(F.col("o_orderstatus") == "P").alias("errored"), F.count(F.lit(1)).alias("total"))
    return jobs.progress(one, ["succeeded", "errored"], "total").select("o_orderpriority", "processed", "ratio", "line")


QUERIES = {f.__name__: f for f in (q30_text_page_explode, q31_conversation_nested_roundtrip, q32_json_props, q33_variant_flatten, q34_record_classifier, q39_token_spans, q40_interval_attribution, q41_confidence, q44_state_rollup, q58_progress)}

_SPANS = """t AS (SELECT item_id, unnest(string_split(text, ' ')) AS token, generate_subscripts(string_split(text, ' '), 1) - 1 AS place FROM benchmark),
    s AS (SELECT item_id, place, token, CAST(coalesce(sum(length(token)) OVER (PARTITION BY item_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM t)"""
ORACLE_SQL = {
    "q30_text_page_explode": "SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS line_number, unnest(string_split(text, chr(10))) AS line FROM documents",
    "q31_conversation_nested_roundtrip": "SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS page_line_number, turn, role, text FROM conversations",
    "q32_json_props": "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1",
    "q33_variant_flatten": """
        SELECT p_partkey AS key, unnest(['id', 'part.brand', 'part.body.size', 'part.body.type', 'sizes']) AS path,
               unnest([CAST(p_partkey AS VARCHAR), p_brand, CAST(p_size AS VARCHAR), p_type, '[' || p_size || ',' || p_size || ']']) AS value FROM part
    """,
    "q34_record_classifier": """
        WITH e AS (SELECT event_id, event_id % 11 AS m, 'k' || event_id % 997 AS k FROM events),
        r AS (SELECT CASE WHEN m <= 2 THEN CASE m WHEN 0 THEN '<line:' || event_id || '>' ELSE '<line:' || event_id || '>' END ELSE k END AS key,
                     CASE m WHEN 0 THEN 'invalid_jsonl_line' WHEN 1 THEN 'invalid_record_type' WHEN 2 THEN 'missing_key' WHEN 3 THEN 'batch_error' WHEN 4 THEN 'missing_response'
                            WHEN 5 THEN 'empty_response_text' WHEN 6 THEN 'schema_validation_failed' ELSE 'valid' END AS reason FROM e),
        ok AS (SELECT DISTINCT key FROM r WHERE reason = 'valid')
        SELECT 'valid' AS reason, '{"a":1}' AS text, -0.25 AS logprob, count(*) AS n FROM ok
        UNION ALL SELECT reason, NULL, NULL, count(*) FROM r WHERE key NOT IN (SELECT key FROM ok) GROUP BY 1
    """,
    "q39_token_spans": f"WITH {_SPANS} SELECT item_id, place, start, start + length(token) AS stop FROM s",
    "q40_interval_attribution": f"""
        WITH {_SPANS}, l AS (SELECT item_id, unnest(range(0, CAST(sum(length(token)) // 17 + 1 AS BIGINT))) AS leaf FROM t GROUP BY 1),
        m AS (SELECT s.item_id, s.place, l.leaf, least(s.start + length(s.token), l.leaf * 17 + 17) - greatest(s.start, l.leaf * 17) AS overlap FROM s JOIN l USING (item_id))
        SELECT item_id, place, leaf, CAST(overlap AS BIGINT) AS overlap FROM m WHERE overlap > 0 QUALIFY row_number() OVER (PARTITION BY item_id, place ORDER BY overlap DESC, leaf) = 1
    """,
    "q41_confidence": """
        WITH u AS (SELECT vec_id, CAST(label AS VARCHAR) AS leaf, -abs(CAST(unnest(embedding) AS DOUBLE)) AS e FROM embeddings)
        SELECT vec_id, leaf, round(avg(e), 6) AS logprob, round(exp(avg(e)), 6) AS ratio FROM u GROUP BY 1, 2
    """,
    "q44_state_rollup": """
        WITH s AS (SELECT o_custkey, o_orderstatus IN ('F', 'O') AS done, o_orderstatus = 'F' AND o_orderkey % 7 = 0 AS failed FROM orders),
        r AS (SELECT o_custkey, count(*) AS n, CASE WHEN bool_and(done) THEN CASE WHEN bool_or(failed) THEN 'failed' ELSE 'succeeded' END ELSE 'running' END AS state FROM s GROUP BY 1)
        SELECT state, count(*) AS jobs, CAST(sum(n) AS BIGINT) AS chunks FROM r GROUP BY 1
    """,
    "q58_progress": """
        WITH o AS (SELECT o_orderpriority, count(*) FILTER (o_orderstatus IN ('F', 'P')) AS processed, count(*) AS total FROM orders GROUP BY 1)
        SELECT o_orderpriority, processed, round(processed / total, 6) AS ratio, printf('%d/%d (%.2f%%)', processed, total, processed / total * 100) AS line FROM o
    """,
}
