"""From model responses to rows with the confidence of every field."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import confidence, rows
from quillspark.sources.tables import table

ANSWER = "struct<priority:string,customer:struct<id:long>,lines:array<string>,note:string>"


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """o_orderkey and a response in VARIANT: an answer in JSON, and its tokens of five letters, which begin with other text of
    unlike lengths. Every seventh has no tokens; the tokens of every eleventh are of another text."""
    k = F.col("o_orderkey")
    payload = F.concat(F.lit('{"priority":"'), F.col("o_orderpriority"), F.lit('","customer":{"id":'), F.col("o_custkey").cast("string"), F.lit('},"lines":["'), F.col("o_orderstatus"), F.lit('","'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('"],"note":""}'))
    said = F.concat(F.when(k % 3 == 0, "``` json\n").when(k % 3 == 1, F.repeat(F.lit(" "), (k % 13).cast("int"))).otherwise("äh: "), F.when(k % 11 == 0, F.lit("{}")).otherwise(payload), F.lit("\n```"))
    place = F.sequence(F.lit(0), F.floor((F.char_length(said) - 1) / 5).cast("int"))
    token = lambda i: F.struct(F.substring(said, i * 5 + 1, F.lit(5)).alias("token"), (-((k + i) % 8) / 16).alias("logProbability"))
    chosen = F.when(k % 7 != 0, F.struct(F.transform(place, token).alias("chosenCandidates")))
    parts = F.array(F.struct(F.lit("so it is").alias("text"), F.lit(True).alias("thought")), F.struct(F.concat(F.lit("\n"), payload, F.lit(" ")).alias("text"), F.lit(None).cast("boolean").alias("thought")))
    candidate = F.struct(F.struct(parts.alias("parts")).alias("content"), F.lit(-0.25).alias("avgLogprobs"), chosen.alias("logprobsResult"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.parse_json(F.to_json(F.struct(F.array(candidate).alias("candidates")))).alias("response"))


def q103_field_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of answers, with the confidence of each field in the fields' shape."""
    held = confidence.with_response_metadata(_responses(spark, sf_dir), "response")
    answers = held.select(F.from_json("text", ANSWER).alias("answer"), F.concat(F.lit("orders/"), F.col("o_orderkey").cast("string"), F.lit(".png")).alias("reference"), "field_confidence_by_pointer")
    out = rows.rows_of("Order", answers, "answer", "reference", "field_confidence_by_pointer")
    sure = lambda path, f="field_confidence_logprobs": F.round(F.col(f"field_confidence.{path}.{f}"), 6)
    line = lambda k: F.round(F.try_element_at("field_confidence.lines", F.lit(k))["field_confidence_ratio"], 6)
    return out.select(
        "image_name", "priority", F.col("customer.id").alias("customer"), sure("priority").alias("priority_logprob"), sure("priority", "field_confidence_ratio").alias("priority_ratio"),
        sure("customer.id").alias("customer_logprob"), line(1).alias("status_ratio"), line(2).alias("date_ratio"), sure("note").alias("note_logprob"),
    )


def q104_response_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What else a response says, and how many leaves have a confidence."""
    held = confidence.with_response_metadata(_responses(spark, sf_dir), "response")
    return held.groupBy("thoughts", "avg_logprobs", F.size("field_confidence_by_pointer").alias("leaves"), F.size(F.filter(F.map_values("field_confidence_by_pointer"), lambda v: v["field_confidence_ratio"].isNotNull())).alias("known")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("text")).alias("characters"))


QUERIES = {f.__name__: f for f in (q103_field_confidence, q104_response_metadata)}

_LAID = """
    p AS (SELECT o_orderkey AS k, o_orderpriority AS priority, o_custkey AS customer, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d') AS d,
                 '{"priority":"' || o_orderpriority || '","customer":{"id":' || o_custkey || '},"lines":["' || o_orderstatus || '","' || strftime(o_orderdate, '%Y-%m-%d') || '"],"note":""}' AS payload FROM orders),
    h AS (SELECT *, CASE k % 3 WHEN 0 THEN '``` json' || chr(10) WHEN 1 THEN repeat(' ', k % 13) ELSE 'äh: ' END AS head FROM p),
    t AS (SELECT *, length(head) AS o, length(head || payload || chr(10) || '```') AS size FROM h WHERE k % 7 <> 0 AND k % 11 <> 0),
    tokens AS (SELECT k, i, greatest(0, 5 * i - o) AS a, least(length(payload), least(5 * i + 5, size) - o) AS b, -((k + i) % 8) / 16 AS lp FROM (SELECT *, unnest(range(0, (size - 1) // 5 + 1)) AS i FROM t)),
    l1 AS (SELECT k, 13 AS a1, 13 + length(priority) AS b1, length(priority) AS np, length(customer::VARCHAR) AS nc, length(status) AS ns, length(d) AS nd FROM t),
    l2 AS (SELECT *, b1 + 19 AS a2, b1 + 19 + nc AS b2 FROM l1),
    l3 AS (SELECT *, b2 + 12 AS a3, b2 + 12 + ns AS b3 FROM l2),
    leaves AS (SELECT k, unnest([1, 2, 3, 4]) AS leaf, unnest([a1, a2, a3, b3 + 3]) AS s, unnest([b1, b2, b3, b3 + 3 + nd]) AS e FROM l3),
    met AS (SELECT x.k, i, lp, leaf, least(b, e) - greatest(a, s) AS w FROM tokens x JOIN leaves y ON x.k = y.k AND a < b AND least(b, e) > greatest(a, s)),
    best AS (SELECT * FROM met QUALIFY row_number() OVER (PARTITION BY k, i ORDER BY w DESC, leaf) = 1),
    means AS (SELECT k, leaf, avg(lp) AS lp FROM best GROUP BY ALL),
    wide AS (SELECT k, max(lp) FILTER (leaf = 1) AS m1, max(lp) FILTER (leaf = 2) AS m2, max(lp) FILTER (leaf = 3) AS m3, max(lp) FILTER (leaf = 4) AS m4, count(*) AS known FROM means GROUP BY k)"""
ORACLE_SQL = {
    "q103_field_confidence": f"""
        WITH {_LAID}
        SELECT p.k || '.png' AS image_name, priority, customer, round(m1, 6) AS priority_logprob, round(exp(m1), 6) AS priority_ratio, round(m2, 6) AS customer_logprob,
               round(exp(m3), 6) AS status_ratio, round(exp(m4), 6) AS date_ratio, CAST(NULL AS DOUBLE) AS note_logprob FROM p LEFT JOIN wide USING (k)
    """,
    "q104_response_metadata": f"""
        WITH {_LAID}
        SELECT 'so it is' AS thoughts, -0.25::DOUBLE AS avg_logprobs, CASE WHEN known IS NULL THEN 0 ELSE 5 END AS leaves, coalesce(known, 0)::INTEGER AS known, count(*) AS n, CAST(sum(length(payload)) AS BIGINT) AS characters
        FROM p LEFT JOIN wide USING (k) GROUP BY ALL
    """,
}
