"""Validation decisions: line items are decisions, with labels drawn from their flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import sampling, scoring
from quillspark.sources.tables import table


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("l_returnflag") == "A", "Accept").when(F.col("l_returnflag") == "R", F.when(F.col("l_linenumber") == 1, "correction").otherwise("reject"))
    label = label.when(F.col("l_linenumber") == 2, "partial").when(F.col("l_linenumber") == 3, "other").otherwise("somewhat-accept")
    column = F.concat_ws(".", F.concat(F.lit("group_"), (F.col("l_suppkey") % 7).cast("string")), F.concat(F.lit("field_"), (F.col("l_partkey") % 3).cast("string")))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", label.alias("label"), F.when(F.col("l_suppkey") % 11 == 0, " ").otherwise(column).alias("column_name"))


def q22_label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.label_distribution(decisions(spark, sf_dir), "label")


def q23_report_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = decisions(spark, sf_dir)
    grouped = scoring.grouped_accuracy(held, "label", "column_name", least=20)
    return grouped.unionByName(scoring.report_accuracy(held, "label").withColumn("top_level", F.lit("(all)")))


def q24_nested_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.nested_accuracy(decisions(spark, sf_dir), "label", "column_name", least=20)


def q25_dashboard_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.metric_summary(decisions(spark, sf_dir), "label", "column_name")


def q26_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = decisions(spark, sf_dir).withColumns({"run": F.col("l_orderkey") % 50, "seq": F.col("l_orderkey") * 100000000 + F.col("l_linenumber") * 10000000 + F.col("l_partkey")})
    held = held.withColumn("validator", F.when(F.col("l_partkey") % 3 == 0, F.col("l_partkey").cast("string")))
    # Rows that tie on seq are the same part, so the first value is the same whichever comes first.
    return scoring.run_summary(held, "run", "label", "seq", {"validator_id": "validator"})


def q38_ucb_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = decisions(spark, sf_dir).groupBy(F.col("column_name").alias("field")).agg(F.count(F.lit(1)).alias("size"), F.count_if(F.col("l_linenumber") == 1).alias("selected"), F.count_if((F.col("l_linenumber") == 1) & (F.col("label") != "other")).alias("scored"))
    out = sampling.ucb_scores(state)
    return out.select("field", "size", "selected", "scored", *[F.round(c, 6).alias(c) for c in ("quota", "deficit", "uncertainty", "score")])


def q57_exact_sample_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    drawn = sampling.exact_sample(documents.select("doc_id"), F.col("doc_id"), 0.125)
    return drawn.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("distinct_ids"))


QUERIES = {f.__name__: f for f in (q22_label_distribution, q23_report_accuracy, q24_nested_accuracy, q25_dashboard_accuracy, q26_run_summary, q38_ucb_scores, q57_exact_sample_size)}

_D = """d AS (SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_returnflag = 'A' THEN 'Accept' WHEN l_returnflag = 'R' THEN CASE WHEN l_linenumber = 1 THEN 'correction' ELSE 'reject' END
         WHEN l_linenumber = 2 THEN 'partial' WHEN l_linenumber = 3 THEN 'other' ELSE 'somewhat-accept' END AS label,
    CASE WHEN l_suppkey % 11 = 0 THEN ' ' ELSE 'group_' || l_suppkey % 7 || '.field_' || l_partkey % 3 END AS column_name FROM lineitem),
c AS (SELECT *, CASE label WHEN 'Accept' THEN 'accepted' WHEN 'reject' THEN 'rejected' WHEN 'correction' THEN 'corrected' WHEN 'partial' THEN 'somewhat' WHEN 'somewhat-accept' THEN 'somewhat' END AS k FROM d),
s AS (SELECT *, CASE WHEN k IN ('accepted', 'somewhat') THEN 1.0 WHEN k IN ('rejected', 'corrected', 'unsure') THEN 0.0 END AS r,
             CASE k WHEN 'accepted' THEN 1.0::DOUBLE WHEN 'somewhat' THEN 0.5::DOUBLE WHEN 'rejected' THEN 0.0::DOUBLE WHEN 'corrected' THEN 0.0::DOUBLE END AS b FROM c)"""
ORACLE_SQL = {
    "q22_label_distribution": f"WITH {_D}, l AS (SELECT unnest(['accepted', 'somewhat', 'rejected', 'corrected', 'unsure']) AS label) SELECT l.label, count(c.k) AS n FROM l LEFT JOIN c ON l.label = c.k GROUP BY 1",
    "q23_report_accuracy": f"""
        WITH {_D} SELECT regexp_extract(column_name, '^[^.]*') AS top_level, count(r) AS n, round(avg(r), 6) AS accuracy FROM s WHERE r IS NOT NULL GROUP BY 1 HAVING count(*) >= 20
        UNION ALL SELECT '(all)', count(r), round(avg(r), 6) FROM s
    """,
    "q24_nested_accuracy": f"""
        WITH {_D}, t AS (SELECT regexp_extract(column_name, '^[^.]*') AS top_level, column_name, r FROM s WHERE r IS NOT NULL)
        SELECT top_level, column_name, count(*) AS n, round(avg(r), 6) AS accuracy FROM t GROUP BY GROUPING SETS ((top_level), (top_level, column_name)) HAVING count(*) >= 20
    """,
    "q25_dashboard_accuracy": f"""
        WITH {_D} SELECT coalesce(nullif(trim(column_name), ''), '(unknown)') AS metric, count(*) AS decisions, {", ".join(f"count(*) FILTER (k = '{k}') AS {k}" for k in ("accepted", "somewhat", "rejected", "corrected", "unsure"))},
               round_even(avg(b) * 100, 1) AS accuracy FROM s GROUP BY 1
    """,
    "q26_run_summary": f"""
        WITH {_D} SELECT l_orderkey % 50 AS run, count(*) AS decisions, round_even(avg(b) * 100, 1) AS accuracy,
               coalesce(CAST(arg_min(l_partkey, l_orderkey * 100000000 + l_linenumber * 10000000 + l_partkey) FILTER (l_partkey % 3 = 0) AS VARCHAR), 'unknown') AS validator_id FROM s GROUP BY 1
    """,
    "q38_ucb_scores": f"""
        WITH {_D}, f AS (SELECT column_name AS field, count(*) AS size, count(*) FILTER (l_linenumber = 1) AS selected, count(*) FILTER (l_linenumber = 1 AND label <> 'other') AS scored FROM d GROUP BY 1),
        t AS (SELECT *, count(*) OVER () AS g, CAST(sum(size) OVER () AS DOUBLE) AS n, CAST(sum(selected) OVER () AS DOUBLE) AS t FROM f),
        q AS (SELECT *, 0.5 / g + 0.5 * size / n AS q, sqrt(2 * ln(greatest(t, 2)) / (scored + 1)) AS u FROM t)
        SELECT field, size, selected, scored, round(q, 6) AS quota, round(q - selected / greatest(t, 1), 6) AS deficit, round(u, 6) AS uncertainty, round(q - selected / greatest(t, 1) + 0.25 * u, 6) AS score FROM q
    """,
    "q57_exact_sample_size": "SELECT CAST(greatest(1, least(count(*), round_even(count(*) * 0.125, 0))) AS BIGINT) AS n, CAST(greatest(1, least(count(*), round_even(count(*) * 0.125, 0))) AS BIGINT) AS distinct_ids FROM documents",
}
