"""Accuracy of validation decisions, in the report's and the dashboard's conventions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import blank_to_null, top_level
from quillspark.functions.values import LABELS, dashboard_score, label_class, report_score


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """label, n: decisions by canonical label; labels without decisions count 0, unknown ones are dropped."""
    spark = df.sparkSession
    names = spark.createDataFrame([(n,) for n in LABELS], "label string")
    counted = df.groupBy(label_class(F.col(label)).alias("_label")).agg(F.count(F.lit(1)).alias("k"))
    return names.join(counted, F.col("label") == F.col("_label"), "left").select("label", F.coalesce("k", F.lit(0)).alias("n"))


def report_accuracy(df: DataFrame, label: str) -> DataFrame:
    """One row: n scored decisions and their accuracy by the report's convention."""
    s = report_score(F.col(label))
    return df.agg(F.count(s).alias("n"), F.round(F.avg(s), 6).alias("accuracy"))


def grouped_accuracy(df: DataFrame, label: str, column: str, least: int = 1) -> DataFrame:
    """top_level, n, accuracy: report accuracy by the first segment of a dotted name, best first, ties by name."""
    s = report_score(F.col(label))
    out = df.where(s.isNotNull()).groupBy(top_level(F.col(column)).alias("top_level")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(s), 6).alias("accuracy")).where(F.col("n") >= least)
    return out.orderBy(F.desc("accuracy"), "top_level")


def nested_accuracy(df: DataFrame, label: str, column: str, least: int = 1) -> DataFrame:
    """top_level, column_name (null for the whole), n, accuracy: both levels in one rollup."""
    s = report_score(F.col(label))
    held = df.where(s.isNotNull()).select(top_level(F.col(column)).alias("top_level"), F.col(column).alias("column_name"), s.alias("s"))
    sets = held.groupingSets([[F.col("top_level")], [F.col("top_level"), F.col("column_name")]], F.col("top_level"), F.col("column_name"))
    return sets.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("s"), 6).alias("accuracy")).where(F.col("n") >= least)


def metric_summary(df: DataFrame, label: str, column: str) -> DataFrame:
    """metric, decisions, one count a label, accuracy (percent, half-even to one digit): the dashboard's table.

    A blank column is ``(unknown)``; best first, metrics without a score last, then by decisions and name.
    """
    c, s = label_class(F.col(label)), dashboard_score(F.col(label))
    out = df.groupBy(F.coalesce(blank_to_null(F.col(column)), F.lit("(unknown)")).alias("metric")).agg(
        F.count(F.lit(1)).alias("decisions"), *[F.count_if(c == n).alias(n) for n in LABELS], F.bround(F.avg(s) * 100, 1).alias("accuracy")
    )
    return out.orderBy(F.col("accuracy").desc_nulls_last(), F.desc("decisions"), "metric")


def run_summary(df: DataFrame, run: str, label: str, seq: str, first: dict[str, str]) -> DataFrame:
    """A row a run: decisions, accuracy, and for each entry of ``first`` (new name: column) the run's first non-blank value."""
    s = dashboard_score(F.col(label))
    firsts = [F.coalesce(F.min_by(c, F.when(blank_to_null(F.col(c).cast("string")).isNotNull(), F.col(seq))).cast("string"), F.lit("unknown")).alias(n) for n, c in first.items()]
    return df.groupBy(run).agg(F.count(F.lit(1)).alias("decisions"), F.bround(F.avg(s) * 100, 1).alias("accuracy"), *firsts)
