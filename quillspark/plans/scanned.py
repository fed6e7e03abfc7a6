"""Readers, restrictions and small operators over written copies of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions import json_spans, schema, text
from quillspark.operators import coverage, nested, rows
from quillspark.plans.reported import _folder
from quillspark.sources import files
from quillspark.sources.tables import table


def q125_restrictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose identity is among names: of a table, of none given (all or none stay), and of an empty one."""
    ref = F.concat(F.lit(" gs://b/p/"), F.col("o_custkey").cast("string"), F.lit(".png "))
    orders = table(spark, sf_dir, "orders").withColumn("name", text.identity(F.when(F.col("o_orderkey") % 13 != 0, ref)))
    names = table(spark, sf_dir, "customer").where("c_nationkey < 12").select(F.concat(F.col("c_custkey").cast("string"), F.lit(".png")).alias("n"))
    cases = {"some": (names, True), "all": (None, True), "none": (None, False), "empty": (names.limit(0), True)}
    out = None
    for what, (given, keeps) in cases.items():
        one = coverage.restrict(orders, given, F.col("name"), "n", keeps).agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last")).withColumn("what", F.lit(what))
        out = one if out is None else out.unionByName(one)
    return out


def q126_leaf_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the leaves of JSON answers begin and end, in answers with white space, escapes and nesting; broken ones have none."""
    k, name = F.col("p_partkey"), F.col("p_name")
    answer = F.concat(F.repeat(F.lit(" "), (k % 3).cast("int")), F.lit('{"a~b":"'), name, F.lit('", "c": [ '), k.cast("string"), F.lit(',true],"d/e":{"f":"\\"x"}}'), F.when(k % 10 == 0, "}").otherwise(""))
    each = table(spark, sf_dir, "part").select("p_partkey", F.explode(json_spans.spans(answer)).alias("s"))
    return each.select("p_partkey", "s.leaf", "s.start", "s.stop")


def q127_delimited_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a set delimited by dollar signs, with quotes and empty cells, read as texts, and its rows counted."""
    path, k = _folder(spark, "q127"), F.col("c_custkey")
    written = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 4 == 0, 'a$b "c"').when(k % 4 == 1, "").otherwise(F.col("c_name")).alias("name"), F.col("c_acctbal").cast("string").alias("balance"))
    written.write.option("escape", '"').option("emptyValue", "").csv(path, header=True, sep="$")
    read = files.delimited(spark, path)
    n = files.row_count(spark, path, "csv")
    return read.groupBy(F.when(F.col("c_custkey").cast("long") % 4 == 0, F.col("name")).otherwise((F.coalesce(F.col("name"), F.lit("")) == "").cast("string")).alias("name")).agg(F.count(F.lit(1)).alias("n"), F.count("balance").alias("balances")).withColumn("rows", F.lit(n))


def q128_line_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests, a tree of them, prediction lines with their numbers, and a strict batch manifest, written and read."""
    path, k = _folder(spark, "q128"), F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders")
    line = F.when(k % 6 == 0, "{broken").when(k % 6 == 1, "").otherwise(F.concat(F.lit('{"n":'), k.cast("string"), F.lit("}")))
    orders.select(F.col("o_orderpriority").substr(1, 1).alias("run"), line.alias("value")).write.partitionBy("run").text(f"{path}/tree")
    sum_of = F.sum(F.try_variant_get("value", "$.n", "long"))
    tree = files.manifests(spark, f"{path}/tree", "part-*").agg(F.count(F.lit(1)).alias("n"), sum_of.alias("total"), F.count_distinct(F.regexp_extract("manifest_path", "run=([0-9])", 1)).alias("runs")).withColumn("what", F.lit("tree"))
    known = files.processing_records(spark, f"{path}/tree").agg(F.count(F.lit(1)).alias("n"), sum_of.alias("total"), F.lit(0).cast("long").alias("runs")).withColumn("what", F.lit("records"))
    lines = files.prediction_lines(spark, f"{path}/tree").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("line") > 0).alias("total"), F.lit(0).cast("long").alias("runs")).withColumn("what", F.lit("lines"))
    entry = F.concat(F.lit('{"key":" k'), k.cast("string"), F.lit('","custom_id":"id-'), k.cast("string"), F.when(k % 2 == 0, '","mime_type":"image/png"}').otherwise('"}'))
    orders.select(entry.alias("value")).write.text(f"{path}/batch")
    batch = files.batch_manifest(spark, f"{path}/batch").agg(F.count_if(F.col("mime_type") == "image/png").alias("n"), F.sum(F.char_length("key")).alias("total"), F.count_distinct("custom_id").alias("runs")).withColumn("what", F.lit("batch"))
    return tree.unionByName(known).unionByName(lines).unionByName(batch)


def q129_year_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a mapping of numbers to years with odd headings and cells; the last row of a number counts."""
    path, k = _folder(spark, "q129"), F.col("s_suppkey")
    held = table(spark, sf_dir, "supplier").repartitionByRange("s_suppkey").sortWithinPartitions("s_suppkey")
    held.select((k % 7).cast("string").alias(" SBID"), "s_name", F.when(k % 5 == 0, "x").otherwise((k + 1880).cast("string")).alias("Year ")).coalesce(1).write.csv(path, header=True, sep=";")
    return files.year_lookup(spark, path)


def q130_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections typed by their field, where the schema has it: a number, a day, a text; flattened rows of the same."""
    kind = rows.resolved(" order ", {"Order": T.StructType().add("total", T.DoubleType()).add("of", T.StructType().add("day", T.DateType()).add("lines", T.ArrayType(T.StructType().add("n", T.LongType()))))})
    paths, k = schema.schema_paths(kind), F.col("o_orderkey")
    asked = F.element_at(F.array(*map(F.lit, ["total", "of.day", "of.lines.n", "of.other", "of"])), (k % 5 + 1).cast("int"))
    said = F.when(k % 3 == 0, " ").when(k % 5 == 0, F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(".5 "))).when(k % 5 == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("odd")
    held = table(spark, sf_dir, "orders").select(asked.alias("path"), said.alias("said"), F.struct("o_custkey", F.struct("o_orderstatus").alias("of")).alias("row"))
    flat = nested.flattened(held)
    typed = F.when(F.col("path") == "total", schema.corrected(F.col("said"), "double").cast("string")).when(F.col("path") == "of.day", schema.corrected(F.col("said"), "date").cast("string"))
    return flat.groupBy("path", F.col("path").isin(paths).alias("known"), F.col("`row.of.o_orderstatus`").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.count(typed).alias("typed"), F.max("`row.o_custkey`").alias("most"))


def q131_set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers with orders, with big ones, with neither, as sets: in both, in one, in any; first copies of a union."""
    orders = table(spark, sf_dir, "orders")
    a, b = orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")), orders.where("o_totalprice > 200000").select(F.col("o_custkey").alias("k"))
    status = coverage.keyed_status(a, b, "k").groupBy(F.col("status").alias("what")).agg(F.count(F.lit(1)).alias("n"), F.max("key").alias("last"))
    named = {"both": a.intersect(b), "any": a.union(b).distinct(), "only first": coverage.missing_keys(a, b, "k")}
    for what, df in named.items():
        status = status.unionByName(df.withColumn("what", F.lit(what)).groupBy("what").agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("last")))
    both = files.united({"f": a.withColumn("x", F.lit(1)), "big": b})
    return status.unionByName(both.groupBy(F.concat(F.lit("from "), "_source").alias("what")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("x", F.lit(0))).alias("last")))


QUERIES = {f.__name__: f for f in (q125_restrictions, q126_leaf_spans, q127_delimited_sets, q128_line_sets, q129_year_lookup, q130_corrections, q131_set_operations)}

ORACLE_SQL = {
    "q125_restrictions": """
        SELECT 'some' AS what, count(*) AS n, max(o_orderkey) AS last FROM orders WHERE o_orderkey % 13 <> 0 AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12)
        UNION ALL SELECT 'all', count(*), max(o_orderkey) FROM orders UNION ALL SELECT 'none', 0, NULL UNION ALL SELECT 'empty', 0, NULL
    """,
    "q126_leaf_spans": """
        WITH p AS (SELECT p_partkey, p_partkey % 3 + 8 AS a, length(p_name) AS n, length(CAST(p_partkey AS VARCHAR)) AS d FROM part WHERE p_partkey % 10 <> 0)
        SELECT p_partkey, unnest(['/a~0b', '/c/0', '/c/1', '/d~1e/f']) AS leaf, unnest([a, a + n + 10, a + n + 11 + d, a + n + 30 + d - 1]) AS start, unnest([a + n, a + n + 10 + d, a + n + 15 + d, a + n + 32 + d]) AS stop FROM p
    """,
    "q127_delimited_sets": """
        SELECT CASE WHEN c_custkey % 4 = 0 THEN 'a$b "c"' WHEN c_custkey % 4 = 1 THEN 'true' ELSE 'false' END AS name, count(*) AS n, count(c_acctbal) AS balances, (SELECT count(*)::INTEGER FROM customer) AS rows FROM customer GROUP BY 1
    """,
    "q128_line_sets": """
        WITH g AS (SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS total, count(DISTINCT left(o_orderpriority, 1)) AS runs FROM orders WHERE o_orderkey % 6 > 1)
        SELECT 'tree' AS what, * FROM g UNION ALL SELECT 'records', n, total, 0 FROM g UNION ALL SELECT 'lines', count(*), count(*), 0 FROM orders WHERE o_orderkey % 6 <> 1
        UNION ALL SELECT 'batch', count(*) FILTER (o_orderkey % 2 = 0), CAST(sum(length(CAST(o_orderkey AS VARCHAR)) + 1) AS BIGINT), count(DISTINCT o_orderkey) FROM orders
    """,
    "q129_year_lookup": "SELECT s_suppkey % 7 AS sbid, CAST(arg_max(s_suppkey + 1880, s_suppkey) AS INTEGER) AS year FROM supplier WHERE s_suppkey % 5 <> 0 GROUP BY 1",
    "q130_corrections": """
        SELECT ['total', 'of.day', 'of.lines.n', 'of.other', 'of'][o_orderkey % 5 + 1] AS path, o_orderkey % 5 <> 3 AS known, o_orderstatus AS status, count(*) AS n, count(*) FILTER (o_orderkey % 3 <> 0 AND o_orderkey % 5 < 2) AS typed, max(o_custkey) AS most
        FROM orders GROUP BY ALL
    """,
    "q131_set_operations": """
        WITH a AS (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT o_custkey AS k FROM orders WHERE o_totalprice > 200000),
        m AS (SELECT k FROM a EXCEPT SELECT k FROM b), x AS (SELECT k FROM b EXCEPT SELECT k FROM a), i AS (SELECT k FROM a INTERSECT SELECT k FROM b), u AS (SELECT k FROM a UNION SELECT k FROM b),
        s AS (SELECT 'missing' AS what, * FROM m UNION ALL SELECT 'only first', * FROM m UNION ALL SELECT 'extra', * FROM x UNION ALL SELECT 'covered', * FROM i UNION ALL SELECT 'both', * FROM i UNION ALL SELECT 'any', * FROM u)
        SELECT what, count(*) AS n, max(k) AS last FROM s GROUP BY 1 UNION ALL SELECT 'from f', count(*), count(*) FROM a HAVING count(*) > 0 UNION ALL SELECT 'from big', count(*), 0 FROM b HAVING count(*) > 0
    """,
}
