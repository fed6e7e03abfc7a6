"""Identities, names, years and paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import text
from quillspark.operators import aggregates, dedupe
from quillspark.sources.tables import table


def q04_identity_basename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.duplicates(table(spark, sf_dir, "pages"), text.identity(F.col("url")))


def q05_identity_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    given = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("scans/"), F.col("page_id").cast("string"), F.lit(".png"))).when(F.col("page_id") % 3 == 1, F.lit(""))
    other = F.when(F.col("page_id") % 2 == 0, F.col("url"))
    return pages.select("page_id", text.row_identity(given, other).alias("identity"), text.upgraded_identity(given, other).alias("image_name"))


def q19_input_dedupe_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").where("url IS NOT NULL").select(text.identity(F.col("url")).alias("name"), F.concat_ws("#", "url", F.lpad(F.col("page_id").cast("string"), 12, "0")).alias("place"))
    return dedupe.duplicate_audit(pages, "name", "place")


def q35_sbid_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = F.concat_ws("/", F.lit("scans"), F.concat(F.lit("vol_"), (F.col("o_custkey") % 97 + 100000).cast("string")), F.concat(F.lit("p"), F.col("o_orderkey").cast("string"), F.lit(".png")))
    bare = F.concat(F.lit("p"), (F.col("o_orderkey") + 10000).cast("string"), F.lit(".png"))
    named = orders.select(F.when(F.col("o_orderkey") % 5 == 0, bare).otherwise(path).alias("path"))
    held = named.select(text.folder_number(F.col("path")).alias("sbid"))
    lookup = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 97 + 100000).alias("sbid")).agg(F.min(F.year("o_orderdate")).alias("year"))
    joined = held.join(lookup.where("sbid % 10 != 0"), "sbid", "left")
    return joined.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("sbid").isNull()).alias("no_number"))


def q36_year_suffix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"))
    return orders.where(text.year_matches(F.col("y"), 1996) | text.year_matches(F.col("y"), 98)).groupBy(F.col("y").cast("long").alias("year")).agg(F.count(F.lit(1)).alias("n"))


def q37_custom_id_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.custom_id(F.col("url")).alias("custom_id"))


def q47_fp_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    path = F.concat_ws("/", F.lit("in"), F.concat(F.lower(F.regexp_replace("p_brand", "[^A-Za-z0-9]+", "")), F.when(F.col("p_size") % 2 == 0, "_fp").otherwise("")), F.concat(F.lit("page_"), F.col("p_partkey").cast("string"), F.lit("_fp")))
    return part.select(text.in_suffixed_folder(path).alias("is_fp")).groupBy("is_fp").agg(F.count(F.lit(1)).alias("n"))


def q49_transient_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.when(F.col("event_type") == "error", F.concat(F.lit("HTTP "), (F.col("event_id") % 20 + 420).cast("string"))).when(F.col("event_type") == "view", "Request timed out ").otherwise(F.concat(F.lit("bad  "), F.col("event_type")))
    tidy = text.compact_error(said, F.lit("  "), said, F.lit("see log"))
    return table(spark, sf_dir, "events").select(tidy.alias("message"), text.transient(said).alias("transient")).groupBy("message", "transient").agg(F.count(F.lit(1)).alias("n"))


def q55_names_and_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    run = F.concat(F.lit("submit_"), F.date_format("o_orderdate", "yyyyMMdd_HHmmss"))
    return orders.select(
        "o_orderkey", text.run_time(run).alias("ran"), text.slug(F.col("o_orderpriority")).alias("slug"), text.state(F.concat(F.lit("JobState."), F.col("o_orderstatus"))).alias("state"),
        text.part_file("requests", (F.col("o_orderkey") % 9 + 1).cast("int"), F.lit(9)).alias("part"),
        text.part_of(text.part_file("requests", (F.col("o_orderkey") % 9 + 1).cast("int"), F.lit(9)))["index"].cast("long").alias("part_index"),
    )


def q56_object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("gs://pages/"), F.col("url"))).when(F.col("page_id") % 4 == 1, F.concat(F.lit("gs://other/"), F.col("url"))).when(F.col("page_id") % 4 == 2, F.concat(F.lit("//a/"), F.col("page_id").cast("string"))).otherwise("gs://pages/")
    return table(spark, sf_dir, "pages").select("page_id", text.object_key(ref, "pages").alias("object"), text.bucket_of(ref).alias("bucket"))


QUERIES = {f.__name__: f for f in (q04_identity_basename, q05_identity_coalesce, q19_input_dedupe_audit, q35_sbid_extract, q36_year_suffix_filter, q37_custom_id_hash, q47_fp_mode, q49_transient_error, q55_names_and_states, q56_object_keys)}

_ID = "nullif(nullif(regexp_extract(regexp_replace(trim({0}), '/+$', ''), '[^/]*$'), ''), '.')"
_MARKERS = "regexp_matches(lower(said), '503|unavailable|resource_exhausted|rate limit|429|internal|deadline|timed out|timeout|connection reset|connection error|temporarily|backend error')"
ORACLE_SQL = {
    "q04_identity_basename": f"SELECT {_ID.format('url')} AS name, count(*) AS n FROM pages GROUP BY 1 HAVING count(*) > 1 AND name IS NOT NULL",
    "q05_identity_coalesce": f"""
        WITH r AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'scans/' || page_id || '.png' WHEN 1 THEN '' END AS a, CASE WHEN page_id % 2 = 0 THEN url END AS b FROM pages)
        SELECT page_id, coalesce({_ID.format("a")}, {_ID.format("b")}) AS identity, coalesce(nullif(a, ''), {_ID.format("b")}) AS image_name FROM r
    """,
    "q19_input_dedupe_audit": f"""
        WITH r AS (SELECT {_ID.format("url")} AS name, url || '#' || lpad(CAST(page_id AS VARCHAR), 12, '0') AS place FROM pages WHERE url IS NOT NULL),
        i AS (SELECT *, row_number() OVER (ORDER BY encode(place)) AS i FROM r), k AS (SELECT *, min(i) OVER (PARTITION BY name) AS kept_index FROM i WHERE name IS NOT NULL)
        SELECT name, place, kept_index, i AS skipped_index FROM k WHERE i > kept_index
    """,
    "q35_sbid_extract": """
        WITH h AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey % 97 + 100000 END AS sbid FROM orders),
        l AS (SELECT o_custkey % 97 + 100000 AS sbid, min(year(o_orderdate)) AS year FROM orders GROUP BY 1)
        SELECT CAST(l.year AS INTEGER) AS year, count(*) AS n, count(*) FILTER (h.sbid IS NULL) AS no_number FROM h LEFT JOIN l ON h.sbid = l.sbid AND l.sbid % 10 <> 0 GROUP BY 1
    """,
    "q36_year_suffix_filter": "SELECT year(o_orderdate) AS year, count(*) AS n FROM orders WHERE year(o_orderdate) = 1996 OR year(o_orderdate) % 100 = 98 GROUP BY 1",
    "q37_custom_id_hash": "SELECT page_id, 'gcs_' || left(sha256(url), 40) AS custom_id FROM pages",
    "q47_fp_mode": "SELECT p_size % 2 = 0 AS is_fp, count(*) AS n FROM part GROUP BY 1",
    "q49_transient_error": f"""
        WITH s AS (SELECT CASE event_type WHEN 'error' THEN 'HTTP ' || (event_id % 20 + 420) WHEN 'view' THEN 'Request timed out ' ELSE 'bad  ' || event_type END AS said FROM events)
        SELECT trim(regexp_replace(said, '\\s+', ' ', 'g')) || '; see log' AS message, ({_MARKERS}) AS transient, count(*) AS n FROM s GROUP BY 1, 2
    """,
    "q55_names_and_states": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS ran, regexp_replace(regexp_replace(trim(o_orderpriority), '[^a-zA-Z0-9.-]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug,
               o_orderstatus AS state, printf('requests.part%03d-of-009.jsonl', o_orderkey % 9 + 1) AS part, o_orderkey % 9 + 1 AS part_index FROM orders
    """,
    "q56_object_keys": """
        SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 2 THEN 'a/' || page_id END AS object, CASE page_id % 4 WHEN 0 THEN 'pages' WHEN 1 THEN 'other' WHEN 3 THEN 'pages' END AS bucket FROM pages
    """,
}
