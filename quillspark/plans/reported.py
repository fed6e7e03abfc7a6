"""Rows by schema, records of a second provider, reports, states, and sinks read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import text, values
from quillspark.operators import reports, responses, rows, sampling
from quillspark.sources import files, sinks
from quillspark.sources.tables import table


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder below that of spark.checkpoint.dir."""
    from quillspark.streaming.log import shared_dir

    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def q81_identity_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").where("trim(url) <> ''")
    return pages.select("page_id", text.identity_pair(F.concat(F.lit(" "), "url", F.lit(" "))).alias("p")).select("page_id", "p.image_name", "p.file_name")


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as answers: a status, a nested customer, an array of amounts; every second one with confidences of some leaves."""
    k, total = F.col("o_orderkey"), F.col("o_totalprice")
    answer = F.struct(F.col("o_orderstatus").alias("status"), F.struct(F.col("o_custkey").alias("id")).alias("customer"), F.array(total, total * 2).alias("amounts"))
    leaf = lambda v: F.struct((-v).alias("field_confidence_logprobs"), v.alias("field_confidence_ratio"))
    pointers = F.map_from_arrays(F.array(F.lit("/status"), F.lit("/customer/id"), F.lit("/amounts/1")), F.array(leaf(F.lit(0.5)), leaf(F.col("o_custkey") / 1000.0), leaf(k / 10.0)))
    return table(spark, sf_dir, "orders").select(answer.alias("answer"), F.concat(F.lit("gs://b/pages/"), k.cast("string"), F.lit(".png")).alias("ref"), F.when(k % 2 == 0, pointers).alias("pointers"))


def q82_confidence_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = rows.rows_of("Order", _answers(spark, sf_dir), "answer", "ref", "pointers")
    ratio = lambda path: F.round(F.col(f"field_confidence.{path}.field_confidence_ratio"), 6)
    amounts = F.array_join(F.transform("field_confidence.amounts", lambda a: F.coalesce(F.round(a["field_confidence_ratio"], 6).cast("decimal(18,1)").cast("string"), F.lit("-"))), ",")
    return held.select("image_name", "file_name", "status", ratio("status").alias("status_ratio"), ratio("customer.id").alias("id_ratio"), amounts.alias("amount_ratios"))


def q83_line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = table(spark, sf_dir, "conversations").where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    lines = each.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda t: F.struct(t["text"].alias("text"), t["turn"].alias("turn"))).alias("page_lines"))
    answer = F.struct("page_lines", F.col("conv_id").alias("page"))
    pointers = F.create_map(F.lit("/page"), F.struct(F.lit(-1.0).alias("field_confidence_logprobs"), F.lit(0.25).alias("field_confidence_ratio")), F.lit("/page_lines/1/text"), F.struct(F.lit(-2.0).alias("field_confidence_logprobs"), F.lit(0.75).alias("field_confidence_ratio")))
    df = lines.select(answer.alias("answer"), F.concat(F.lit("scans/"), F.col("conv_id").cast("string"), F.lit(".jpg")).alias("ref"), pointers.alias("pointers"))
    out = rows.rows_of("TextPage", df, "answer", "ref", "pointers")
    return out.select("page", "turn", "image_name", F.col("field_confidence.page.field_confidence_ratio").alias("page_ratio"), F.col("field_confidence.text.field_confidence_ratio").alias("text_ratio"))


def q84_message_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result lines of the other form, made from events; every third custom_id is known."""
    e = F.col("event_id")
    custom = F.concat(F.lit("id"), (e % 100).cast("string"))
    line = lambda body: F.concat(F.lit('{"custom_id":"'), custom, F.lit('",'), F.lit(body), F.lit("}"))
    said = lambda t: line('"result":{"type":"succeeded","message":{"content":[{"type":"thinking","text":"hm"},{"type":"text","text":"' + t + '"}]}}')
    made = (
        F.when(e % 9 == 0, F.lit("{")).when(e % 9 == 1, F.lit("3")).when(e % 9 == 2, line('"result":null')).when(e % 9 == 3, line('"result":{"type":" Expired "}')).when(e % 9 == 4, line('"result":{}'))
        .when(e % 9 == 5, line('"result":{"type":"succeeded"}')).when(e % 9 == 6, said(" ")).when(e % 9 == 7, said("[1]")).otherwise(said('{\\"a\\":1}'))
    )
    keys = spark.range(0, 100, 3).select(F.concat(F.lit("id"), F.col("id").cast("string")).alias("custom_id"), F.concat(F.lit("page"), F.col("id").cast("string")).alias("key"))
    out = responses.message_columns(table(spark, sf_dir, "events").select("event_id", made.alias("line")), "line", keys)
    return out.groupBy("reason", F.col("_key").alias("key")).agg(F.count(F.lit(1)).alias("n"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.when(F.col("l_partkey") % 7 != 0, F.concat(F.lit("p"), F.col("l_partkey").cast("string"))).alias("key"), F.col("l_orderkey").alias("batch"), F.col("l_linenumber").alias("line"))


def q85_retrieved_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.retrieved(_lines(spark, sf_dir), "key", "batch", "line").select("batch", "line", "file_key", "status", "duplicate_action")


def q86_retrieved_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = responses.retrieved(_lines(spark, sf_dir), "key", "batch", "line", "provide_all")
    return out.groupBy("status", "duplicate_action").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file_key").alias("keys"))


def q87_derived_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs are customers: orders are their requests (some have none), lines of orders the rows produced, events the output lines."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    jobs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("job"), F.when(F.col("c_custkey") % 3 == 0, F.lit(4)).alias("request_count"))
    expected = orders.where("o_custkey % 5 <> 0").select(F.col("o_custkey").alias("job"), F.col("o_orderkey").alias("name"))
    produced = lines.where("l_linenumber <= 2 and l_orderkey % 3 <> 0").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("job"), F.col("l_orderkey").alias("name"))
    outputs = table(spark, sf_dir, "events").select(F.col("user_id").alias("job"))
    return reports.derived_results(jobs, expected, produced, outputs, "job", "name")


def q88_status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.when(F.col("p_size") == 50, "warning").otherwise("ok").alias("status"), "p_type")
    return reports.status_rollup(part, "status", "p_type")


def q89_error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = table(spark, sf_dir, "events").where("event_type <> 'view'").select("event_id", F.concat(F.lit("p"), F.col("event_id").cast("string")).alias("item"), F.nullif(F.col("event_type"), F.lit("click")).alias("reason"))
    return reports.error_summary(errors, "reason", "item", "event_id")


def q90_newest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.newest_events(table(spark, sf_dir, "events"), "event_type", "purchase", "event_id", 25).select("event_id", "user_id")


def q91_dataset_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.versions(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey")


def q92_records_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    records = table(spark, sf_dir, "orders").select(F.when(k % 3 == 0, F.lit(" ")).when(k % 3 == 1, F.concat(F.lit("runs/"), F.col("o_custkey").cast("string"))).alias("run_dir"), F.when(k % 2 == 0, F.concat(F.lit("old/"), F.col("o_custkey").cast("string"))).alias("source_run_dir"), k)
    return reports.by_run(records, "run_dir", "source_run_dir", "o_orderkey").select("run_folder", "o_orderkey")


def q93_capped_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cap comes before the sort: only the first hundred names are listed, then ordered by their change."""
    name = F.concat(F.lit("sets/"), "c_name", F.when(F.col("c_custkey") % 3 == 0, ".CSV").when(F.col("c_custkey") % 3 == 1, ".jsonl").otherwise(".txt"))
    return reports.capped_library(table(spark, sf_dir, "customer").select(name.alias("name"), F.col("c_acctbal").alias("updated")), "name", "updated", 100)


def q94_input_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    where = reports.input_location(
        F.when(k % 5 != 0, "bucket"), F.lit("/pages/"), F.when(k % 2 == 0, F.array(F.lit("/a/"), F.lit(" "), F.col("c_mktsegment"))), F.when(k % 7 == 0, k).cast("long"), F.when(k % 14 == 0, "/tmp/scans/"),
    )
    return table(spark, sf_dir, "customer").select("c_custkey", where.alias("location"))


def q95_error_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with each marker in turn, and some without, as transient and fatal."""
    words = "503 500 502 504 429 unavailable resource_exhausted internal deadline timeout|timed out|rate limit|connection reset|connection error|temporarily|backend error|token limit|quota|permission|unauthorized|forbidden|invalid api key|invalid_api_key|billing|resource exhausted|fine"
    said = F.explode(F.split(F.regexp_replace(F.lit(words), "(?<=[0-9a-z_]) (?=(500|502|504|429|unavailable|resource_exhausted|internal|deadline|timeout))", "|"), r"\|"))
    events = table(spark, sf_dir, "events").select("event_id", said.alias("marker"))
    message = F.concat(F.lit("Call "), F.upper("marker"), F.lit(" said"))
    return events.groupBy("marker", text.transient(message).alias("transient"), text.fatal(message).alias("fatal")).agg(F.count(F.lit(1)).alias("n"))


def q96_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["JOB_STATE_SUCCEEDED", "succeeded", "Ended", "COMPLETED", "JOB_STATE_FAILED", "errored", "JOB_STATE_PARTIALLY_SUCCEEDED", "PARTIALLY_SUCCEEDED", "CANCELED", "JOB_STATE_CANCELED", "x.JOB_STATE_CANCELLED", "EXPIRED", "JOB_STATE_EXPIRED", "JOB_STATE_RUNNING", " "]
    each = table(spark, sf_dir, "orders").select(F.element_at(F.array(*map(F.lit, names)), (F.col("o_orderkey") % len(names) + 1).cast("int")).alias("s"))
    return each.groupBy("s", text.succeeded(F.col("s")).alias("succeeded"), text.failed_state(F.col("s")).alias("failed")).agg(F.count(F.lit(1)).alias("n"))


def q97_random_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return sampling.random_pick(parts, parts.where("p_partkey % 3 = 0"), ["p_partkey", "p_brand"])


def q98_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("rows"), F.max("o_orderkey").alias("updated"))
    return reports.dashboard(orders, table(spark, sf_dir, "events").select("event_type"), "rows", "updated", "event_type")


def q99_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags as text and as numbers: of text only some spellings are true, of numbers all but zero."""
    size, brand = F.col("p_size"), F.element_at(F.array(*map(F.lit, ["Yes", "no", "2", "1", " TRUE ", "failed", ""])), (F.col("p_partkey") % 7 + 1).cast("int"))
    return table(spark, sf_dir, "part").groupBy(brand.alias("said"), (size % 3).alias("number")).agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(values.truthy(brand)).alias("said_true"), F.bool_and(values.truthy(size % 3)).alias("number_true"),
        F.bool_and(values.row_failed(brand)).alias("said_failed"), F.bool_and(values.row_failed(size % 3)).alias("number_failed"),
    )


def q100_sinks_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations through a JSONL sink in two appends, read strictly with line checks, then rewritten and read again."""
    path, nations = _folder(spark, "q100"), table(spark, sf_dir, "nation")
    sinks.append_json_lines(nations.where("n_nationkey < 10"), path)
    sinks.append_json_lines(nations.where("n_nationkey >= 10"), path)
    got = lambda name, kind: F.try_variant_get("value", f"$.{name}", kind).alias(name)
    sinks.rewrite(files.json_lines_strict(spark, path).select(got("n_nationkey", "long"), got("n_name", "string")), path)
    return files.json_lines(spark, path).select(got("n_nationkey", "long"), got("n_name", "string"))


def q101_request_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request lines of orders written as text: the lines and bytes of the files, and how many distinct keys they hold."""
    path = _folder(spark, "q101")
    table(spark, sf_dir, "orders").select(F.concat(F.lit('{"key":"k'), (F.col("o_orderkey") % 500).cast("string"), F.lit('"}')).alias("value")).write.text(path)
    keys = files.request_keys(files.numbered_lines(spark, path)).agg(F.count(F.lit(1)).alias("keys"))
    return files.requests_size(spark, path).join(keys)


def q102_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of JSONL files, one for each of twenty groups of users, the objects among each one's first ten physical lines; every
    fourth event gives a broken or blank line."""
    path, k = _folder(spark, "q102"), F.col("event_id")
    line = F.when(k % 8 == 0, "").when(k % 4 == 0, "{").otherwise(F.concat(F.lit('{"n":'), k.cast("string"), F.lit("}")))
    held = table(spark, sf_dir, "events").select((F.col("user_id") % 20).alias("users"), "event_id", line.alias("value")).repartition("users").sortWithinPartitions("users", "event_id")
    held.select("users", "value").write.partitionBy("users").text(path)
    shown = files.preview(spark, path, 10)
    return shown.select(F.regexp_extract("file", "users=([0-9]+)", 1).cast("long").alias("users"), "line", F.try_variant_get("value", "$.n", "long").alias("n"))


_ALL = (
    q81_identity_pair, q82_confidence_tree, q83_line_rows, q84_message_records, q85_retrieved_first, q86_retrieved_all, q87_derived_results, q88_status_rollup, q89_error_summary, q90_newest_events, q91_dataset_versions,
    q92_records_by_run, q93_capped_library, q94_input_location, q95_error_kinds, q96_states, q97_random_pick, q98_dashboard, q99_truth, q100_sinks_read_back, q101_request_files, q102_preview,
)
QUERIES = {f.__name__: f for f in _ALL}

_RETRIEVED = "l AS (SELECT l_orderkey AS batch, l_linenumber AS line, CASE WHEN l_partkey % 7 <> 0 THEN 'p' || l_partkey ELSE '<batch:' || l_orderkey || '-line:' || l_linenumber || '>' END AS file_key FROM lineitem)"
ORACLE_SQL = {
    "q81_identity_pair": "SELECT page_id, regexp_extract(regexp_replace(trim(url), '/+$', ''), '[^/]*$') AS image_name, trim(url) AS file_name FROM pages WHERE trim(url) <> ''",
    "q82_confidence_tree": """
        SELECT o_orderkey || '.png' AS image_name, 'gs://b/pages/' || o_orderkey || '.png' AS file_name, o_orderstatus AS status, CASE WHEN o_orderkey % 2 = 0 THEN 0.5 END AS status_ratio,
               CASE WHEN o_orderkey % 2 = 0 THEN round(o_custkey / 1000.0, 6) END AS id_ratio, CASE WHEN o_orderkey % 2 = 0 THEN '-,' || CAST(CAST(o_orderkey / 10.0 AS DECIMAL(18, 1)) AS VARCHAR) END AS amount_ratios FROM orders
    """,
    "q83_line_rows": """
        WITH t AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM (SELECT DISTINCT conv_id, turn FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL))
        SELECT conv_id AS page, turn, conv_id || '.jpg' AS image_name, 0.25 AS page_ratio, CASE WHEN k = 2 THEN 0.75 END AS text_ratio FROM t
    """,
    "q84_message_records": """
        WITH e AS (SELECT event_id % 9 AS m, event_id % 100 AS c FROM events)
        SELECT CASE m WHEN 0 THEN 'invalid_jsonl_line' WHEN 1 THEN 'invalid_record_type' WHEN 2 THEN 'missing_result' WHEN 3 THEN 'batch_expired' WHEN 4 THEN 'batch_unknown' WHEN 5 THEN 'missing_response'
                      WHEN 6 THEN 'empty_response_text' WHEN 7 THEN 'schema_validation_failed' ELSE 'valid' END AS reason, CASE WHEN m < 2 THEN NULL WHEN c % 3 = 0 THEN 'page' || c ELSE 'id' || c END AS key, count(*) AS n FROM e GROUP BY 1, 2
    """,
    "q85_retrieved_first": f"""
        WITH {_RETRIEVED}, r AS (SELECT *, rank() OVER (PARTITION BY file_key ORDER BY batch, line) AS k FROM l)
        SELECT batch, line, file_key, CASE WHEN k = 1 THEN 'success' ELSE 'duplicate_skipped' END AS status, CASE WHEN k = 1 THEN 'kept' ELSE 'kept_first_successful' END AS duplicate_action FROM r
    """,
    "q86_retrieved_all": f"WITH {_RETRIEVED} SELECT 'success' AS status, 'provided' AS duplicate_action, count(*) AS n, count(DISTINCT file_key) AS keys FROM l",
    "q87_derived_results": """
        WITH x AS (SELECT o_custkey AS job, o_orderkey AS name FROM orders WHERE o_custkey % 5 <> 0),
        p AS (SELECT o_custkey AS job, l_orderkey AS name FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber <= 2 AND l_orderkey % 3 <> 0),
        c AS (SELECT c_custkey AS job, CASE WHEN c_custkey % 3 = 0 THEN 4 ELSE 0 END AS requests, (SELECT count(DISTINCT name) FROM x WHERE x.job = c_custkey) AS asked, (SELECT count(DISTINCT name) FROM p WHERE p.job = c_custkey) AS covered,
                     (SELECT count(*) FROM p WHERE p.job = c_custkey) AS rows_written, (SELECT count(*) FROM events WHERE user_id = c_custkey) AS lines FROM customer),
        e AS (SELECT *, coalesce(nullif(asked, 0), nullif(requests, 0), covered) AS expected_pages, covered AS successful_pages FROM c),
        o AS (SELECT *, coalesce(nullif(lines, 0), expected_pages) AS observed_pages FROM e)
        SELECT job, rows_written, expected_pages, observed_pages, successful_pages, greatest(expected_pages - successful_pages, 0) AS missing_pages, greatest(observed_pages - successful_pages, 0) AS error_rows FROM o
    """,
    "q88_status_rollup": """
        SELECT CASE WHEN count(*) = 0 THEN 'error' WHEN count(*) FILTER (p_size = 50) > 0 THEN 'warning' ELSE 'ok' END AS status, count(*) AS total, count(*) FILTER (p_size <> 50) AS ok, count(*) FILTER (p_size = 50) AS warning, 0 AS error,
               (SELECT count(*) FROM (SELECT p_type FROM part GROUP BY 1 HAVING count(*) > 1)) AS duplicate_names FROM part
    """,
    "q89_error_summary": """
        WITH e AS (SELECT event_id, nullif(event_type, 'click') AS r FROM events WHERE event_type <> 'view'), n AS (SELECT count(*) AS n FROM e),
        c AS (SELECT string_agg(k || ' ' || r, ', ' ORDER BY k DESC, f) AS reasons FROM (SELECT coalesce(r, 'unknown') AS r, count(*) AS k, min(event_id) AS f FROM e GROUP BY 1)),
        s AS (SELECT string_agg('p' || event_id || ': ' || coalesce(r, 'None'), '; ' ORDER BY event_id) AS shown FROM (SELECT * FROM e ORDER BY event_id LIMIT 5))
        SELECT CASE WHEN n = 0 THEN '' ELSE 'API recovery failed for ' || n || ' page(s): ' || reasons || '. ' || shown || CASE WHEN n > 5 THEN '; +' || (n - 5) || ' more' ELSE '' END END AS summary FROM n, c, s
    """,
    "q90_newest_events": "SELECT event_id, user_id FROM events WHERE event_type = 'purchase' ORDER BY event_id DESC LIMIT 25",
    "q91_dataset_versions": "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS place FROM orders",
    "q92_records_by_run": """
        WITH r AS (SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 1 THEN 'runs/' || o_custkey END, CASE WHEN o_orderkey % 2 = 0 THEN 'old/' || o_custkey END) AS run_folder FROM orders)
        SELECT run_folder, max(o_orderkey) AS o_orderkey FROM r WHERE run_folder IS NOT NULL GROUP BY 1
    """,
    "q93_capped_library": "SELECT * FROM (SELECT 'sets/' || c_name || CASE c_custkey % 3 WHEN 0 THEN '.CSV' ELSE '.jsonl' END AS name, c_acctbal AS updated FROM customer WHERE c_custkey % 3 < 2 ORDER BY 1 LIMIT 100) ORDER BY updated DESC, name",
    "q94_input_location": """
        WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 <> 0 THEN 'gs://bucket/' ELSE '' END AS b, c_mktsegment AS s FROM customer)
        SELECT k AS c_custkey, CASE WHEN k % 7 = 0 AND k > 0 THEN CASE WHEN k % 14 = 0 THEN 'scans' ELSE 'local folder' END || ' — ' || k || ' scoped image(s) in ' || b || 'pages' WHEN k % 2 = 0 THEN b || 'a, ' || b || s ELSE b || 'pages' END AS location FROM c
    """,
    "q95_error_kinds": """
        WITH m AS (SELECT unnest(['503', 'unavailable', 'resource_exhausted', 'rate limit', '429', 'internal', 'deadline', 'timed out', 'timeout', 'connection reset', 'connection error', 'temporarily', 'backend error']) AS marker, true AS transient, false AS fatal
                   UNION ALL SELECT unnest(['token limit', 'quota', 'permission', 'unauthorized', 'forbidden', 'invalid api key', 'invalid_api_key', 'billing']), false, true
                   UNION ALL SELECT unnest(['500', '502', '504', 'resource exhausted', 'fine']), false, false)
        SELECT marker, transient, fatal, (SELECT count(*) FROM events) AS n FROM m
    """,
    "q96_states": """
        WITH m AS (SELECT ['JOB_STATE_SUCCEEDED', 'succeeded', 'Ended', 'COMPLETED', 'JOB_STATE_FAILED', 'errored', 'JOB_STATE_PARTIALLY_SUCCEEDED', 'PARTIALLY_SUCCEEDED', 'CANCELED', 'JOB_STATE_CANCELED', 'x.JOB_STATE_CANCELLED', 'EXPIRED', 'JOB_STATE_EXPIRED', 'JOB_STATE_RUNNING', ' '] AS a),
        s AS (SELECT o_orderkey % 15 AS k, a[o_orderkey % 15 + 1] AS s FROM orders, m)
        SELECT s, k IN (0, 1, 2) AS succeeded, k BETWEEN 4 AND 12 AS failed, count(*) AS n FROM s GROUP BY 1, 2, 3
    """,
    "q97_random_pick": "SELECT p_partkey, p_brand FROM part WHERE p_partkey % 3 <> 0 ORDER BY md5('7|' || p_partkey || '|' || p_brand), p_partkey, p_brand LIMIT 1",
    "q98_dashboard": """
        SELECT (SELECT count(DISTINCT o_custkey) FROM orders) AS dataset_count, (SELECT count(*) FROM orders) AS rows, (SELECT max(o_orderkey) FROM orders) AS latest,
               (SELECT string_agg(l, ',' ORDER BY l) FROM (SELECT event_type || '=' || count(*) AS l FROM events WHERE trim(event_type) <> '' GROUP BY event_type)) AS labels
    """,
    "q99_truth": """
        WITH p AS (SELECT ['Yes', 'no', '2', '1', ' TRUE ', 'failed', ''][p_partkey % 7 + 1] AS said, p_size % 3 AS number FROM part)
        SELECT said, number, count(*) AS n, said IN ('Yes', '1', ' TRUE ') AS said_true, number <> 0 AS number_true, said IN ('Yes', '1', ' TRUE ', 'failed') AS said_failed, number <> 0 AS number_failed FROM p GROUP BY 1, 2
    """,
    "q100_sinks_read_back": "SELECT n_nationkey, n_name FROM nation",
    "q101_request_files": """
        SELECT count(*) AS requests, CAST(sum(length('{"key":"k' || o_orderkey % 500 || '"}') + 1) AS BIGINT) AS bytes, count(DISTINCT o_orderkey % 500) AS keys FROM orders
    """,
    "q102_preview": "SELECT * FROM (SELECT user_id % 20 AS users, row_number() OVER (PARTITION BY user_id % 20 ORDER BY event_id) AS line, event_id AS n FROM events) WHERE line <= 10 AND n % 4 <> 0",
}
