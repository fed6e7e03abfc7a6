"""Listings and selections, files with unlike headers, run layouts, bundles of reports, sinks read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import text
from quillspark.operators import jobs, layout, links, manifest, nested, reports, responses
from quillspark.plans.reported import _folder
from quillspark.sources import files, selection, sinks
from quillspark.sources.tables import table


def _objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of objects below three folders, some with marked folders in them, of several extensions, placeholders too."""
    k, pick = F.col("p_partkey"), lambda n, *v: F.element_at(F.array(*map(F.lit, v)), (F.col("p_partkey") % n + 1).cast("int"))
    name = F.concat(pick(3, "pages/", "pages2/", "x/pages/"), pick(4, "", "a_fp/", "b/", "b/c_fp/"), pick(7, "p", "._p", "q", "p_fp", "P", "p", "p["), k.cast("string"), pick(5, ".png", ".JPG", ".txt", "", "/"))
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))


def q107_object_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images below a prefix by a pattern of base names, with their extension and folder mode."""
    kept = selection.selected(_objects(spark, sf_dir), "name", " /pages/ ", "[p!]*[!13]*", {"png", ".jpg"})
    c = F.col("name")
    return kept.select("name", selection.extension(c).alias("extension"), selection.relative(c, "pages").alias("relative"), selection.in_mode(c, "only_fp", "pages").alias("marked"))


def q108_input_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that may be processed, without those in marked folders; folders of files written and listed beside them."""
    chosen = selection.inputs(_objects(spark, sf_dir), "name", "pages", "p*", mode="exclude_fp").agg(F.count(F.lit(1)).alias("n"), F.max("name").alias("last")).select(F.lit("chosen").alias("what"), F.col("last").alias("folder"), "n")
    path = _folder(spark, "q108")
    table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("kind"), F.concat(F.lit('{"key":"k'), F.col("o_orderkey").cast("string"), F.lit('"}')).alias("value")).repartition("kind").write.partitionBy("kind").text(path)
    found = selection.selected(files.listing(spark, path), "path", glob="part-*.txt", extensions={"txt"})
    listed = found.groupBy(F.regexp_extract("path", "kind=([0-9])", 1).alias("folder")).agg(F.count(F.lit(1)).alias("n"))
    return chosen.unionByName(listed.select(F.lit("written").alias("what"), "folder", "n"))


def _validation_folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Decisions, a file a run, in three headers: of one column order, of another with more columns, and without some."""
    path, e = _folder(spark, name), table(spark, sf_dir, "events")
    k = F.col("event_id")
    label = F.element_at(F.array(*map(F.lit, ["accept", "Reject", "somewhat accept", "unsure", "corrected", ""])), (k % 6 + 1).cast("int")).alias("label")
    field, image = F.concat(F.lit("f."), "event_type").alias("column_name"), F.concat(k.cast("string"), F.lit('.png, "x"\nof it')).alias("image_name")
    heads = [[label, field, image], [image, F.col("user_id").cast("string").alias("validator_id"), label, field, F.lit("d.jsonl").alias("dataset_file")], [F.lit("t").alias("decided_at"), label, field]]
    for run, columns in enumerate(heads):
        part = e.where(F.col("user_id") % 3 == run).repartitionByRange("event_id").sortWithinPartitions("event_id")
        part.select(*columns).write.option("header", True).option("escape", '"').csv(f"{path}/run_{run}")
    return path


def q109_validation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = files.report_validations(spark, _validation_folder(spark, sf_dir, "q109"), "*.csv")
    return rows.groupBy(F.col("_validation_run").alias("run"), "label", "column_name", "decided_at", "dataset_file").agg(F.count(F.lit(1)).alias("n"), F.count("image_name").alias("images"), F.count("validator_id").alias("validators"), F.sum(F.char_length("image_name")).alias("characters"))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    start = F.element_at(F.array(*map(F.lit, ["submit_", "retrieve_", "collect_outputs_", "", "other_"])), (k % 5 + 1).cast("int"))
    stamp = F.concat(F.lit("2024"), F.lpad((k % 12 + 1).cast("string"), 2, "0"), F.lit("01_"), F.lpad((k % 4000).cast("string"), 6, "0"))
    # Two names for one place: with nothing and with a second prefix behind it.
    return table(spark, sf_dir, "customer").select("c_custkey", F.concat(start, stamp, F.when(k % 35 == 3, "").when(k % 10 == 4, "_x").otherwise("")).alias("name"))


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _runs(spark, sf_dir)
    there = runs.where("c_custkey % 7 = 0").select(layout.destination(F.col("name")).alias("to"))
    return layout.move_plan(runs, "name", there)


def q110_move_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir)


def q111_rewritten_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders refer to datasets in the folders of their customers' runs; a file called like a folder stays."""
    runs = _runs(spark, sf_dir).withColumnRenamed("c_custkey", "o_custkey")
    refs = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(runs, "o_custkey")
    refs = refs.select("o_orderkey", F.concat(F.lit("runs/"), "name", F.lit("/data/"), F.when(F.col("o_orderkey") % 9 == 0, F.col("name")).otherwise("d.jsonl")).alias("dataset_path"))
    none = spark.range(-1, 0).select(F.col("id").alias("o_orderkey"), F.lit(None).cast("string").alias("dataset_path"))
    return layout.rewritten(refs.unionByName(none), "dataset_path", _plan(spark, sf_dir)).select("o_orderkey", "dataset_path", "fixed")


def q112_newest_of_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "orders").select(F.concat(F.lit("run_"), F.col("o_custkey").cast("string")).alias("run"), F.concat(F.when(F.col("o_orderkey") % 4 == 0, "current").otherwise("d"), F.col("o_orderkey").cast("string"), F.lit(".jsonl")).alias("name"), F.col("o_orderdate").alias("modified"))
    return layout.newest_of_runs(listed, "run", "name", "modified", F.col("name").startswith("current")).select("run", "name")


def q113_run_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Providers of customers' runs: told by a record, by the names of all batches, or not, with two batches that differ."""
    k, o = F.col("c_custkey"), F.col("o_orderkey")
    runs = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 11 == 0, " Gemini ").when(k % 11 == 1, "unknown").alias("provider"))
    name = F.when(F.col("o_custkey") % 3 == 0, F.concat(F.lit("msgbatch_"), o.cast("string"))).when(F.col("o_custkey") % 3 == 1, F.concat(F.lit("projects/p/locations/l/"), o.cast("string"))).otherwise(F.concat(F.when(o % 2 == 0, "batches/").when(o % 5 == 0, "odd").otherwise("msgbatch_"), o.cast("string")))
    batches = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), name.alias("name"))
    out = jobs.run_providers(runs, batches, "c_custkey", "provider", "name")
    return out.groupBy("provider", "source", F.size("mixed").alias("mixed")).agg(F.count(F.lit(1)).alias("n"))


def q114_chunk_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as chunks of orders: a record for each, and what a job's record says of them."""
    chunks = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.max("l_partkey").alias("p"))
    entries = jobs.chunk_entries(chunks, "l_orderkey", "l_linenumber", request_count=F.col("n"), request_bytes=F.col("p") * 10, batch_job_name=F.concat(F.lit("batches/"), F.col("p").cast("string")))
    return jobs.job_records(entries, "l_orderkey").select("l_orderkey", "num_batches", "request_count", "request_bytes", F.array_join("batch_job_names", ",").alias("names"))


def q115_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    log = e.select(F.col("user_id").alias("task"), F.col("event_id").alias("updated_at"), F.col("event_type").alias("status"), F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("event_id").cast("string")).alias("created_at"), F.when(F.col("event_type") == "click", F.col("event_id").cast("string")).alias("started_at"))
    return jobs.tasks(log, "task", "updated_at", 50)


def q116_collect_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction lines in files: valid, repeated, broken, without key, failed or blank."""
    e = F.col("event_id")
    key = F.concat(F.lit("k"), (e % 701).cast("string"))
    line = F.when(e % 9 == 0, "{broken").when(e % 9 == 1, '{"response":{}}').when(e % 9 == 2, F.concat(F.lit('{"key":"'), key, F.lit('","error":{"code":5}}'))).when(e % 9 == 3, "  ").otherwise(F.concat(F.lit('{"key":"'), key, F.lit('","response":{"text":"{}"}}')))
    return responses.collect_stats(table(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("file"), line.alias("line")), "line", "file")


def _bundle(spark: SparkSession, sf_dir: str, name: str) -> dict[str, DataFrame]:
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("rows"), F.max("o_orderkey").alias("updated"))
    e = table(spark, sf_dir, "events")
    records = e.select(F.concat((F.col("event_id") % 977).cast("string"), F.lit(".png")).alias("image_name"), F.col("event_type").alias("status"), F.when(F.col("user_id") % 2 == 0, " ").otherwise("batch").alias("source"), F.when(F.col("event_type") == "error", F.concat(F.lit("r"), (F.col("user_id") % 4).cast("string"))).alias("failure_reason"), (F.col("event_id") % 4).alias("attempts"), F.col("value").alias("generation_seconds"))
    validations = files.validations(spark, _validation_folder(spark, sf_dir, name), "*.csv")
    return reports.dashboard_bundle(orders, validations, records, "rows", "updated", "o_custkey")


def q117_dashboard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bundle(spark, sf_dir, "q117")["counts"]


def q118_dashboard_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = _bundle(spark, sf_dir, "q118")
    measures = held["measures"].select(F.col("measure").alias("name"), F.col("n").cast("long").alias("n"), "mean", "median")
    metrics = held["metrics"].select(F.col("metric").alias("name"), F.col("decisions").alias("n"), F.col("accuracy").alias("mean"), F.lit(None).cast("double").alias("median"))
    return measures.unionByName(metrics).unionByName(held["latest"].select(F.lit("latest").alias("name"), F.col("o_custkey").alias("n"), F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("median")))


def q119_variant_datapoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with unlike leaves: of the schema's the scalars that are not null, an empty text too; arrays and others are none."""
    k = F.col("s_suppkey")
    one = F.to_json(F.struct(F.struct(F.col("s_name").alias("name"), F.lit("").alias("note"), F.array(k).alias("ids")).alias("patient"), F.lit("m").alias("model")))
    two = F.to_json(F.struct(F.struct(F.struct(F.col("s_nationkey").alias("id")).alias("age"), F.lit(None).cast("string").alias("note")).alias("patient"), k.alias("ward")), {"ignoreNullFields": "false"})
    record = F.when(k % 3 == 0, one).when(k % 3 == 1, two).otherwise('{"patient":"x","ward":[1]}')
    rows = table(spark, sf_dir, "supplier").select(F.concat(k.cast("string"), F.lit(".png")).alias("image"), F.parse_json(record).alias("v"))
    index = table(spark, sf_dir, "part").select(F.concat((F.col("p_partkey") * 2).cast("string"), F.lit(".png")).alias("name"))
    return links.variant_datapoints(rows, "image", "v", index, "name", {"patient.name", "patient.note", "patient.ids", "patient.age.id", "ward"})


def q120_dataset_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, broken ones too, and distinct identities of a written dataset, and its manifest, which is not there."""
    path, k = _folder(spark, "q120"), F.col("o_orderkey")
    line = F.when(k % 10 == 0, "{broken").when(k % 10 == 1, " ").when(k % 10 == 2, '{"image_name":" "}').otherwise(F.concat(F.lit('{"file_name":"gs://b/p/'), F.col("o_custkey").cast("string"), F.lit('.png"}')))
    table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    return files.image_coverage(spark, path).join(files.processing_records(spark, f"{path}-none").agg(F.count(F.lit(1)).alias("records")))


def q121_report_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sinks read back: delimited appends aligned to the first header, reports, decisions, an audit, events, versions, a collection."""
    path, orders = _folder(spark, "q121"), table(spark, sf_dir, "orders")
    row = orders.select("o_orderkey", F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer")).alias("is"))
    sinks.append_delimited(row.where("o_orderkey % 2 = 0"), spark, f"{path}/set")
    sinks.append_delimited(row.where("o_orderkey % 2 = 1").select(F.lit("x").alias("extra"), F.struct(F.col("is.customer").alias("customer")).alias("is"), "o_orderkey"), spark, f"{path}/set")
    count = lambda df, what, c: df.agg(F.count(F.lit(1)).alias("n"), F.count(c).alias("filled")).withColumn("what", F.lit(what))
    out = [count(files.delimited(spark, f"{path}/set").withColumn("s", F.nullif(F.col("`is.status`"), F.lit(""))), "set", "s")]
    sinks.report_csv(orders.select("o_custkey", "o_orderstatus", "o_orderkey"), f"{path}/report", ["o_orderkey", "absent"])
    report = spark.read.csv(f"{path}/report", header=True)
    out.append(count(report.withColumn("first", F.lit(",".join(report.columns) == "o_orderkey,o_custkey,o_orderstatus")), "report", "first"))
    sinks.duplicate_report(orders.where("o_orderkey % 5 = 0").select(F.col("o_orderkey").cast("string").alias("name")), f"{path}/audit", "name")
    skipped = files.json_lines(spark, f"{path}/audit/manifest").select(F.try_variant_get("value", "$.status", "string").alias("status"))
    out.append(count(skipped.where("status = 'duplicate_skipped'"), "audit", "status"))
    sinks.decisions(orders.select(F.col("o_orderstatus").alias("label")), f"{path}/decisions", ["image_name", "label"])
    out.append(count(spark.read.csv(f"{path}/decisions", header=True), "decisions", "image_name"))
    for part in (0, 1):
        sinks.append_event(orders.where(f"o_orderkey % 2 = {part}").select(F.col("o_orderkey").alias("job_id"), F.lit("made").alias("event_type"), F.struct("o_custkey").alias("payload")), f"{path}/events")
    out.append(count(spark.read.parquet(f"{path}/events").where("payload LIKE '{\"o_custkey\":%'"), "events", "payload"))
    for version in (1, 2):
        sinks.versioned_copy(orders.where(f"o_orderkey % 2 < {version}").select("o_orderkey"), f"{path}/copies", version, "made")
    out.append(count(spark.read.parquet(f"{path}/copies/current"), "current", "o_orderkey"))
    out.append(count(spark.read.parquet(f"{path}/copies/versions/v001_made"), "version", "o_orderkey"))
    key = orders.select(F.col("o_orderkey").alias("key"))
    sinks.collect_run(key.where("key % 3 = 0"), key.where("key % 3 = 1"), key.where("key % 3 = 2"), orders.agg(F.count(F.lit(1)).alias("expected")), f"{path}/collected")
    out += [count(spark.read.json(f"{path}/collected/{n}"), n, "key") for n in ("selected_outputs", "rejected_output_keys", "missing_page_keys")]
    sinks.summary(orders.agg(F.count(F.lit(1)).alias("records")), "m.jsonl", f"{path}/summary", F.lit("now"))
    out.append(spark.read.json(f"{path}/summary").select(F.col("records").alias("n"), F.length("manifest_path").cast("long").alias("filled"), F.lit("summary").alias("what")))
    sinks.decisions_metadata(orders, f"{path}/meta", validator_id="v")
    out.append(spark.read.json(f"{path}/meta").select(F.col("decision_count").alias("n"), F.length("validator_id").cast("long").alias("filled"), F.lit("metadata").alias("what")))
    held = out[0]
    for df in out[1:]:
        held = held.unionByName(df)
    return held


def q122_small_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Success marks, response columns, readiness, costs, replaced chunks, backoff, texts of values, providers and retry marks."""
    orders = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    marked = nested.marked_success(orders.select("o_orderkey", F.when(k % 4 == 0, True).alias("failed"))).agg(F.count_if("failed").alias("n"), F.count_if(F.col("failure_reason") == "").alias("m")).withColumn("what", F.lit("marked"))
    said = F.parse_json(F.concat(F.lit('{"candidates":[{"avg_logprobs":-0.5,"content":{"parts":[{"thought":true,"text":"'), F.when(k % 3 == 0, "  ").otherwise("hm"), F.lit('"}]}}]}')))
    columns = manifest.response_columns(orders.select(said.alias("r")), "r").agg(F.count("thoughts").alias("n"), F.count_if(F.col("avg_logprobs") == -0.5).alias("m")).withColumn("what", F.lit("columns"))
    model = F.element_at(F.array(*map(F.lit, [" Gemini-1", "models/gemini-2", "anthropic/claude-3", "claude-4", "openai/x", "o3-mini", "models/gpt-5", "else", " "])), (k % 9 + 1).cast("int"))
    providers = orders.groupBy(text.provider_of(model).alias("p")).agg(F.count(F.lit(1)).alias("n"), F.max(k).alias("m")).select("n", "m", F.concat(F.lit("provider "), F.coalesce("p", F.lit("none"))).alias("what"))
    lost = manifest.recovery_errors(orders.select(F.concat(F.lit("p/"), k.cast("string"), F.lit(".png")).alias("key"), F.lit("lost").alias("reason")), "key", "reason")
    lost = lost.agg(F.count("image_name").alias("n"), F.sum(F.char_length("image_name")).alias("m")).withColumn("what", F.lit("recovery"))
    chunk = orders.select((k % 50).alias("job"), F.floor(k / 50).alias("chunk"), F.lit(0).alias("again"))
    replaced = jobs.replaced_chunks(chunk, chunk.where("chunk % 2 = 0").withColumn("again", F.lit(1)), "job", "chunk").agg(F.count(F.lit(1)).alias("n"), F.sum("again").alias("m")).withColumn("what", F.lit("replaced"))
    single = manifest.single_row(orders.agg(F.max("o_orderkey").alias("n"))).select("n", F.lit(0).cast("long").alias("m"), F.lit("single").alias("what"))
    return marked.unionByName(columns).unionByName(providers).unionByName(lost).unionByName(replaced).unionByName(single)


def q123_column_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each order, as a job: readiness, what it costs, its retrieved state, waits, texts, retries, places and page numbers."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    held = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "x.JOB_STATE_SUCCEEDED").otherwise("JOB_STATE_RUNNING").alias("status"), (k % 3).alias("done"), F.lit(2).alias("all"), c.alias("pages"),
        F.concat(F.when(k % 2 == 0, "projects/p/locations/").otherwise("locations-"), F.lit("eu-"), (c % 4).cast("string"), F.lit("/jobs/1")).alias("batch"), F.concat(F.when(k % 5 == 0, "x").otherwise("page_"), c.cast("string"), F.lit(".png")).alias("page"),
    )
    held = jobs.cost_estimate(jobs.readiness(held, "status", "done", "all"), "pages", 0.25)
    number = F.when(k % 3 == 0, F.lit("NaN").cast("double")).when(k % 3 == 1, F.col("pages") / 2)
    return held.select(
        "o_orderkey", "readiness", F.round("cost", 6).alias("cost"), jobs.retrieved_state(k % 2).alias("state"), text.backoff_seconds(k % 7, 1.5, 20.0).alias("wait"), text.stringified(number).alias("text"),
        links.is_retry(F.when(k % 4 == 0, "retry").otherwise("x"), F.when(k % 6 == 0, "run")).alias("retry"), text.location_of(F.col("batch")).alias("location"), text.page_number(F.col("page")).alias("page"),
    )


_ALL = (
    q107_object_selection, q108_input_files, q109_validation_files, q110_move_plan, q111_rewritten_references, q112_newest_of_runs, q113_run_providers, q114_chunk_records, q115_tasks, q116_collect_stats,
    q117_dashboard_counts, q118_dashboard_measures, q119_variant_datapoints, q120_dataset_coverage, q121_report_sinks, q122_small_operators, q123_column_functions,
)
QUERIES = {f.__name__: f for f in _ALL}

_NAMES = """o AS (SELECT ['pages/', 'pages2/', 'x/pages/'][p_partkey % 3 + 1] || ['', 'a_fp/', 'b/', 'b/c_fp/'][p_partkey % 4 + 1] || ['p', '._p', 'q', 'p_fp', 'P', 'p', 'p['][p_partkey % 7 + 1] || p_partkey
    || ['.png', '.JPG', '.txt', '', '/'][p_partkey % 5 + 1] AS name, p_partkey AS k FROM part),
    b AS (SELECT *, regexp_extract(name, '[^/]*$') AS base, name[7:] AS relative FROM o WHERE name LIKE 'pages/%' AND name NOT LIKE '%/')"""
_DECISIONS = """d AS (SELECT user_id % 3 AS r, event_id, ['accept', 'Reject', 'somewhat accept', 'unsure', 'corrected', ''][event_id % 6 + 1] AS label, 'f.' || event_type AS column_name FROM events)"""
_RUNS = """r AS (SELECT c_custkey, c_custkey % 5 AS p, '2024' || lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0') || '01_' || lpad(CAST(c_custkey % 4000 AS VARCHAR), 6, '0') || CASE WHEN c_custkey % 35 <> 3 AND c_custkey % 10 = 4 THEN '_x' ELSE '' END AS stamp FROM customer),
    f AS (SELECT *, ['submit_', 'retrieve_', 'collect_outputs_', '', 'other_'][p + 1] || stamp AS name, CASE WHEN p < 3 OR (p = 3 AND stamp NOT LIKE '%x') THEN ['submits', 'retrieves', 'collect_outputs', 'local'][p + 1] || '/' || stamp END AS dest FROM r),
    u AS (SELECT DISTINCT name, p, dest FROM f),
    t AS (SELECT *, row_number() OVER (PARTITION BY dest ORDER BY name) AS place, dest IN (SELECT dest FROM f WHERE c_custkey % 7 = 0 AND dest IS NOT NULL) AS taken FROM u),
    plan AS (SELECT name AS "from", CASE WHEN dest IS NULL THEN 'unrecognised' WHEN taken OR place > 1 THEN 'destination exists' END AS reason, dest, p FROM t)"""
ORACLE_SQL = {
    "q107_object_selection": f"""
        WITH {_NAMES}
        SELECT name, lower(regexp_extract(base, '[^.]*$')) AS extension, relative, regexp_matches(relative, '_fp/') AS marked FROM b
        WHERE base NOT LIKE '._%' AND regexp_matches(base, '^[p!].*[^13].*$') AND regexp_matches(lower(base), '\\.(png|jpg)$')
    """,
    "q108_input_files": f"""
        WITH {_NAMES}
        SELECT 'chosen' AS what, max(name) AS folder, count(*) AS n FROM b WHERE base LIKE 'p%' AND NOT regexp_matches(relative, '_fp/')
        UNION ALL SELECT DISTINCT 'written', left(o_orderpriority, 1), 1 FROM orders
    """,
    "q109_validation_files": f"""
        WITH {_DECISIONS}
        SELECT 'run_' || r AS run, CASE WHEN label = '' THEN 'nan' ELSE lower(label) END AS label, column_name, CASE WHEN r = 2 THEN 't' END AS decided_at, CASE WHEN r = 1 THEN 'd.jsonl' END AS dataset_file, count(*) AS n,
               count(*) FILTER (r < 2) AS images, count(*) FILTER (r = 1) AS validators, CAST(sum(length(CAST(event_id AS VARCHAR)) + 15) FILTER (r < 2) AS BIGINT) AS characters FROM d GROUP BY r, 2, column_name
    """,
    "q110_move_plan": f"""
        WITH {_RUNS}
        SELECT "from", CASE WHEN reason IS NULL THEN dest END AS "to", CASE WHEN reason IS NULL THEN ['submit', 'retrieve', 'collect_outputs', 'local'][p + 1] END AS category, reason FROM plan
    """,
    "q111_rewritten_references": f"""
        WITH {_RUNS}, m AS (SELECT DISTINCT "from", dest FROM plan WHERE reason IS NULL)
        SELECT o_orderkey, 'runs/' || coalesce(m.dest, name) || '/data/' || CASE WHEN o_orderkey % 9 = 0 THEN name ELSE 'd.jsonl' END AS dataset_path, m.dest IS NOT NULL AS fixed
        FROM orders JOIN f ON o_custkey = c_custkey LEFT JOIN m ON m."from" = name UNION ALL SELECT -1, NULL, false
    """,
    "q112_newest_of_runs": """
        WITH l AS (SELECT 'run_' || o_custkey AS run, CASE WHEN o_orderkey % 4 = 0 THEN 'current' ELSE 'd' END || o_orderkey || '.jsonl' AS name, o_orderdate AS modified, o_orderkey % 4 = 0 AS current FROM orders)
        SELECT run, name FROM l QUALIFY row_number() OVER (PARTITION BY run ORDER BY current DESC, modified DESC, name DESC) = 1
    """,
    "q113_run_providers": """
        WITH b AS (SELECT o_custkey AS k, CASE WHEN o_custkey % 3 = 0 THEN 'a' WHEN o_custkey % 3 = 1 THEN 'g' WHEN o_orderkey % 2 = 0 THEN 'g' WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'a' END AS t FROM orders),
        p AS (SELECT k, min(t) AS lo, max(t) AS hi, count(*) FILTER (t IS NULL) AS odd FROM b GROUP BY 1),
        r AS (SELECT CASE WHEN c_custkey % 11 = 0 THEN 'gemini' WHEN lo = hi AND odd = 0 THEN CASE lo WHEN 'a' THEN 'anthropic' ELSE 'gemini' END END AS provider,
                     CASE WHEN c_custkey % 11 = 0 THEN 'record' WHEN lo = hi AND odd = 0 THEN 'batches' END AS source,
                     CASE WHEN c_custkey % 11 <> 0 AND (p.k IS NULL OR lo IS NULL OR lo <> hi OR odd > 0) THEN CASE WHEN p.k IS NULL THEN 0 ELSE CASE WHEN lo IS NULL THEN 0 ELSE 1 END + 1 END END AS mixed
              FROM customer LEFT JOIN p ON p.k = c_custkey)
        SELECT provider, source, CAST(mixed AS INTEGER) AS mixed, count(*) AS n FROM r GROUP BY ALL
    """,
    "q114_chunk_records": """
        WITH c AS (SELECT l_orderkey, l_linenumber, count(*) AS n, max(l_partkey) AS p FROM lineitem GROUP BY 1, 2)
        SELECT l_orderkey, count(*) AS num_batches, CAST(sum(n) AS BIGINT) AS request_count, CAST(sum(p * 10) AS BIGINT) AS request_bytes, string_agg('batches/' || p, ',' ORDER BY l_linenumber) AS names FROM c GROUP BY 1
    """,
    "q115_tasks": """
        SELECT user_id AS task, arg_max(event_type, event_id) AS status, CAST(min(event_id) FILTER (event_id % 3 <> 0) AS VARCHAR) AS created_at, CAST(min(event_id) FILTER (event_type = 'click') AS VARCHAR) AS started_at, max(event_id) AS updated_at
        FROM events GROUP BY 1 ORDER BY updated_at DESC, task LIMIT 50
    """,
    "q116_collect_stats": """
        WITH e AS (SELECT event_id % 9 AS m, user_id % 5 AS f, CASE WHEN event_id % 9 NOT IN (0, 1) THEN event_id % 701 END AS k FROM events WHERE event_id % 9 <> 3),
        g AS (SELECT k, count(*) FILTER (m > 3) AS ok FROM e WHERE k IS NOT NULL GROUP BY 1),
        s AS (SELECT 'output_files' AS stat, count(DISTINCT f) AS n FROM e UNION ALL SELECT 'output_rows', count(*) FROM e UNION ALL SELECT 'valid_response_candidates', count(*) FROM e WHERE m > 3
              UNION ALL SELECT 'duplicate_valid_candidates', coalesce(sum(ok - 1), 0) FROM g WHERE ok > 0 UNION ALL SELECT 'unique_observed_keys', count(*) FROM g UNION ALL SELECT 'unique_valid_keys', count(*) FROM g WHERE ok > 0
              UNION ALL SELECT 'unique_rejected_only_keys', count(*) FROM g WHERE ok = 0
              UNION ALL SELECT 'rejected:' || ['invalid_jsonl_line', 'missing_key', 'batch_error'][m + 1], count(*) FROM e WHERE m < 3 GROUP BY m)
        SELECT stat, CAST(n AS BIGINT) AS n FROM s
    """,
    "q117_dashboard_counts": f"""
        WITH {_DECISIONS}
        SELECT 'dataset_count' AS section, '' AS name, count(DISTINCT o_custkey) AS n FROM orders UNION ALL SELECT 'dataset_rows', '', count(*) FROM orders
        UNION ALL SELECT 'validation_count', '', count(*) FROM d UNION ALL SELECT 'validation_label_counts', lower(label), count(*) FROM d WHERE label <> '' GROUP BY 2
        UNION ALL SELECT 'records', '', count(*) FROM events UNION ALL SELECT 'images', '', count(DISTINCT event_id % 977) FROM events UNION ALL SELECT 'status_counts', event_type, count(*) FROM events GROUP BY 2
        UNION ALL SELECT 'source_counts', 'batch', count(*) FROM events WHERE user_id % 2 = 1 HAVING count(*) > 0 UNION ALL SELECT 'failure_reasons', 'r' || user_id % 4, count(*) FROM events WHERE event_type = 'error' GROUP BY 2
    """,
    "q118_dashboard_measures": f"""
        WITH {_DECISIONS}
        SELECT 'attempts' AS name, count(*) AS n, round(avg(event_id % 4), 6) AS mean, CAST(median(event_id % 4) AS DOUBLE) AS median FROM events UNION ALL SELECT 'generation_seconds', count(value), round(avg(value), 6), round(median(value), 6) FROM events
        UNION ALL SELECT column_name, count(*), round_even(avg(CASE label WHEN 'accept' THEN 1.0 WHEN 'somewhat accept' THEN 0.5 WHEN 'Reject' THEN 0.0 WHEN 'corrected' THEN 0.0 END) * 100, 1), NULL FROM d GROUP BY 1
        UNION ALL SELECT 'latest', o_custkey, NULL, NULL FROM (SELECT o_custkey FROM orders ORDER BY o_orderkey DESC LIMIT 1)
    """,
    "q119_variant_datapoints": """
        WITH s AS (SELECT s_suppkey AS k, s_suppkey || '.png' AS name, s_name, s_nationkey FROM supplier WHERE s_suppkey % 2 = 0 AND s_suppkey / 2 IN (SELECT p_partkey FROM part))
        SELECT name, 'patient.name' AS field, s_name AS value FROM s WHERE k % 3 = 0 UNION ALL SELECT name, 'patient.note', '' FROM s WHERE k % 3 = 0
        UNION ALL SELECT name, 'patient.age.id', CAST(s_nationkey AS VARCHAR) FROM s WHERE k % 3 = 1 UNION ALL SELECT name, 'ward', CAST(k AS VARCHAR) FROM s WHERE k % 3 = 1
    """,
    "q120_dataset_coverage": "SELECT count(*) FILTER (o_orderkey % 10 <> 1) AS row_count, count(DISTINCT o_custkey) FILTER (o_orderkey % 10 > 2) AS names, CAST(0 AS BIGINT) AS records FROM orders",
    "q121_report_sinks": """
        WITH c AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 2 = 0) AS e, count(*) FILTER (o_orderkey % 5 = 0) AS f, count(*) FILTER (o_orderkey % 3 = 0) AS t0, count(*) FILTER (o_orderkey % 3 = 1) AS t1, count(*) FILTER (o_orderkey % 3 = 2) AS t2 FROM orders)
        SELECT unnest(['set', 'report', 'audit', 'decisions', 'events', 'current', 'version', 'selected_outputs', 'rejected_output_keys', 'missing_page_keys', 'summary', 'metadata']) AS what,
               unnest([n, n, f, n, n, n, e, t0, t1, t2, n, n]) AS n, unnest([e, n, f, 0, n, n, e, t0, t1, t2, 7, 1]) AS filled FROM c
    """,
    "q123_column_functions": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN 'job_state_running' WHEN o_orderkey % 3 < 2 THEN 'finalizing' ELSE 'job_state_succeeded' END AS readiness, round(o_custkey / 1000 * 0.25, 6) AS cost,
               CASE WHEN o_orderkey % 2 = 0 THEN 'retrieved_complete' ELSE 'retrieved_partial' END AS state, least(1.5 * 2.0 ** greatest(o_orderkey % 7 - 1, 0), 20.0) AS wait,
               CASE WHEN o_orderkey % 3 = 1 THEN CAST(o_custkey / 2 AS VARCHAR) ELSE '' END AS text, o_orderkey % 4 = 0 OR o_orderkey % 6 = 0 AS retry,
               CASE WHEN o_orderkey % 2 = 0 THEN 'eu-' || o_custkey % 4 END AS location, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS page FROM orders
    """,
    "q122_small_operators": """
        SELECT 'marked' AS what, count(*) FILTER (o_orderkey % 4 = 0) AS n, count(*) AS m FROM orders UNION ALL SELECT 'columns', count(*) FILTER (o_orderkey % 3 <> 0), count(*) FROM orders
        UNION ALL SELECT 'provider ' || ['gemini', 'gemini', 'anthropic', 'anthropic', 'openai', 'openai', 'openai', 'none', 'none'][o_orderkey % 9 + 1], count(*), max(o_orderkey) FROM orders GROUP BY 1
        UNION ALL SELECT 'recovery', count(*), CAST(sum(length(CAST(o_orderkey AS VARCHAR)) + 4) AS BIGINT) FROM orders
        UNION ALL SELECT 'replaced', count(*), count(*) FILTER (o_orderkey // 50 % 2 = 0) FROM orders UNION ALL SELECT 'single', max(o_orderkey), 0 FROM orders
    """,
}
