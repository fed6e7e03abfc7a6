"""Reports and records of runs: summaries of errors and states, derived results, events, versions, libraries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators.aggregates import distributions, value_counts
from quillspark.operators.order import with_index
from quillspark.operators.scoring import metric_summary, run_summary
from quillspark.operators.skew import lookup


def error_summary(errors: DataFrame, reason: str, item: str, order: str, examples: int = 5) -> DataFrame:
    """summary: one text over all errors: their number, reasons by frequency (ties by the first that came), first examples, how many more.

    Without errors the text is empty.
    """
    said = F.coalesce(F.nullif(F.col(reason), F.lit("")), F.lit("unknown"))
    counts = errors.groupBy(said.alias("r")).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "first", F.concat_ws(" ", F.col("n").cast("string"), "r").alias("line"))))
    one = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.array_join(F.transform(ranked, lambda x: x["line"]), ", ").alias("reasons"))
    shown = errors.orderBy(order).limit(examples).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, F.concat(F.col(item), F.lit(": "), F.coalesce(F.col(reason), F.lit("None"))).alias("line")))), lambda x: x["line"]), "; ").alias("shown"))
    more = F.when(F.col("n") > examples, F.concat(F.lit("; +"), (F.col("n") - examples).cast("string"), F.lit(" more"))).otherwise("")
    whole = F.concat(F.lit("API recovery failed for "), F.col("n").cast("string"), F.lit(" page(s): "), "reasons", F.lit(". "), "shown", more)
    return one.join(F.broadcast(shown)).select(F.when(F.col("n") > 0, whole).otherwise("").alias("summary"))


def status_rollup(records: DataFrame, status: str, name: str) -> DataFrame:
    """One row: status (error if any record has one or there is none, else warning, else ok), total, ok, warning, error, duplicate_names."""
    doubled = records.groupBy(name).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("duplicate_names"))
    s = F.col(status)
    one = records.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(s == k).alias(k) for k in ("ok", "warning", "error")])
    rolled = F.when((F.col("error") > 0) | (F.col("total") == 0), "error").when(F.col("warning") > 0, "warning").otherwise("ok")
    return one.join(F.broadcast(doubled)).select(rolled.alias("status"), "*")


def derived_results(jobs: DataFrame, expected: DataFrame, produced: DataFrame, outputs: DataFrame, job: str, name: str) -> DataFrame:
    """Results of jobs without a results file, from what there is: requests, rows produced and output lines.

    ``jobs`` has the job and request_count; the others a row a request, dataset row and output line, the first two with names.
    Expected pages are the distinct names asked for, else the request count, else the names produced; successful ones are the
    produced among them; observed ones the output lines, else the expected.
    """
    asked = expected.where(F.col(name).isNotNull()).select(job, name).distinct()
    got = produced.groupBy(job, name).agg(F.count(F.lit(1)).alias("rows"))
    met = got.where(F.col(name).isNotNull()).join(asked.withColumn("_asked", F.lit(1)), [job, name], "full")
    met = met.groupBy(job).agg(F.count("_asked").alias("_asked"), F.count("rows").alias("_covered"), F.count_if(F.col("_asked").isNotNull() & F.col("rows").isNotNull()).alias("_both"))
    written = got.groupBy(job).agg(F.sum("rows").alias("rows_written"))
    lines = outputs.groupBy(job).agg(F.count(F.lit(1)).alias("_lines"))
    held = jobs.join(met, job, "left").join(written, job, "left").join(lines, job, "left").fillna(0, ["_asked", "_covered", "_both", "rows_written", "_lines", "request_count"])
    some = lambda *c: F.coalesce(*[F.nullif(F.col(x) if isinstance(x, str) else x, F.lit(0)) for x in c], F.lit(0))
    held = held.withColumn("expected_pages", some("_asked", "request_count", "_covered")).withColumn("successful_pages", F.when(F.col("_asked") > 0, F.col("_both")).otherwise(F.col("_covered")))
    held = held.withColumn("observed_pages", some("_lines", "expected_pages"))
    less = lambda a, b: F.greatest(F.col(a) - F.col(b), F.lit(0))
    return held.select(job, "rows_written", "expected_pages", "observed_pages", "successful_pages", less("expected_pages", "successful_pages").alias("missing_pages"), less("observed_pages", "successful_pages").alias("error_rows"))


def dashboard(datasets: DataFrame, validations: DataFrame, rows: str, updated: str, label: str) -> DataFrame:
    """One row: dataset_count, rows, latest, and validations by label as a sorted text ``label=n``."""
    one = datasets.agg(F.count(F.lit(1)).alias("dataset_count"), F.coalesce(F.sum(rows), F.lit(0)).cast("long").alias("rows"), F.max(updated).alias("latest"))
    labels = value_counts(validations, label).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "value", F.col("n").cast("string")))), ",").alias("labels"))
    return one.join(F.broadcast(labels))


#: Counters of processing records, and the columns that they count.
COUNTERS = {"status_counts": "status", "source_counts": "source", "failure_reasons": "failure_reason", "duplicate_actions": "duplicate_action"}


def processing_counters(records: DataFrame, image: str = "image_name") -> DataFrame:
    """section, name, n: all counters of processing records from one scan: each record's facts are unpivoted, so that they
    are counted together; blank ones do not count. ``records`` and ``images`` (distinct names) are sections of one row."""
    text = lambda c: F.when(F.trim(F.col(c).cast("string")) != "", F.col(c).cast("string"))
    facts = F.array(F.struct(F.lit("records").alias("section"), F.lit("").alias("name")), *[F.struct(F.lit(s).alias("section"), text(c).alias("name")) for s, c in {**COUNTERS, "images": image}.items() if c in records.columns])
    counts = records.select(F.explode(facts).alias("f")).where("f.name IS NOT NULL").groupBy("f.section", "f.name").agg(F.count(F.lit(1)).alias("n"))
    one = F.col("section") == "images"
    # A row an image is left of the images; they are counted by a second aggregate, which combines first.
    return counts.groupBy("section", F.when(one, F.lit("")).otherwise(F.col("name")).alias("name")).agg(F.sum(F.when(one, 1).otherwise(F.col("n"))).alias("n"))


def dashboard_bundle(datasets: DataFrame, validations: DataFrame, records: DataFrame, rows: str, updated: str, dataset: str) -> dict[str, DataFrame]:
    """The parts of a dashboard: ``counts`` (section, name, n), ``measures`` (attempts and generation_seconds, where there are
    such columns), ``runs`` and ``metrics`` of the validations, and ``latest``, the newest dataset.

    Records are read once for all counters, validations once for labels, runs and metrics each.
    """
    one = datasets.agg(F.count(F.lit(1)).alias("dataset_count"), F.coalesce(F.sum(rows), F.lit(0)).cast("long").alias("dataset_rows"))
    held = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("section"), F.lit("").alias("name"), F.col(c).cast("long").alias("n")) for c in one.columns])).alias("s")).select("s.*")
    labels = validations.groupBy(F.coalesce(F.lower("label"), F.lit("")).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    # Each label counts for itself, if it is not blank, and for the number of all.
    both = F.array(F.struct(F.lit("validation_label_counts").alias("section"), F.col("name").alias("label")), F.struct(F.lit("validation_count").alias("section"), F.lit("").alias("label")))
    labels = labels.select(F.explode(both).alias("s"), "n").where("s.section = 'validation_count' OR trim(s.label) <> ''").groupBy("s.section", F.col("s.label").alias("name")).agg(F.sum("n").alias("n"))
    counts = held.unionByName(labels).unionByName(processing_counters(records))
    measures = None
    for c in ("attempts", "generation_seconds"):
        if c in records.columns:
            own = distributions(records.where(F.col(c).isNotNull()), c).drop("grp").withColumn("measure", F.lit(c))
            measures = own if measures is None else measures.unionByName(own)
    latest = datasets.orderBy(F.desc(updated), dataset).limit(1).select(dataset)
    runs = run_summary(validations, "_validation_run", "label", "_validation_place", {"dataset_file": "dataset_file", "validator_id": "validator_id"})
    return {"counts": counts, "measures": measures, "runs": runs, "metrics": metric_summary(validations, "label", "column_name"), "latest": latest}


def newest_events(events: DataFrame, job: str, wanted: str | int, order: str, limit: int) -> DataFrame:
    """The last ``max(1, limit)`` events of one job, newest first."""
    return events.where(F.col(job) == wanted).orderBy(F.desc(order)).limit(max(1, limit))


def versions(records: DataFrame, job: str, version: str) -> DataFrame:
    """``records`` with place: 1 for a job's newest version, and so on, a null version last; a null job is a job too.

    Rows are numbered in one global order, and a job's places counted back from its last, so no job's rows meet in one task.
    """
    held = with_index(records, job, version, name="_number")
    last = held.groupBy(job).agg(F.max("_number").alias("_last"), F.count(F.lit(1)).alias("_n"))
    known = lookup(held.where(F.col(job).isNotNull()), last, [job], size="_n")
    none = held.where(F.col(job).isNull()).join(F.broadcast(last.where(F.col(job).isNull()).drop(job)), F.lit(True))
    return known.unionByName(none).withColumn("place", (F.col("_last") - F.col("_number") + 1).cast("long")).select(*records.columns, "place")


def by_run(records: DataFrame, run: str, legacy: str, order: str) -> DataFrame:
    """The last record of each run folder; a record without one stands for its legacy folder, without either it is left out."""
    folder = F.coalesce(F.nullif(F.trim(run), F.lit("")), F.nullif(F.trim(legacy), F.lit("")))
    keyed = records.withColumn("run_folder", folder).where("run_folder IS NOT NULL")
    return keyed.groupBy("run_folder").agg(F.max_by(F.struct(*records.columns), order).alias("_r")).select("run_folder", "_r.*")


def capped_library(objects: DataFrame, name: str, updated: str, limit: int) -> DataFrame:
    """Datasets among listed objects: the first ``max(1, limit)`` by name, and only those sorted by their change, newest first."""
    held = objects.where(~F.col(name).endswith("/") & F.lower(F.col(name)).rlike("[^/]\\.(jsonl|csv)$"))
    return held.orderBy(name).limit(max(1, limit)).orderBy(F.desc(updated), name)


def input_location(bucket: Column, pages: Column, prefixes: Column, restricted: Column, target: Column) -> Column:
    """Where a job's inputs came from: scoped images, prefixes, or the pages of a bucket. ``prefixes`` is an array, ``restricted`` a count."""
    tidy = lambda p: F.regexp_replace(F.trim(F.coalesce(p, F.lit(""))), "^/+|/+$", "")
    has = F.coalesce(bucket, F.lit("")) != ""
    uri = lambda p: F.when(has, F.regexp_replace(F.concat(F.lit("gs://"), bucket, F.lit("/"), p), "/+$", "")).otherwise(F.when(p == "", "(bucket prefix)").otherwise(p))
    named = F.filter(F.coalesce(prefixes, F.array().cast("array<string>")), lambda p: F.trim(F.coalesce(p, F.lit(""))) != "")
    folder = F.coalesce(F.nullif(F.regexp_extract(F.regexp_replace(F.coalesce(target, F.lit("")), "/+$", ""), "[^/]*$", 0), F.lit("")), F.nullif(target, F.lit("")), F.lit("local folder"))
    scoped = F.concat(folder, F.lit(" — "), restricted.cast("string"), F.lit(" scoped image(s) in "), uri(tidy(pages)))
    return F.when(F.coalesce(restricted, F.lit(0)) > 0, scoped).when(F.size(named) > 0, F.array_join(F.transform(named, lambda p: uri(tidy(p))), ", ")).otherwise(uri(tidy(pages)))
