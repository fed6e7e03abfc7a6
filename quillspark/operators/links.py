"""Joins between jobs, items, mappings and lookups, and filters over job and model lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import failed_state, identity, succeeded
from quillspark.operators import nested
from quillspark.operators.nested import flat_columns

#: Rows that a task of a join by run sorts, about.
TASK_ROWS = 500_000


def unique_map(objects: DataFrame, ref: str) -> DataFrame:
    """name, object: the object of each base name; a name of several objects fails the job, naming one."""
    held = objects.where(identity(F.col(ref)).isNotNull()).groupBy(identity(F.col(ref)).alias("name")).agg(F.min(ref).alias("object"), F.count(F.lit(1)).alias("_n"))
    return held.select("name", F.when(F.col("_n") == 1, F.col("object")).otherwise(F.raise_error(F.concat(F.lit("several objects are called "), "name")).cast("string")).alias("object"))


def duplicate_names(objects: DataFrame, ref: str) -> DataFrame:
    """name, n: base names that several objects have."""
    return objects.where(identity(F.col(ref)).isNotNull()).groupBy(identity(F.col(ref)).alias("name")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def datapoints(rows: DataFrame, index: DataFrame, key: Column, name: str, fields: list[str] | None = None) -> DataFrame:
    """name, field, value: the fields of rows whose image is known, unpivoted; null values are no datapoints, empty ones are.

    Arrays are left out; without ``fields`` every other leaf but the index's name is taken.
    """
    leaves = [(n, c) for n, c in flat_columns(rows.schema) if (fields is None and n != name) or n in (fields or [])]
    kinds = dict(rows.select(*[c.alias(n) for n, c in leaves]).dtypes)
    cells = F.array(*[F.struct(F.lit(n).alias("field"), c.cast("string").alias("value")) for n, c in leaves if not kinds[n].startswith(("array", "map"))])
    known = index.select(F.col(name).alias("_name")).distinct()
    held = rows.select(key.alias("_key"), F.explode(cells).alias("cell")).where("cell.value IS NOT NULL")
    return held.join(known, F.col("_key") == F.col("_name"), "left_semi").select(F.col("_key").alias("name"), "cell.field", "cell.value")


def eligible_leaves(rows: DataFrame, key: str, value: str, paths: set[str]) -> DataFrame:
    """key, path, value: of each row's VARIANT the leaves that may be validated: in the schema (``paths``, dotted), not null,
    no array and no object; an empty text is one. Rows may have unlike leaves."""
    leaves = nested.variant_leaves(rows, key, value, depth=max((p.count(".") + 1 for p in paths), default=1))
    return leaves.where(F.col("path").isin(paths) & ~F.col("kind").rlike("^(VOID|ARRAY|OBJECT)")).select("key", "path", "value")


def variant_datapoints(rows: DataFrame, key: str, value: str, index: DataFrame, name: str, paths: set[str]) -> DataFrame:
    """name, field, value: the eligible leaves of the rows whose image is known. A row without identity has none."""
    known = index.select(F.col(name).alias("key")).where("key IS NOT NULL").distinct()
    held = rows.where(F.col(key).isNotNull()).join(known, F.col(key) == F.col("key"), "left_semi")
    return eligible_leaves(held, key, value, paths).select(F.col("key").alias("name"), F.col("path").alias("field"), "value")


def resolved_keys(results: DataFrame, mapping: DataFrame, custom: str = "custom_id", key: str = "key") -> DataFrame:
    """``results`` with their key; an id that the mapping lacks stands for itself.

    An id that is mapped to two keys fails the job, naming the id.
    """
    one = mapping.groupBy(custom).agg(F.min(key).alias("_a"), F.max(key).alias("_b"))
    one = one.select(custom, F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(F.raise_error(F.concat(F.lit("two keys for "), custom)).cast("string")).alias("_key"))
    return results.join(one, custom, "left").withColumn(key, F.coalesce("_key", F.col(custom))).drop("_key")


def with_parent(jobs: DataFrame, job: str, candidates: list[str]) -> DataFrame:
    """``jobs`` with parent: the first of the candidate references that is a job."""
    out = jobs
    known = jobs.select(F.col(job).alias("_known")).distinct()
    for k, c in enumerate(candidates):
        out = out.join(known.withColumnRenamed("_known", f"_p{k}"), F.col(c) == F.col(f"_p{k}"), "left")
    found = [f"_p{k}" for k in range(len(candidates))]
    return out.withColumn("parent", F.coalesce(*found)).drop(*found)


def is_retry(role: Column, *sources: Column) -> Column:
    return reduce(lambda a, b: a | b, ((F.coalesce(s, F.lit("")) != "") for s in sources), F.coalesce(role == "retry", F.lit(False)))


def poll_candidates(jobs: DataFrame, status: str) -> DataFrame:
    """Jobs with a status that are not retrieved yet."""
    s = F.coalesce(F.col(status), F.lit(""))
    return jobs.where((s != "") & ~s.startswith("retrieved"))


def visible(datasets: DataFrame, run: str, kind: str) -> DataFrame:
    """Datasets without those of runs that have a ``current`` one, which alone is shown.

    Rows are counted first and dealt by run to tasks of about ``TASK_ROWS``, since partitions that are merged by their bytes,
    compressed, would give a task more rows to sort the larger the table is. ``datasets`` is read three times.
    """
    tasks = max(1, -(-datasets.count() // TASK_ROWS))
    current = datasets.where(F.col(kind) == "current").select(F.col(run).alias("_run")).repartition(tasks, "_run").distinct()
    return datasets.repartition(tasks, run).join(current, (F.col(run) == F.col("_run")) & (F.col(kind) != "current"), "left_anti")


def model_search(models: DataFrame, query: str, *columns: str, limit: int = 50) -> DataFrame:
    """Models whose names contain the query, in any case; at most ``max(1, limit)``, by name."""
    low = query.strip().lower()
    hit = reduce(lambda a, b: a | b, (F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(low)) for c in columns))
    return models.where(hit).orderBy(*columns).limit(max(1, limit))


def transitions(jobs: DataFrame, status: str, missing: str) -> DataFrame:
    """``jobs`` with next_status: retrieved, complete or partial, once they have ended well; failed; else as they are."""
    s = F.col(status)
    done = F.when(F.col(missing) == 0, "retrieved_complete").otherwise("retrieved_partial")
    return jobs.withColumn("next_status", F.when(succeeded(s), done).when(failed_state(s), "failed").otherwise(s))


def cache_hits(requests: DataFrame, cached: DataFrame, key: list[str]) -> DataFrame:
    """``requests`` with signature and hit: a SHA-256 over the named columns as sorted JSON, and whether it was seen."""
    signature = F.sha2(F.to_json(F.struct(*sorted(key)), {"ignoreNullFields": "false"}).cast("binary"), 256)
    seen = cached.select(F.col("signature").alias("_seen")).distinct()
    return requests.withColumn("signature", signature).join(seen, F.col("signature") == F.col("_seen"), "left").withColumn("hit", F.col("_seen").isNotNull()).drop("_seen")
