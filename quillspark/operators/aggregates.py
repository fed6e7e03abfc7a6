"""Counters, distributions, completeness and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.values import populated
from quillspark.operators.order import cut


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """value, n: rows by non-blank value, most frequent first, ties by value."""
    return df.where(populated(F.col(column).cast("string"))).groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")


def distribution(value: Column, digits: int = 6) -> list[Column]:
    """Columns n, min, max, mean over non-null numbers; ``medians`` has the rest."""
    return [F.count(value).alias("n"), F.round(F.min(value), digits).alias("min"), F.round(F.max(value), digits).alias("max"), F.round(F.avg(value), digits).alias("mean")]


def medians(df: DataFrame, value: str, by: str | None = None, digits: int = 6) -> DataFrame:
    """_g, _by, median: of all non-null numbers (``_g`` is 1) and, with ``by``, of each group (0); of an even count the mean of the middle two.

    Equal numbers are counted first and dealt by ranges of group and number; only the ranges that hold a group's middle, two at
    most, are ordered, so no task holds a whole group. A group without numbers has no row.
    """
    group = F.col(by) if by else F.lit(None).cast("string")
    counts = df.where(F.col(value).isNotNull()).groupBy(group.alias("_by"), F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_g", F.lit(0 if by else 1))
    if by:
        whole = counts.groupBy("_v").agg(F.sum("_n").alias("_n"))
        counts = counts.unionByName(whole.withColumns({"_g": F.lit(1), "_by": F.lit(None).cast(df.schema[by].dataType)}))
    ranged = cut(counts.repartitionByRange("_g", "_by", "_v").withColumn("_part", F.spark_partition_id()))
    group = Window.partitionBy("_g", "_by")
    sizes = ranged.groupBy("_g", "_by", "_part").agg(F.sum("_n").alias("_m"))
    before = F.coalesce(F.sum("_m").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumns({"_before": before, "_all": F.sum("_m").over(group)})
    low, high = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)
    within = lambda place, start, n: (start <= place) & (place < start + n)
    start, m = F.col("_before"), F.col("_m")
    middle = sizes.where(within(low, start, m) | within(high, start, m)).select(F.col("_g").alias("_g2"), F.col("_by").alias("_by2"), F.col("_part").alias("_part2"), "_before", "_all")
    held = ranged.join(middle, (F.col("_g") == F.col("_g2")) & F.col("_by").eqNullSafe(F.col("_by2")) & (F.col("_part") == F.col("_part2")))
    upto = F.sum("_n").over(Window.partitionBy("_g", "_by", "_part").orderBy("_v"))
    held = held.withColumn("_start", F.col("_before") + upto - F.col("_n"))
    pick = lambda place: F.max(F.when(within(place, F.col("_start"), F.col("_n")), F.col("_v")))
    return held.groupBy("_g", "_by").agg(F.round((pick(low) + pick(high)) / 2, digits).alias("median"))


def distributions(df: DataFrame, value: str, by: str | None = None) -> DataFrame:
    """n, min, max, mean, median, grp: over all rows (``grp`` is ``total``) and, with ``by``, over each group."""
    middle = medians(df, value, by)
    if by is None:
        return df.agg(*distribution(F.col(value))).join(F.broadcast(middle.select("median")), F.lit(True), "left").withColumn("grp", F.lit("total"))
    sets = df.groupingSets([[], [F.col(by)]], F.col(by)).agg(F.grouping_id().alias("_s"), *distribution(F.col(value)))
    held = sets.join(middle, (F.col("_s") == F.col("_g")) & F.col(by).eqNullSafe(F.col("_by")), "left")
    return held.select("n", "min", "max", "mean", "median", F.when(F.col("_s") == 1, "total").otherwise(F.col(by).cast("string")).alias("grp"))


def processing_summary(df: DataFrame, item: str, status: str, duration: str) -> DataFrame:
    """One row: records, distinct non-blank items, the duration's distribution, and statuses as a sorted text ``status=n``."""
    counts = df.where(populated(F.col(status))).groupBy(F.col(status).alias("s")).agg(F.count(F.lit(1)).alias("k"))
    line = counts.agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "s", "k"))), ",").alias("statuses"))
    items = F.count_distinct(F.when(populated(F.col(item).cast("string")), F.col(item)))
    one = df.agg(F.count(F.lit(1)).alias("records"), items.alias("items"), *distribution(F.col(duration)))
    return one.join(F.broadcast(medians(df, duration).select("median")), F.lit(True), "left").join(F.broadcast(line), F.lit(True))


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, populated, missing, completeness (percent), rank: of each column, least complete first.

    One aggregate over the table, unpivoted afterwards; without rows completeness is 0.
    """
    kinds = dict(df.dtypes)
    kind = lambda c: "array" if kinds[c].startswith("array") else "map" if kinds[c].startswith("map") else "string" if kinds[c] == "string" else "other"
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(populated(F.col(c), kind(c))).alias(c) for c in columns])
    long = one.unpivot("_rows", list(columns), "column_name", "populated")
    percent = F.when(F.col("_rows") == 0, 0.0).otherwise(F.round(F.col("populated") / F.col("_rows") * 100, 4))
    out = long.select("column_name", "populated", (F.col("_rows") - F.col("populated")).alias("missing"), percent.alias("completeness"))
    return out.withColumn("rank", F.row_number().over(Window.orderBy("completeness", "column_name")).cast("long"))


def grouping_summary(df: DataFrame, first: str, second: str, value: str) -> DataFrame:
    """Rows and the sum of ``value`` over the whole table, by ``first`` and by ``second``, from one scan."""
    sets = df.groupingSets([[], [F.col(first)], [F.col(second)]], F.col(first), F.col(second))
    return sets.agg(F.grouping_id().cast("long").alias("level"), F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))


def duplicates(df: DataFrame, key: Column, name: str = "name") -> DataFrame:
    """name, n: keys of more than one row."""
    return df.where(key.isNotNull()).groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def failure_reasons(df: DataFrame, item: str, reason: str, examples: int = 12) -> DataFrame:
    """reason, n, examples: distinct failed items by reason, most frequent first, with the smallest items as examples."""
    pairs = df.select(F.col(item).cast("string").alias("item"), F.col(reason).alias("reason")).where("reason IS NOT NULL AND item IS NOT NULL").distinct()
    least = Window.partitionBy("reason").orderBy("item")
    shown = pairs.withColumn("k", F.row_number().over(least)).where(F.col("k") <= examples).groupBy("reason").agg(F.array_join(F.array_sort(F.collect_list("item")), ",").alias("examples"))
    counted = pairs.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(shown, "reason").orderBy(F.desc("n"), "reason")


def rejected_only(df: DataFrame, key: str, valid: Column, reason: str) -> DataFrame:
    """key, reason, n: reasons of the keys that have no valid row."""
    per = df.withColumn("_ok", valid).groupBy(key).agg(F.bool_or("_ok").alias("ok")).where("not ok").select(key)
    return df.join(per, key, "left_semi").groupBy(key, reason).agg(F.count(F.lit(1)).alias("n"))


def path_summary(paths: DataFrame, path: str) -> DataFrame:
    """kind, name, n: files by extension (``<none>`` without), by depth and by folder."""
    parts = F.split(F.col(path), "/")
    name = F.element_at(parts, -1)
    ext = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))
    folder = F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")
    kinds = F.array(
        F.struct(F.lit("extension").alias("kind"), F.when(ext == "", "<none>").otherwise(ext).alias("name")),
        F.struct(F.lit("depth").alias("kind"), F.lpad((F.size(parts) - 1).cast("string"), 3, "0").alias("name")),
        F.struct(F.lit("folder").alias("kind"), F.when(folder == "", ".").otherwise(folder).alias("name")),
    )
    return paths.where(F.col(path).isNotNull()).select(F.explode(kinds).alias("k")).groupBy("k.kind", "k.name").agg(F.count(F.lit(1)).alias("n"))


def ancestors(paths: DataFrame, path: str) -> DataFrame:
    """folder, n: every folder above a file, with the files below it; the root is the empty text."""
    parts = F.split(F.col(path), "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    return paths.where(F.col(path).isNotNull()).select(F.explode(above).alias("folder")).groupBy("folder").agg(F.count(F.lit(1)).alias("n"))


def prefix_choices(paths: DataFrame, path: str, updated: str, limit: int = 20) -> DataFrame:
    """prefix, n, latest, rank: first path segments by their latest change, ties by name; at most ``max(1, limit)``."""
    first = F.regexp_extract(F.regexp_replace(F.col(path), "^/+", ""), "^[^/]*", 0)
    counted = paths.where(F.col(path).isNotNull()).groupBy(first.alias("prefix")).agg(F.count(F.lit(1)).alias("n"), F.max(updated).alias("latest"))
    top = counted.orderBy(F.desc("latest"), "prefix").limit(max(1, limit))
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("latest"), "prefix")).cast("long"))


def sample_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``max(1, n)`` keys in order, with their rank: a top-k that never sorts the whole table."""
    top = df.select(key).distinct().orderBy(key).limit(max(1, n))
    return top.withColumn("rank", F.row_number().over(Window.orderBy(key)).cast("long"))


def integer_stats(df: DataFrame, value: str) -> DataFrame:
    """One row: n, total (0 of nothing), min, max, mean, median of whole numbers."""
    v = F.col(value)
    one = df.agg(F.count(v).alias("n"), F.coalesce(F.sum(v), F.lit(0)).cast("long").alias("total"), F.min(v).cast("long").alias("min"), F.max(v).cast("long").alias("max"), F.round(F.avg(v), 6).alias("mean"))
    return one.join(F.broadcast(medians(df, value).select("median")), F.lit(True), "left")


def distinct_prefixes(paths: DataFrame, path: str, limit: int) -> DataFrame:
    """prefix: distinct first segments in order, at most ``max(1, limit)``."""
    first = F.regexp_extract(F.regexp_replace(F.col(path), "^/+", ""), "^([^/]+)/", 1)
    return paths.select(first.alias("prefix")).where("prefix != ''").distinct().orderBy("prefix").limit(max(1, limit))


def ordered_distinct(df: DataFrame, key: str, seq: str) -> DataFrame:
    """key, seq: each key with its first place."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(seq).alias(seq))
