"""Moving run folders into one folder a kind, and what refers to them with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators.skew import lookup

#: Folders of the kinds of runs, and what older folders' names begin with.
FOLDERS = {"submit": "submits", "retrieve": "retrieves", "collect_outputs": "collect_outputs", "local": "local"}
PREFIXES = {"submit": "submit_", "retrieve": "retrieve_", "collect_outputs": "collect_outputs_"}


def kind_of(name: Column) -> Column:
    """The kind that an older folder's name tells: by what it begins with, or a bare time; null for others."""
    out = F.lit(None).cast("string")
    for kind, start in reversed(PREFIXES.items()):
        out = F.when(name.startswith(start), kind).otherwise(out)
    return F.coalesce(out, F.when(name.rlike(r"^\d{8}_\d{6}$"), "local"))


def destination(name: Column) -> Column:
    """folder/name that an older folder moves to; null where its kind is not known."""
    kind = kind_of(name)
    folder = F.coalesce(*[F.when(kind == k, v) for k, v in FOLDERS.items()])
    bare = F.coalesce(*[F.when((kind == k) & name.startswith(v), F.substring(name, F.lit(len(v) + 1), F.char_length(name))) for k, v in PREFIXES.items()], name)
    return F.concat(folder, F.lit("/"), bare)


def move_plan(folders: DataFrame, name: str, there: DataFrame) -> DataFrame:
    """from, to, category, reason: what moving the older folders would do; a reason says why one stays.

    ``there`` (to) are folders already in place. Of several that would move to one place the first by name does. Folders of
    the kinds themselves are no runs. Names should be distinct; an empty table gives an empty plan.
    """
    held = folders.select(F.col(name).alias("from")).where(F.col("from").isNotNull() & ~F.col("from").isin(*FOLDERS.values())).distinct()
    held = held.withColumns({"category": kind_of(F.col("from")), "to": destination(F.col("from"))})
    firsts = held.where("to IS NOT NULL").groupBy("to").agg(F.min("from").alias("_first"), F.count(F.lit(1)).alias("_n"))
    firsts = firsts.join(there.select("to", F.lit(True).alias("_taken")).distinct(), "to", "left")
    out = lookup(held, firsts, ["to"], "left", size="_n")
    reason = F.when(F.col("to").isNull(), "unrecognised").when(F.col("_taken") | (F.col("from") != F.col("_first")), "destination exists")
    return out.select("from", F.when(reason.isNull(), F.col("to")).alias("to"), F.when(reason.isNull(), F.col("category")).alias("category"), reason.alias("reason"))


def rewritten(references: DataFrame, path: str, plan: DataFrame) -> DataFrame:
    """``references`` with their paths as after the moves of ``plan``, and ``fixed``: whether a path changed.

    A component of a path that is a moved folder's name gives way to its new place; the last one, the file's, never does.
    Each distinct path is looked at once, and its components meet the plan by a join, whatever the plan's size.
    """
    moves = plan.where("to IS NOT NULL").select(F.col("from").alias("_part"), F.col("to").alias("_to"))
    paths = references.select(F.col(path).alias("_path")).where("_path IS NOT NULL").distinct()
    each = paths.select("_path", F.posexplode(F.split("_path", "/")).alias("_at", "_part"))
    last = F.col("_at") == F.size(F.split("_path", "/")) - 1
    found = lookup(each.withColumn("_last", last), moves, ["_part"], "left")
    piece = F.struct("_at", F.when(F.col("_last"), F.col("_part")).otherwise(F.coalesce("_to", "_part")).alias("p"))
    new = found.groupBy("_path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda s: s["p"]), "/").alias("_new"), F.count(F.lit(1)).alias("_n"))
    held = lookup(references.withColumn("_path", F.col(path)), new.drop("_n"), ["_path"], "left")
    return held.withColumns({"fixed": F.coalesce(F.col("_new") != F.col(path), F.lit(False)), path: F.coalesce("_new", path)}).drop("_path", "_new")


def documented(runs: DataFrame, name: str, kind: str, created: str) -> DataFrame:
    """``runs`` with the kind their folder tells, and a time of creation from the name where there is none."""
    when = F.regexp_replace(F.regexp_extract(name, r"^\d{8}_\d{6}", 0), r"^(\d{4})(\d\d)(\d\d)_(\d\d)(\d\d)(\d\d)$", "$1-$2-$3T$4:$5:$6")
    return runs.withColumns({kind: F.coalesce(*[F.when(F.col("folder") == v, k) for k, v in FOLDERS.items()], F.col(kind)), created: F.coalesce(F.nullif(F.col(created), F.lit("")), when)})


def newest_of_runs(listing: DataFrame, run: str, name: str, modified: str, current: Column) -> DataFrame:
    """run, name, modified: of each run the dataset that counts: a current one before any other, then the newest, ties by name.

    An aggregate that combines before the shuffle, not an order over all.
    """
    best = F.max_by(F.struct(F.col(name).alias("name"), F.col(modified).alias("modified")), F.struct(current, modified, name))
    return listing.where(F.col(run).isNotNull()).groupBy(run).agg(best.alias("_b")).select(run, "_b.*")
