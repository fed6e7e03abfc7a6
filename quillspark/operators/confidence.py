"""Token probabilities attributed to the fields of a JSON answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import json_spans
from quillspark.functions.text import stripped
from quillspark.operators import responses
from quillspark.operators.rows import LEAF


def token_spans(df: DataFrame, key: str, place: str, token: str) -> DataFrame:
    """``df`` (a row a token) with start and stop: running sums of token lengths within each key."""
    before = Window.partitionBy(key).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    size = F.char_length(F.coalesce(F.col(token), F.lit("")))
    out = df.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)).cast("long"))
    return out.withColumn("stop", F.col("start") + size)


def widest_overlap(spans: DataFrame, leaves: DataFrame, key: str, place: str, span: int = 64) -> DataFrame:
    """Each span with the leaf that it shares most with, ties to the leaf that starts first; spans without a leaf are dropped.

    Both have ``key``, start and stop; ``leaves`` also leaf. An interval join within each key through buckets of ``span``
    characters, so a long text's spans meet only the leaves near them.
    """
    bucket = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / span), F.floor(F.greatest(F.col(b) - 1, F.col(a)) / span)))
    s = spans.withColumn("_b", bucket("start", "stop"))
    l = leaves.select(F.col(key), F.col("leaf"), F.col("start").alias("_ls"), F.col("stop").alias("_le"))
    l = l.withColumn("_b", bucket("_ls", "_le"))
    shared = F.least("stop", "_le") - F.greatest("start", "_ls")
    met = s.join(l, [key, "_b"]).withColumn("overlap", shared).where("overlap > 0")
    return met.groupBy(key, place).agg(F.max_by(F.struct("leaf", "overlap"), F.struct("overlap", -F.col("_ls"))).alias("_m")).select(key, place, "_m.leaf", "_m.overlap")


def clamped_confidence(mean_logprob: Column) -> Column:
    """exp of a mean log-probability, within 0 and 1; null stays null."""
    return F.when(mean_logprob.isNotNull(), F.greatest(F.least(F.exp(mean_logprob), F.lit(1.0)), F.lit(0.0)))


def leaf_confidence(df: DataFrame, key: str, leaf: str, logprob: str) -> DataFrame:
    """key, leaf, logprob (mean), ratio: of each leaf; leaves without any probability are left out."""
    out = df.groupBy(key, leaf).agg(F.avg(logprob).alias("logprob")).where("logprob IS NOT NULL")
    return out.withColumn("ratio", clamped_confidence(F.col("logprob")))


def payload_offset(tokens_text: Column, payload: Column) -> Column:
    """Where a payload begins in the joined text of its tokens, from 0: as it is, else without white space at its ends; null if
    it is not there, or blank."""
    whole, bare = F.instr(tokens_text, payload), F.instr(tokens_text, stripped(payload))
    return F.when(stripped(payload) == "", None).when(whole > 0, whole - 1).when(bare > 0, bare - 1)


def with_field_confidence(df: DataFrame, candidates: str, payload: str, name: str = "field_confidence_by_pointer") -> DataFrame:
    """``df`` with a map from the JSON pointers of the leaves of ``payload`` to field_confidence_logprobs and _ratio.

    ``candidates`` is a column of ``responses.candidates``: the first one's chosen tokens are laid over the payload from where
    it begins in their joined text, and each counts for the leaf it shares most with. Leaves without a token have null
    measures. The map is empty if the payload is null or no JSON, is not in the tokens' text, or no leaf has a token. All of a
    row happens in the row: nothing is shuffled, and of Python there is one Arrow call over lengths and numbers.
    """
    held = df.withColumn("_tokens", responses.chosen_tokens(F.col(candidates)))
    text = F.array_join(F.transform("_tokens", lambda t: t["token"]), "")
    sizes, values = F.transform("_tokens", lambda t: F.char_length(t["token"])), F.transform("_tokens", lambda t: t["logprob"])
    leaves = json_spans.logprobs(F.col(payload), payload_offset(text, F.col(payload)), sizes, values)
    held = held.withColumn("_leaves", F.coalesce(leaves, F.array().cast(json_spans.LOGPROBS)))
    entry = lambda l: F.struct(l["leaf"].alias("key"), F.struct(l["logprob"].alias("field_confidence_logprobs"), clamped_confidence(l["logprob"]).alias("field_confidence_ratio")).cast(LEAF).alias("value"))
    return held.withColumn(name, F.map_from_entries(F.transform("_leaves", entry))).drop("_tokens", "_leaves")


def with_response_metadata(df: DataFrame, response: str) -> DataFrame:
    """``df`` with text, thoughts, avg_logprobs and field_confidence_by_pointer of a VARIANT response, whose candidates are
    parsed once. A null response, or one without candidates, has nulls and an empty map."""
    held = df.withColumn("_candidates", responses.candidates(F.col(response)))
    c = F.col("_candidates")
    held = held.withColumns({"text": responses.candidates_text(c, F.col(response)), "thoughts": responses.candidates_thoughts(c), "avg_logprobs": responses.candidates_mean(c)})
    return with_field_confidence(held, "_candidates", "text").drop("_candidates")
