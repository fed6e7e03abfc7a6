"""Model responses in VARIANT: texts, thoughts, probabilities, and what is wrong with a record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import stripped
from quillspark.operators.order import cut
from quillspark.operators.skew import lookup

PART = "array<struct<text:string,thought:boolean>>"
TOKENS = "array<struct<token:string,logProbability:double,log_probability:double>>"
CHOSEN = f"struct<chosenCandidates:{TOKENS},chosen_candidates:{TOKENS}>"
CANDIDATES = f"array<struct<content:struct<parts:{PART}>,avgLogprobs:double,avg_logprobs:double,logprobsResult:{CHOSEN},logprobs_result:{CHOSEN}>>"


def parsed(line: Column) -> Column:
    """A JSON line as VARIANT, null if it is malformed."""
    return F.try_parse_json(line)


def candidates(response: Column) -> Column:
    return F.from_json(F.to_json(F.try_variant_get(response, "$.candidates", "variant")), CANDIDATES)


def _texts(candidate: Column, thoughts: bool) -> Column:
    parts = F.coalesce(candidate["content"]["parts"], F.array().cast(PART))
    wanted = F.filter(parts, lambda p: (F.coalesce(p["thought"], F.lit(False)) == thoughts) & (stripped(F.coalesce(p["text"], F.lit(""))) != ""))
    return F.transform(wanted, lambda p: stripped(p["text"]))


def candidates_text(held: Column, response: Column) -> Column:
    joined = F.transform(F.coalesce(held, F.array().cast(CANDIDATES)), lambda c: F.array_join(_texts(c, False), ""))
    first = F.try_element_at(F.filter(joined, lambda t: t != ""), F.lit(1))
    return F.coalesce(first, F.nullif(stripped(F.try_variant_get(response, "$.text", "string")), F.lit("")))


def candidates_thoughts(held: Column) -> Column:
    every = F.flatten(F.transform(F.coalesce(held, F.array().cast(CANDIDATES)), lambda c: _texts(c, True)))
    return F.nullif(F.array_join(every, "\n\n"), F.lit(""))


def candidates_mean(held: Column) -> Column:
    first = F.try_element_at(held, F.lit(1))
    return F.coalesce(first["avg_logprobs"], first["avgLogprobs"])


def response_text(response: Column) -> Column:
    """The stripped answer parts of the first candidate that has any, joined; else the response's own text; null if empty."""
    return candidates_text(candidates(response), response)


def response_thoughts(response: Column) -> Column:
    """All thoughts of all candidates, joined by blank lines; null without any."""
    return candidates_thoughts(candidates(response))


def mean_logprob(response: Column) -> Column:
    """The first candidate's mean log-probability, under either spelling."""
    return candidates_mean(candidates(response))


def chosen_tokens(held: Column) -> Column:
    """token, logprob: the tokens that the first of some ``candidates`` chose, in order; those without a text or a probability
    are left out. Empty if there are none."""
    first = F.try_element_at(held, F.lit(1))
    result = F.coalesce(first["logprobs_result"], first["logprobsResult"])
    chosen = F.coalesce(result["chosen_candidates"], result["chosenCandidates"], F.array().cast(TOKENS))
    each = F.transform(chosen, lambda t: F.struct(t["token"].alias("token"), F.coalesce(t["log_probability"], t["logProbability"]).alias("logprob")))
    return F.filter(each, lambda t: (t["token"] != "") & t["logprob"].isNotNull())


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def _there(v: Column) -> Column:
    return v.isNotNull() & (F.schema_of_variant(v) != "VOID")


def record_columns(records: DataFrame, line: str) -> DataFrame:
    """``records`` with _v, _key, _response, text, _said and reason of a JSON ``line``: each is parsed once, and read as a column.

    ``reason`` says why a prediction record is no valid answer, in order of checks, or ``valid``. An answer is valid if its
    text is a JSON object; field-level checks come after this.
    """
    out = records.withColumn("_v", parsed(F.col(line)))
    out = out.withColumns({"_key": F.trim(F.try_variant_get("_v", "$.key", "string")), "_response": F.try_variant_get("_v", "$.response", "variant"), "_error": F.try_variant_get("_v", "$.error", "variant")})
    out = out.withColumn("text", response_text(F.col("_response"))).withColumn("_said", F.try_parse_json("text"))
    v, key = F.col("_v"), F.col("_key")
    reason = (
        F.when(v.isNull(), "invalid_jsonl_line").when(~_is_object(v), "invalid_record_type").when(key.isNull() | (key == ""), "missing_key").when(_there(F.col("_error")), "batch_error")
        .when(~_there(F.col("_response")), "missing_response").when(F.col("text").isNull(), "empty_response_text").when(~_is_object(F.col("_said")), "schema_validation_failed").otherwise("valid")
    )
    return out.withColumn("reason", reason)


def message_columns(records: DataFrame, line: str, keys: DataFrame) -> DataFrame:
    """The same for records of the form custom_id, result: {type, message: {content: [{type, text}]}}.

    ``keys`` (custom_id, key) gives the pages' keys; an unknown custom_id stands for itself, and none for no key. Of an id
    with several keys the least counts. A result that did not succeed is ``batch_<type>``.
    """
    out = records.withColumn("_v", parsed(F.col(line)))
    out = out.withColumns({"_custom": F.nullif(F.trim(F.try_variant_get("_v", "$.custom_id", "string")), F.lit("")), "_result": F.try_variant_get("_v", "$.result", "variant")})
    out = out.withColumns({"_type": F.lower(F.trim(F.try_variant_get("_result", "$.type", "string"))), "_message": F.try_variant_get("_result", "$.message", "variant")})
    parts = F.from_json(F.to_json(F.try_variant_get("_message", "$.content", "variant")), "array<struct<type:string,text:string>>")
    said = F.filter(F.coalesce(parts, F.array().cast("array<struct<type:string,text:string>>")), lambda p: F.coalesce(p["type"], F.lit("text")) == "text")
    out = out.withColumn("text", F.nullif(F.trim(F.array_join(F.transform(said, lambda p: F.coalesce(p["text"], F.lit(""))), "")), F.lit(""))).withColumn("_said", F.try_parse_json("text"))
    v = F.col("_v")
    reason = (
        F.when(v.isNull(), "invalid_jsonl_line").when(~_is_object(v), "invalid_record_type").when(~_is_object(F.col("_result")), "missing_result")
        .when(F.coalesce(F.col("_type"), F.lit("")) != "succeeded", F.concat(F.lit("batch_"), F.coalesce(F.nullif("_type", F.lit("")), F.lit("unknown"))))
        .when(~_is_object(F.col("_message")), "missing_response").when(F.col("text").isNull(), "empty_response_text").when(~_is_object(F.col("_said")), "schema_validation_failed").otherwise("valid")
    )
    # One key an id: of several the least, so that no record is doubled.
    known = keys.groupBy(F.col("custom_id").alias("_custom")).agg(F.min("key").alias("_known"))
    held = lookup(out.withColumn("reason", reason), known, ["_custom"], "left")
    return held.withColumn("_key", F.coalesce("_known", "_custom")).drop("_known")


def collected(records: DataFrame, line: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(selected, rejected): of each key the earliest valid record, and the reasons of the keys without one.

    ``selected`` has key, text, mean_logprob; ``rejected`` key, reason, n. Malformed lines are rejected as such. One aggregate
    by key and reason is checkpointed, and both are read off it.
    """
    held = record_columns(records, line)
    key = F.coalesce("_key", F.concat_ws("", F.lit("<line:"), F.concat_ws(":", *order), F.lit(">")))
    rows = held.select(key.alias("key"), "reason", *order, "text", mean_logprob(F.col("_response")).alias("mean_logprob"))
    per = cut(rows.groupBy("key", "reason").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct("text", "mean_logprob"), F.struct(*order)).alias("_r")))
    valid = per.where("reason = 'valid'")
    return valid.select("key", "_r.*"), per.join(valid.select("key"), "key", "left_anti").select("key", "reason", "n")


def collect_stats(records: DataFrame, line: str, file: str) -> DataFrame:
    """stat, n: the counts of a collection over all of its files, from one scan: output files and rows, valid candidates and
    those of them that are not a key's first, rejected ones by reason, and keys: seen, valid, and only rejected.

    Counts of 0 are there but for reasons that do not occur. Files without rows do not count.
    """
    held = record_columns(records.where(F.trim(line) != ""), line)
    key = F.nullif(F.col("_key"), F.lit(""))
    per = cut(held.groupBy(F.col(file).alias("file"), key.alias("key"), "reason").agg(F.count(F.lit(1)).alias("n")))
    valid = F.col("reason") == "valid"
    keys = per.where("key IS NOT NULL").groupBy("key").agg(F.bool_or(valid).alias("ok"), F.sum(F.when(valid, F.col("n")).otherwise(0)).alias("n"))
    by_key = keys.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("valid_response_candidates"), F.coalesce(F.sum(F.when(F.col("ok"), F.col("n") - 1)), F.lit(0)).alias("duplicate_valid_candidates"),
        F.count(F.lit(1)).alias("unique_observed_keys"), F.count_if("ok").alias("unique_valid_keys"), F.count_if(~F.col("ok")).alias("unique_rejected_only_keys"),
    )
    by_file = per.groupBy("file").agg(F.sum("n").alias("n")).agg(F.count(F.lit(1)).alias("output_files"), F.coalesce(F.sum("n"), F.lit(0)).alias("output_rows"))
    long = lambda one: one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("stat"), F.col(c).cast("long").alias("n")) for c in one.columns])).alias("s")).select("s.*")
    reasons = per.where(~valid).groupBy(F.concat(F.lit("rejected:"), F.col("reason")).alias("stat")).agg(F.sum("n").alias("n"))
    return long(by_key).unionByName(long(by_file)).unionByName(reasons)


def retrieved(parsed_rows: DataFrame, key: str, output: str, line: str, strategy: str = "first_successful") -> DataFrame:
    """``parsed_rows`` (valid answers) with file_key, status and duplicate_action under a duplicate strategy.

    first_successful: a key's first row in the order of output and line is kept, later ones are duplicate_skipped;
    provide_all: all are provided. Rows without a key all stay, under ``<batch:i-line:n>``.
    """
    fallback = F.concat(F.lit("<batch:"), F.col(output).cast("string"), F.lit("-line:"), F.col(line).cast("string"), F.lit(">"))
    out = parsed_rows.withColumn("file_key", F.coalesce(F.nullif(F.trim(F.col(key)), F.lit("")), fallback))
    if strategy == "provide_all":
        return out.withColumns({"status": F.lit("success"), "duplicate_action": F.lit("provided")})
    # The first place of a key comes from an aggregate, and comes back by a join that spreads keys with many rows.
    first = out.groupBy("file_key").agg(F.min(F.struct(output, line)).alias("_first"))
    kept = F.col("_first") == F.struct(output, line)
    out = lookup(out, first, ["file_key"]).withColumns({"status": F.when(kept, "success").otherwise("duplicate_skipped"), "duplicate_action": F.when(kept, "kept").otherwise("kept_first_successful")})
    return out.drop("_first")
