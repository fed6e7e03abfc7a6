"""Edge cases of the operators that the test tables do not have."""

import random
import statistics

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions import text, values
from quillspark.operators import aggregates, confidence, coverage, dedupe, jobs, nested, order, responses, sampling, scoring
from quillspark.sources import files, sinks
from quillspark.streaming import log


def col(spark, data, f, kind="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(data)], f"k int, v {kind}")
    return [r[0] for r in df.select(f(F.col("v")).alias("o"), "k").orderBy("k").collect()]


def test_identity(spark):
    refs = ["pages/a.png", "gs://bucket/pages/a.png", "/tmp/images/a.png", "gs://bucket", " ", "", None, ".", "a/"]
    assert col(spark, refs, text.identity) == ["a.png", "a.png", "a.png", "bucket", None, None, None, None, "a"]


def test_object_key(spark):
    refs = ["gs://b/o/x.png", "gs://c/o", "gs://b/", "//o", "", None]
    assert col(spark, refs, lambda c: text.object_key(c, "b")) == ["o/x.png", None, None, "o", None, None]


def test_names(spark):
    assert col(spark, [" Hospital-Stay  date ", "__a__b_"], text.field_name) == ["hospital_stay_date", "a_b"]
    assert col(spark, ["submit_20240102_030405", "bare"], text.run_time) == ["2024-01-02T03:04:05", ""]
    assert col(spark, ["a.b.JOB_STATE_FAILED", None, " "], text.state) == ["JOB_STATE_FAILED", "UNKNOWN", "UNKNOWN"]
    assert col(spark, ["page_0012.png", "page_x.png", None], text.page_number) == [12, None, None]
    assert col(spark, ["vol_12345_67890/x_11111.png", "vol/x_22222.png", "33333.png"], text.folder_number) == [67890, 22222, None]
    assert col(spark, ["projects/p/locations/eu/jobs/1", "x"], text.location_of) == ["eu", None]
    assert col(spark, ["key=abcdefghij", "short"], lambda c: text.redacted(c, ["abcdefghij", "short"])) == ["key=[redacted]", "short"]
    assert col(spark, ["x" * 600], lambda c: F.length(text.compact_error(c))) == [500]


def test_emptiness_lattice(spark):
    assert col(spark, ["x", " ", "", None, "0"], values.populated) == [True, False, False, False, True]
    assert col(spark, ["yes", "0", "Y", None, "failed"], values.truthy) == [True, False, True, False, False]
    assert col(spark, ["failed", "no", None], lambda c: values.row_failed(c, F.lit("error"))) == [True, False, True]
    v = ['2', '"2"', 'true', '{}', '[]', '" "', 'null', '{"a":1}']
    parsed = lambda f: col(spark, v, lambda c: f(F.parse_json(c)))
    assert parsed(values.real_number) == [2.0, None, None, None, None, None, None, None]
    assert parsed(values.parsed_number) == [2.0, 2.0, None, None, None, None, None, None]
    assert parsed(values.populated_variant) == [True, True, True, False, False, False, False, True]


def test_coverage_with_nothing_expected(spark):
    none = spark.createDataFrame([], "k int")
    some = spark.createDataFrame([(1,), (None,)], "k int")
    assert coverage.coverage_report(none, some, "k").collect()[0].asDict() == {"expected": 0, "covered": 0, "missing": 0, "extra": 1, "ratio": None}
    assert coverage.restrict(some, None, F.col("k"), "k").count() == 2
    assert coverage.restrict(some, None, F.col("k"), "k", none_keeps=False).count() == 0
    assert {r.k for r in coverage.continue_with(some, none, F.col("k"), "k").collect()} == {1, None}


def test_failed_keys_without_fallback(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "key string")
    failures = spark.createDataFrame([("a", "late"), ("<line:3>", "broken"), ("z", None)], "key string, reason string")
    assert {tuple(r) for r in coverage.failed_keys(keys, keys.where("key = 'b'"), failures, "key").collect()} == {("a", "late")}
    assert {tuple(r) for r in coverage.failed_keys(keys, keys, failures, "key").collect()} == {("a", "late"), ("z", "unknown_failure")}
    assert coverage.failed_keys(keys, keys, failures, "key", strict=True).count() == 0


def test_first_successful_keeps_the_place_of_the_failure(spark):
    rows = [(1, "a", True), (2, "b", False), (3, "a", False), (4, "a", False), (5, None, True), (6, None, True)]
    df = spark.createDataFrame(rows, "seq int, item string, failed boolean")
    out = dedupe.first_successful(df, "item", F.col("failed"), "seq").orderBy("position")
    assert [(r.seq, r.item, r.position) for r in out.collect()] == [(3, "a", 1), (2, "b", 2), (5, None, 5), (6, None, 6)]
    actions = {r.seq: r.action for r in dedupe.ledger(df, "item", F.col("failed"), "seq").collect()}
    assert actions == {1: "kept", 2: "kept", 3: "replaced_failed_duplicate", 4: "skipped_duplicate", 5: "kept", 6: "kept"}
    assert {r.action for r in dedupe.ledger(df, "item", F.col("failed"), "seq", keep_all=True).where("seq > 2 and item is not null").collect()} == {"included_duplicate"}


def test_even_chunks(spark):
    df = spark.range(5).toDF("k")
    sizes = [r["count"] for r in order.even_chunks(df, 3, "k").groupBy("chunk").count().orderBy("chunk").collect()]
    assert sizes == [2, 2, 1]
    assert order.even_chunks(df.where("k < 0"), 3, "k").count() == 0
    assert [r["index"] for r in order.with_index(df, "k").orderBy("k").collect()] == [0, 1, 2, 3, 4]


def test_duplicate_audit(spark):
    names = [("a", "1"), ("b", "2"), ("a", "3"), (None, "4"), (None, "5"), ("a", "6")]
    out = dedupe.duplicate_audit(spark.createDataFrame(names, "n string, place string"), "n", "place")
    assert {(r.n, r.kept_index, r.skipped_index) for r in out.collect()} == {("a", 1, 3), ("a", 1, 6)}


def test_completeness_without_rows(spark):
    out = aggregates.completeness(spark.createDataFrame([], "a string, b int"), ["a", "b"]).collect()
    assert [(r.column_name, r.populated, r.completeness) for r in out] == [("a", 0, 0.0), ("b", 0, 0.0)]


def test_distribution_of_nothing(spark):
    r = aggregates.distributions(spark.createDataFrame([(None,)], "v double"), "v").collect()[0]
    assert r.n == 0 and r["mean"] is None and r["median"] is None


@pytest.mark.parametrize("parts", ["1", "7"])
def test_medians_by_ranges(spark, parts):
    """Groups of odd and even counts, ties, nulls, a group without numbers, a null group, and one with a third of all rows."""
    r = random.Random(int(parts))
    rows = [(g, r.choice([None, float(r.randrange(40)), r.random()])) for g, n in (("a", 1), ("b", 2), ("c", 301), ("d", 120), (None, 33), ("e", 90)) for _ in range(n)] + [("f", None), ("g", 3.0), ("g", 5.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {x.grp: (x.n, x.median) for x in aggregates.distributions(df, "v", "g").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for g in ("a", "b", "c", "d", "e", "f", "g", None, "total"):
        v = [x for k, x in rows if x is not None and (g == "total" or k == g)]
        assert got[g] == (len(v), round(statistics.median(v), 6) if v else None), g


def test_accuracy_conventions_differ(spark):
    df = spark.createDataFrame([("accept",), ("partial",), ("unsure",), ("whatever",)], "label string").withColumn("c", F.lit(" "))
    assert scoring.report_accuracy(df, "label").collect()[0].asDict() == {"n": 3, "accuracy": 0.666667}
    r = scoring.metric_summary(df, "label", "c").collect()[0]
    assert (r.metric, r.decisions, r.accuracy) == ("(unknown)", 4, 75.0)
    assert {x.label: x.n for x in scoring.label_distribution(df, "label").collect()}["rejected"] == 0


def test_flatten_and_lines(spark):
    schema = T.StructType().add("a", T.StructType().add("b", T.StructType().add("c", T.IntegerType()))).add("l", T.ArrayType(T.IntegerType()))
    flat = nested.flattened(spark.createDataFrame([(((1,),), [2])], schema))
    assert flat.columns == ["a.b.c", "l"] and tuple(flat.collect()[0]) == (1, [2])
    pages = spark.createDataFrame([("p", [("first", 7), ("second", None)])], "image string, page_lines array<struct<text:string,page_line_number:int>>")
    assert [(r.text, r.page_line_number) for r in nested.page_lines(pages).collect()] == [("first", 1), ("second", 2)]
    v = spark.sql("SELECT 1 AS k, parse_json('{\"a\":{\"b\":{}},\"c\":[{\"d\":1}]}') AS v")
    assert {(r.path, r.value) for r in nested.variant_leaves(v, "k", "v").collect()} == {("a.b", "{}"), ("c", '[{"d":1}]')}


def test_jobs(spark):
    parent = spark.createDataFrame([("j", "c1", 1), ("j", "c2", 2)], "job string, name string, i int")
    child = spark.createDataFrame([("j", "c2", 1), ("j", "r1", 2)], "job string, name string, i int")
    assert {(r.name, r.i) for r in jobs.linked_chunks(parent, child, "job", "name", "i").collect()} == {("c1", 1), ("c2", 2), ("r1", 3)}
    status = jobs.updated_status(parent.withColumn("status", F.lit("RUNNING")), spark.createDataFrame([("c1", "DONE")], "name string, status string"), "name")
    assert {(r.name, r.status, r.changed) for r in status.collect()} == {("c1", "DONE", True), ("c2", "RUNNING", False)}
    errors = spark.createDataFrame([("j", "ERROR: x"), ("k", "JOB_STATE_SUCCEEDED"), ("k", "JOB_STATE_PARTIALLY_SUCCEEDED")], "job string, s string")
    assert {(r.job, r.state) for r in jobs.state_rollup(errors, "job", "s").collect()} == {("j", ""), ("k", "failed")}


def test_a_run_without_batches_has_an_empty_clash(spark):
    runs = spark.createDataFrame([(1, None), (2, None), (3, "gemini"), (4, None)], "run int, provider string")
    batches = spark.createDataFrame([(2, "msgbatch_a"), (2, "batches/b"), (4, "odd")], "run int, name string")
    got = {r.run: r.mixed for r in jobs.run_providers(runs, batches, "run", "provider", "name").collect()}
    assert got == {1: [], 2: ["msgbatch_a", "batches/b"], 3: None, 4: ["odd"]}
    told = jobs.run_providers(runs, batches, "run", "provider", "name", "anthropic").where("run = 1").first()
    assert (told.provider, told.source, told.mixed) == ("anthropic", "fallback", [])


def test_sampling(spark):
    state = spark.createDataFrame([("patient.name", 50, 10, 10), ("fk_info", 50, 0, 0)], "field string, size int, selected int, scored int")
    assert sampling.ucb_scores(state).orderBy(F.desc("score")).first().field == "fk_info"
    assert sampling.exact_sample(spark.range(5).toDF("k"), F.col("k"), 0.5).count() == 2
    assert sampling.exact_sample(spark.range(5).toDF("k"), F.col("k"), 0.0).count() == 1


def test_responses(spark):
    lines = ['{"key":"a","response":{"candidates":[{"content":{"parts":[{"text":" x ","thought":true}]}},{"content":{"parts":[{"text":" {\\"q\\":"},{"text":"1} "}]}}]}}', '{"key":"b","response":{"text":"{}"}}', "nonsense", '{"key":" "}', '{"key":"c","response":null}']
    df = spark.createDataFrame([(k, s) for k, s in enumerate(lines)], "n int, line string")
    selected, rejected = responses.collected(df, "line", ["n"])
    assert {(r.key, r.text) for r in selected.collect()} == {("a", '{"q":1}'), ("b", "{}")}
    assert {r.reason for r in rejected.collect()} == {"invalid_jsonl_line", "missing_key", "missing_response"}
    thoughts = df.where("n = 0").select(responses.response_thoughts(F.try_variant_get(responses.parsed(F.col("line")), "$.response", "variant")).alias("t"))
    assert thoughts.first().t == "x"


def test_confidence(spark):
    df = spark.createDataFrame([("k", "/a", -0.1), ("k", "/a", -0.3), ("k", "/b", None)], "key string, leaf string, lp double")
    out = confidence.leaf_confidence(df, "key", "leaf", "lp").collect()
    assert len(out) == 1 and out[0].ratio == pytest.approx(0.8187307)


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "d.jsonl").write_text('{"a":1}\n\nbroken\n[1]\n{"a":"2"}\n')
    path = str(tmp_path / "d.jsonl")
    assert files.json_lines(spark, path).count() == 2
    assert files.json_lines(spark, path, limit=1).count() == 1
    assert files.row_count(spark, path, "jsonl") == 4
    with pytest.raises(Exception, match="no JSON object"):
        files.json_lines_strict(spark, path).collect()
    (tmp_path / "m.csv").write_text("﻿SBID;x;Year\n7;a;1890\n7;b;1891\nq;c;1892\n")
    assert [tuple(r) for r in files.year_lookup(spark, str(tmp_path / "m.csv")).collect()] == [(7, 1891)]
    out = str(tmp_path / "csv")
    first = spark.createDataFrame([("a", "1", 5)], "image_name string, failed string, value int")
    sinks.append_delimited(first, spark, out)
    sinks.append_delimited(first.drop("value").withColumn("more", F.lit("x")), spark, out)
    got = files.delimited(spark, out)
    assert got.columns == ["image_name", "failed", "value"] and got.count() == 2
    sinks.append_json_lines(first, str(tmp_path / "out"))
    assert files.json_lines(spark, str(tmp_path / "out")).count() == 1
    sinks.versioned_copy(first, str(tmp_path / "ds"), 1, "import")
    assert spark.read.parquet(str(tmp_path / "ds/current")).count() == 1
    assert files.listing(spark, str(tmp_path), [".csv"], glob="m*.csv").count() == 1


def test_streams(spark, tmp_path):
    rows = [(k, f"2024-01-0{1 + k % 3} 00:00:00", "ab"[k % 2]) for k in range(12)]
    df = spark.createDataFrame(rows, "event_id int, ts string, kind string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = lambda: log.event_stream(spark, str(tmp_path / "in"), df.schema, "part")
    assert {tuple(r) for r in log.drained(log.running_counts(stream(), "kind"), spark, "t_counts").collect()} == {("a", 6), ("b", 6)}
    windows = log.drained(log.windowed_counts(stream(), "ts", "kind"), spark, "t_windows")
    assert sum(r.n for r in windows.collect()) == 12
    for turn in (1, 2):
        log.append_batches(stream(), str(tmp_path / "out"), str(tmp_path / f"cp{turn}"), "event_id").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 12


def test_drained_streams_are_tables_of_the_shared_folder(spark, tmp_path):
    df = spark.range(0, 5000).select("id", (F.col("id") % 1000).alias("user"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("status"))
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = lambda name: log.event_stream(spark, str(tmp_path / "in"), df.schema, name)
    for mode, out in (("complete", log.drained(log.status_changes(stream("part"), "user", "status", "id"), spark, "t_status")), ("append", log.drained(stream("part"), spark, "t_rows", "append"))):
        assert out.inputFiles() and all(spark.conf.get("spark.checkpoint.dir") in f for f in out.inputFiles())
        want = {(4000 + k, k, f"s{4000 + k}") for k in range(1000)} if mode == "complete" else set(map(tuple, df.collect()))
        found = out.select("since", "user", "status") if mode == "complete" else out
        assert out.count() == len(want) and set(map(tuple, found.collect())) == want
    none = log.drained(log.status_changes(stream("nothing"), "user", "status", "id"), spark, "t_none")
    assert none.columns == ["user", "status", "since"] and none.count() == 0


def test_leaf_spans(spark):
    from quillspark.functions.json_spans import leaf_spans, spans

    text_ = ' {"a/b": "x\\"y", "l": [1.5e3, {"~": null}, []], "e": {}} '
    found = {s["leaf"]: text_[s["start"] : s["stop"]] for s in leaf_spans(text_)}
    assert found == {"/a~1b": 'x\\"y', "/l/0": "1.5e3", "/l/1/~0": "null"}
    assert leaf_spans('"top"') == [{"leaf": "", "start": 1, "stop": 4}]
    for bad in ("", None, "{", '{"a":1} x', "{'a':1}", '{"a" 1}', "[1,]", "[1 2]", "nul", '{"a":01}', '["\n"]'):
        assert leaf_spans(bad) == []
    df = spark.createDataFrame([(1, '{"a":[true,"b"]}')], "k long, t string")
    leaves = df.select("k", F.explode(spans(F.col("t"))).alias("s")).select("k", "s.*")
    tokens = spark.createDataFrame([(1, 0, '{"a":['), (1, 1, "tru"), (1, 2, 'e,"b'), (1, 3, '"]}')], "k long, place int, token string")
    met = confidence.widest_overlap(confidence.token_spans(tokens, "k", "place", "token"), leaves, "k", "place")
    assert {(r.place, r.leaf) for r in met.collect()} == {(1, "/a/0"), (2, "/a/0")}


def test_schema_checks(spark):
    from quillspark.functions import schema

    fields = [schema.Field("n", "STRING"), schema.Field("d", "DATE", least="1879-01-01", most="1910-12-31"), schema.Field("k", "STRING", required=False, allowed=("DB",))]
    said = col(spark, ['{"n":"x","d":"1900-02-03","k":"DB","z":1}', '{"n":5,"d":"1911-01-01","k":"no"}', '{"n":null,"d":"1900-13-01"}', "{}"], lambda c: schema.violations(F.parse_json(c), fields))
    assert said == [[], ["d: out of range", "k: not allowed", "n: wrong type"], ["d: wrong type", "n: missing"], ["d: missing", "n: missing"]]
    kind = T.StructType().add("a", T.ArrayType(T.StructType().add("b", T.IntegerType()))).add("m", T.StructType().add("c", T.StringType()))
    assert schema.schema_paths(kind) == {"a", "a.b", "m", "m.c"} and schema.eligible_fields(kind, set()) == ["m.c"]
    assert col(spark, [" 5 ", "", "x"], lambda c: schema.corrected(c, "int")) == [5, None, None]


def test_links(spark):
    from quillspark.operators import links, manifest

    objects = spark.createDataFrame([("p/a.png",), ("q/b.png",)], "name string")
    assert {tuple(r) for r in links.unique_map(objects, "name").collect()} == {("a.png", "p/a.png"), ("b.png", "q/b.png")}
    with pytest.raises(Exception, match="several objects are called a.png"):
        links.unique_map(objects.union(spark.createDataFrame([("z/a.png",)], "name string")), "name").collect()
    assert manifest.single_row(objects.limit(1)).count() == 1
    for df in (objects, objects.limit(0)):
        with pytest.raises(Exception, match="expected one row"):
            manifest.single_row(df).collect()
    record = manifest.manifest_records(objects, image_name=F.col("name"), extra=F.lit(1))
    assert record.columns == [*manifest.MANIFEST, "extra"]


def test_joins_with_a_hot_key(spark):
    """A third of all rows under one key, and some without: no task gets ten times the others' rows, and nothing changes."""
    from quillspark.operators import skew

    rows = spark.range(0, 60_000).select("id", F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 30 == 1, None).otherwise(F.col("id") % 5000).alias("k"))
    dimension = spark.range(0, 4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    assert [r.k for r in skew.hot_keys(rows, ["k"]).collect()] == [0]
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = rows.join(dimension, "k", how)
        got = skew.lookup(rows, dimension, ["k"], how)
        assert sorted(got.columns) == sorted(want.columns)
        c = sorted(want.columns)
        assert got.select(c).exceptAll(want.select(c)).isEmpty() and want.select(c).exceptAll(got.select(c)).isEmpty() and got.count() == want.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        shuffled = rows.where("k IS NOT NULL").join(F.broadcast(skew.hot_keys(rows, ["k"])), "k", "left_anti").groupBy(F.pmod(F.hash("k"), F.lit(8))).count()
        sizes = [r["count"] for r in shuffled.collect()]
        assert max(sizes) < 10 * sorted(sizes)[len(sizes) // 2]
        assert skew.lookup(rows, dimension.limit(0), ["k"]).count() == 0 and skew.lookup(rows.limit(0), dimension, ["k"], "left").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_parting_hot_keys_drops_no_rows_in_a_join(spark):
    """What the joins before the lookup give does not depend on the share of hot keys: no anti-join parts the rows."""
    from quillspark.operators import skew

    rows = spark.range(0, 6000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    dimension = spark.range(0, 4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    for how in ("inner", "left", "left_semi"):
        joined = skew.lookup(rows, dimension, ["k"], how)
        assert "LeftAnti" not in joined._jdf.queryExecution().optimizedPlan().toString()
        assert joined.count() == rows.join(dimension, "k", how).count()


def test_visible_datasets_are_dealt_by_their_number(spark, monkeypatch):
    from quillspark.operators import links

    monkeypatch.setattr(links, "TASK_ROWS", 100)
    sets = spark.range(0, 1000).select((F.col("id") % 300).alias("run"), F.when(F.col("id") < 100, "current").otherwise("old").alias("kind"), "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = links.visible(sets, "run", "kind")
        assert out.rdd.getNumPartitions() == 10
        assert sorted(r.id for r in out.collect()) == [k for k in range(1000) if k < 100 or k % 300 >= 100]
        assert links.visible(sets.limit(0), "run", "kind").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_confidence_of_fields(spark):
    import json
    import math

    from quillspark.functions.json_spans import leaf_logprobs

    def response(text_, tokens, spelling=("logprobsResult", "chosenCandidates", "logProbability")):
        result, chosen, value = spelling
        return json.dumps({"candidates": [{"content": {"parts": [{"text": text_}]}, result: {chosen: [{"token": t, value: p} for t, p in tokens]}}]})

    answer = '{"a":"xy","b":[10,true]}'
    cases = [
        response(answer, [('{"a":"', -9), ("xy", -0.5), ('","b":[1', -1), ("0", -3), (",tr", -2), ("ue]}", -4)]),
        response(f"\n {answer}\t", [("```json\n" + '{"a":"x', -9), ('y","', -0.25), ("", -7), (None, -7), ('b":[', -9), ("10,", -0.75), ("true", None), ("true]}\n```", 0)], ("logprobs_result", "chosen_candidates", "log_probability")),
        response(answer, [("something else", -1)]), response("no json", [("no json", -1)]), response("  ", [("x", -1)]), response(answer, []), "{}", "null",
    ]
    df = spark.createDataFrame(list(enumerate(cases)), "k int, r string").withColumn("v", F.parse_json("r"))
    held = [{p: (m.field_confidence_logprobs, round(m.field_confidence_ratio, 9)) if m.field_confidence_logprobs is not None else None for p, m in r.field_confidence_by_pointer.items()} for r in confidence.with_response_metadata(df, "v").orderBy("k").collect()]
    sure = lambda x: (x, round(math.exp(x), 9))
    # A token counts for the leaf that it shares most with, though most of it is punctuation.
    assert held[0] == {"/a": sure(-0.5), "/b/0": sure(-2.0), "/b/1": sure(-3.0)}
    assert held[1] == {"/a": sure(-4.625), "/b/0": sure(-0.75), "/b/1": sure(0.0)} and held[2:] == [{}] * 6
    # Equal shares go to the first leaf; an empty value has no token; a pointer given twice has its last place.
    assert leaf_logprobs('["ab","cd",""]', 0, [2, 2 + 3 + 2], [-5.0, -1.0]) == [{"leaf": "/0", "logprob": -1.0}, {"leaf": "/1", "logprob": None}, {"leaf": "/2", "logprob": None}]
    assert leaf_logprobs('{"a":1,"a":23}', 0, [6, 6, 2], [-5.0, -1.0, -2.0]) == [{"leaf": "/a", "logprob": -1.5}]
    assert leaf_logprobs("[1]", None, [3], [-1.0]) == [] == leaf_logprobs(None, 0, [3], [-1.0])


def test_choices_go_on_after_a_restart(spark, tmp_path):
    """The same decisions in one run, and in two with a stop between them, from the checkpoint: the state goes on."""
    from quillspark.streaming import log, sampler

    rows = [(s, k, [1.0, 0.0, None, 0.5][(k + s) % 4], s % 2) for s in range(6) for k in range(20)]
    decisions = spark.createDataFrame(rows, "session long, place long, score double, dataset long")
    catalogue = spark.createDataFrame([(0, "a", 9), (0, "b", 3), (0, "c", 2), (1, "x", 30)], "dataset long, field string, size int")
    stream = lambda folder: sampler.choices(log.event_stream(spark, folder, decisions.schema, "part"), catalogue, "dataset", "session", "place", "score")
    run = lambda folder, out: stream(folder).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    decisions.write.parquet(f"{tmp_path}/whole")
    run(f"{tmp_path}/whole", f"{tmp_path}/one")
    for part in (F.col("place") < 11, F.col("place") >= 11):
        decisions.where(part).write.mode("append").parquet(f"{tmp_path}/parts")
        run(f"{tmp_path}/parts", f"{tmp_path}/two")
    one, two = ({tuple(r) for r in spark.read.parquet(f"{tmp_path}/{n}").collect()} for n in ("one", "two"))
    assert one == two and len(one) == 120
    mine = sorted(r for r in one if r[0] == 0)
    assert [r[2] for r in mine[:3]] == ["a", "b", "c"] and sum(r[2] is None for r in mine) == 20 - 14 and {r[3] for r in mine if r[2] == "b"} == {0, 1, 2}


def test_batches_run_again_append_nothing(spark, tmp_path):
    from quillspark.streaming import log

    path = str(tmp_path / "set")
    df = spark.createDataFrame([(k % 40, k) for k in range(100)] + [(None, 7)], "key long, place long").repartition(4)
    log.append_new(df, path, "x-0", "key", "place", buckets=8)
    more = spark.createDataFrame([(3, 1000), (777, 1001), (777, 1002)], "key long, place long")
    for _ in range(2):
        known = log.append_new(more, path, "x-1", "key", "place", buckets=8)
    rows = {(r.key, r.place, r._batch) for r in log.appended(spark, path, df.schema).collect()}
    assert rows == {(k, k, "x-0") for k in range(40)} | {(777, 1001, "x-1")} and spark.read.parquet(path).count() == 41
    # Of the ledger only the buckets of keys 3 and 777 are read.
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    buckets = {r["_bucket"] for r in spark.createDataFrame([(3,), (777,)], "key long").select(log._bucket("key", 8).alias("_bucket")).collect()}
    assert known.select("_bucket").distinct().count() <= len(buckets) < 8
    # A batch that failed after its data and before its keys is whole when it is run again.
    log.append_new(more.limit(0), path, "x-2", "key", "place", buckets=8)
    assert log.appended(spark, path, df.schema).count() == 41


def test_first_seen(spark, tmp_path):
    from quillspark.streaming import log

    df = spark.createDataFrame([(k % 5, f"2024-01-01 0{k % 9}:00:00") for k in range(30)], "key long, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    out = log.drained(log.first_seen(log.event_stream(spark, str(tmp_path / "in"), df.schema, "part"), "key", "ts"), spark, "t_first", "append")
    assert sorted(r.key for r in out.collect()) == [0, 1, 2, 3, 4]


def test_walks_in_chunks(spark):
    """Users of 1 to 700 rates, in chunks of 4 and of 256, against a plain loop."""
    import random

    from quillspark.operators import walks

    r = random.Random(2)
    rows = [(u, k, None if r.random() < 0.05 else round(r.uniform(1, 9), 2)) for u, n in ((1, 1), (2, 700), (None, 30), (4, 5), (5, 4)) for k in range(n)]
    want = {}
    for u in {u for u, _, _ in rows}:
        workers, last = 8, None
        for _, k, rate in sorted(x for x in rows if x[0] == u):
            move = 4 if last is None or (rate is not None and rate >= last * 1.05) else -4 if rate is not None and rate * 1.05 < last else 0
            workers, last = max(1, min(24, workers + move)), rate
            want[u, k] = workers
    df = spark.createDataFrame(rows, "u long, k long, rate double").repartition(3)
    for chunk in (4, 256):
        assert {(x.u, x.k): x.workers for x in walks.tuned(df, "u", "k", "rate", 8, 4, 1, 24, chunk=chunk).collect()} == want
    assert walks.tuned(df.limit(0), "u", "k", "rate", 8, 4, 1, 24).count() == 0
