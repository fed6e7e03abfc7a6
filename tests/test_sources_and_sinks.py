"""Manifests, reports and sinks written and read back, and the readers that raise."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions import schema
from quillspark.operators import rows
from quillspark.sources import files, sinks


def one(path):
    return json.loads(next(p for p in path.iterdir() if p.name.startswith("part-")).read_text().splitlines()[0])


def test_strict_lines_name_the_line(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a":1}\n\n{"a":2}\n[3]\n')
    with pytest.raises(Exception, match="line 4 of"):
        files.json_lines_strict(spark, str(tmp_path / "a.jsonl")).collect()
    assert [r.line for r in files.prediction_lines(spark, str(tmp_path / "a.jsonl")).orderBy("line").collect()] == [1, 3, 4]
    assert files.requests_size(spark, str(tmp_path / "a.jsonl")).first().asDict() == {"requests": 3, "bytes": 21}


def test_manifest_tree_and_batch_manifest(spark, tmp_path):
    for run, text in (("r1", '{"n":1}\n{broken\n'), ("r2/deep", '{"n":2}\n')):
        (tmp_path / run).mkdir(parents=True)
        (tmp_path / run / "image_processing_manifest.jsonl").write_text(text)
    found = files.manifests(spark, str(tmp_path)).select(F.try_variant_get("value", "$.n", "int").alias("n"), "manifest_path").collect()
    assert sorted(r.n for r in found) == [1, 2] and all(r.manifest_path.endswith("manifest.jsonl") for r in found)
    (tmp_path / "none").mkdir()
    assert files.manifests(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "m.jsonl").write_text('{"key":" k ","custom_id":"a_1"}\n{"key":"l","custom_id":"b","mime_type":"image/png"}\n')
    assert sorted(tuple(r) for r in files.batch_manifest(spark, str(tmp_path / "m.jsonl")).collect()) == [("k", "a_1", "application/octet-stream"), ("l", "b", "image/png")]
    for bad in ('{"custom_id":"a"}', '{"key":"k","custom_id":"no good"}'):
        (tmp_path / "bad.jsonl").write_text(bad + "\n")
        with pytest.raises(Exception, match="no key|no valid custom_id"):
            files.batch_manifest(spark, str(tmp_path / "bad.jsonl")).collect()


def test_report_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a.png", "ok", 2), ("b.png", None, 3)], "name string, status string, extra int")
    sinks.summary(df.agg(F.count(F.lit(1)).alias("records")), "run/manifest.jsonl", str(tmp_path / "summary"), F.lit("now"))
    assert one(tmp_path / "summary") == {"records": 2, "manifest_path": "run/manifest.jsonl", "generated_at": "now"}
    sinks.report_csv(df, str(tmp_path / "report"), ["status", "absent", "name"])
    assert spark.read.csv(str(tmp_path / "report"), header=True).columns == ["status", "name", "extra"]
    sinks.duplicate_report(df, str(tmp_path / "dup"))
    skipped = files.json_lines(spark, str(tmp_path / "dup" / "manifest")).select(F.try_variant_get("value", "$.status", "string")).collect()
    assert [r[0] for r in skipped] == ["duplicate_skipped"] * 2 and spark.read.csv(str(tmp_path / "dup" / "duplicates_csv"), header=True).count() == 2
    sinks.decisions(df, str(tmp_path / "decisions"), ["name", "label"])
    assert spark.read.csv(str(tmp_path / "decisions"), header=True).columns == ["name", "label"]
    sinks.decisions_metadata(df, str(tmp_path / "meta"), validator_id="v")
    assert one(tmp_path / "meta") == {"decision_count": 2, "validator_id": "v"}
    for k in (1, 2):
        sinks.append_event(spark.createDataFrame([(k, "made", (k,))], "job_id int, event_type string, payload struct<n:int>"), str(tmp_path / "events"))
    assert sorted(r.payload for r in spark.read.parquet(str(tmp_path / "events")).collect()) == ['{"n":1}', '{"n":2}']


def test_a_rewrite_may_read_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "set")
    sinks.rewrite(spark.range(3), path)
    sinks.rewrite(spark.read.json(path).where("id > 0"), path)
    assert sorted(r.id for r in spark.read.json(path).collect()) == [1, 2] and [p.name for p in tmp_path.iterdir()] == ["set"]
    with pytest.raises(Exception, match="boom"):
        sinks.rewrite(spark.range(1).select(F.raise_error(F.lit("boom")).alias("x")), path)
    assert spark.read.json(path).count() == 2


def test_rows_by_schema(spark):
    df = spark.createDataFrame([(("x", None), " p/a.png", {"/a~1b": (-0.1, 0.9)}), (("y", [1]), "b.png", {})], "answer struct<`a/b`:string,list:array<int>>, ref string, pointers map<string,struct<l:double,r:double>>")
    first, second = rows.rows_of("Other", df, "answer", "ref", "pointers").orderBy("image_name").collect()
    assert (first.image_name, first.file_name, first["field_confidence"]["a/b"].field_confidence_ratio) == ("a.png", "p/a.png", 0.9)
    assert first["field_confidence"]["list"] is None and second["field_confidence"] is None
    with pytest.raises(Exception, match="no identity"):
        rows.default_rows(df.withColumn("ref", F.lit(" ")), "answer", "ref").collect()
    known = {"Page": T.StructType()}
    assert rows.resolved(" page ", known) == rows.resolved("P", known, {"p": "PAGE"}) == known["Page"]
    with pytest.raises(KeyError):
        rows.resolved("x", known)


def test_violations_are_found_once(spark):
    fields = [schema.Field("a", "BIGINT", least="2"), schema.Field("b.c", "STRING", required=False, allowed=("x",))]
    df = spark.createDataFrame([('{"a":1,"b":{"c":"y"}}',), ('{"a":"1"}',), ("{}",), ('{"a":3,"b":{"c":null}}',)], "t string")
    got = df.select(schema.violations(F.parse_json("t"), fields).alias("v"))
    assert [r.v for r in got.collect()] == [["a: out of range", "b.c: not allowed"], ["a: wrong type"], ["a: missing"], []]
    assert got._jdf.queryExecution().executedPlan().toString().count("parse_json") <= 2


def test_files_with_unlike_headers(spark, tmp_path):
    """Three headers, quoted line ends, a broken file, an empty one, and others beside them: each file by its own header."""
    for run, body in (("r1", b'label,column_name\r\nAccept,"a,b"\r\nreject,"two\nlines"\r\n'), ("r2", "﻿label,image_name,column_name\nunsure,x.png,c,more\né,y\n".encode()), ("r3", b"label\n\xff\xfe\n"), ("r4", b"")):
        (tmp_path / run).mkdir()
        (tmp_path / run / f"{run}_validations.csv").write_bytes(body)
    (tmp_path / "r1" / "other.csv").write_text("x\n1\n")
    rows = files.headed_files(spark, str(tmp_path), "*_validations.csv").collect()
    assert [r.error.split(":")[0] for r in rows if r.error] == ["UnicodeDecodeError"] and len(rows) == 5
    got = files.validations(spark, str(tmp_path))
    assert got.columns == ["label", "column_name", "image_name", "_validation_path", "_validation_run", "_validation_mtime", "_validation_place"]
    assert {(r.label, r.column_name, r.image_name, r._validation_run, r._validation_place) for r in got.collect()} == {
        ("Accept", "a,b", None, "r1", 1), ("reject", "two\nlines", None, "r1", 2), ("unsure", "c", "x.png", "r2", 1), ("é", None, "y", "r2", 2),
    }
    assert sorted(r.label for r in files.report_validations(spark, str(tmp_path)).collect()) == ["accept", "reject", "unsure", "é"]
    assert files.validations(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError, match="column_name"):
        files.report_validations(spark, str(tmp_path / "none"))


def test_selections(spark):
    import fnmatch

    from quillspark.sources import selection

    names = ["a.png", "p/a.png", "p/b_fp/c.PNG", "p/", "p/._a.png", "p/.png", "p/a.b.tiff", "p/x[1].png", "p/xy\nz.png", "px/a.png", None, "p/fp_fp.png"]
    bases = spark.createDataFrame([(n,) for n in sorted({*[n.split("/")[-1] for n in names if n], "]", "x]", "b", "a", "[1"})], "b string")
    for glob in ("*", "a*", "?", "[ab]*", "[!ab]*", "*.png", "x[[]1]*", "x[]]", "a.b*", "*[1", "[a-c].png", "[!a-c].png", "x\\d*", "**"):
        for name, fits in bases.select("b", F.col("b").rlike(selection.glob_pattern(glob))).collect():
            assert fits == fnmatch.fnmatchcase(name, glob), (glob, name)
    assert [selection.prefix(x) for x in (None, " ", "/", "/a/b/ ", "a")] == ["", "", "", "a/b/", "a/"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = lambda **k: sorted(r.name for r in selection.selected(df, "name", **k).collect())
    assert got(under="p") == ["p/.png", "p/a.b.tiff", "p/a.png", "p/b_fp/c.PNG", "p/fp_fp.png", "p/x[1].png", "p/xy\nz.png"]
    assert got(under="p/", extensions={"png"}) == ["p/a.png", "p/b_fp/c.PNG", "p/fp_fp.png", "p/x[1].png", "p/xy\nz.png"] and got(under="p", glob="xy*") == ["p/xy\nz.png"]
    assert [r.name for r in selection.inputs(df, "name", "p", "*.PNG", mode="only_fp").collect()] == ["p/b_fp/c.PNG"]
    assert "p/b_fp/c.PNG" not in [r.name for r in selection.inputs(df, "name", "p", mode="exclude_fp").collect()] and len(selection.inputs(df, "name", "p", "*.png", recursive=False).collect()) == 6
    with pytest.raises(Exception, match="no files matched"):
        selection.inputs(df, "name", "p", "nothing*").collect()
    with pytest.raises(ValueError, match="no mode"):
        selection.inputs(df, "name", "p", mode="other")


def test_united_sources_and_csv_previews(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "x")], "k int, a string"), spark.createDataFrame([("y", 2)], "b string, k int")
    out = files.united({"first": a, "second": b})
    assert out.columns == ["k", "a", "b", "_source", "_order"] and sorted(map(tuple, out.collect()), key=str) == [(1, "x", None, "first", 0), (2, None, "y", "second", 1)]
    (tmp_path / "t.csv").write_text("a,b$c\n1,2\n3,4\n5,6\n")
    assert [tuple(r) for r in files.preview(spark, str(tmp_path / "t.csv"), 2, "csv").collect()] == [("1", "2"), ("3", "4")]
    assert files.row_count(spark, str(tmp_path / "t.csv"), "csv") == 3 and files.row_count(spark, str(tmp_path / "t.csv"), "other") == 0
    (tmp_path / "m.csv").write_text("﻿name; SBID ;Year\nx;7;1900\ny;7;1901\nz;q;1902\nw;8;\n")
    assert {tuple(r) for r in files.year_lookup(spark, str(tmp_path / "m.csv")).collect()} == {(7, 1901)}


def test_moves_that_meet(spark):
    from quillspark.operators import layout

    folders = spark.createDataFrame([("submit_20240101_000000",), ("20240101_000000",), ("local",), ("notes",), ("retrieve_a",), (None,)], "name string")
    plan = {r["from"]: (r["to"], r.reason) for r in layout.move_plan(folders, "name", spark.createDataFrame([("retrieves/a",)], "to string")).collect()}
    assert plan == {"submit_20240101_000000": ("submits/20240101_000000", None), "20240101_000000": ("local/20240101_000000", None), "notes": (None, "unrecognised"), "retrieve_a": (None, "destination exists")}
    moves = spark.createDataFrame([("20240101_000000", "local/20240101_000000")], "from string, to string")
    refs = spark.createDataFrame([(1, "runs/20240101_000000/d"), (2, "runs/submit_20240101_000000/d"), (3, "20240101_000000"), (4, None), (5, "runs/20240101_000000/d")], "k int, p string")
    got = {r.k: (r.p, r.fixed) for r in layout.rewritten(refs, "p", moves).collect()}
    # Only a whole component is a folder's name.
    assert got == {1: ("runs/local/20240101_000000/d", True), 2: ("runs/submit_20240101_000000/d", False), 3: ("20240101_000000", False), 4: (None, False), 5: ("runs/local/20240101_000000/d", True)}
    known = layout.documented(spark.createDataFrame([("local", "20240102_030405_x", None, ""), ("other", "y", "z", None)], "folder string, name string, kind string, created string"), "name", "kind", "created")
    assert {(r.kind, r.created) for r in known.collect()} == {("local", "2024-01-02T03:04:05"), ("z", "")}


def test_records_are_read_as_they_are_asked_for():
    """Of a file of 12 MB no more than a block is held decoded; a bad byte at its end raises before the first record."""
    import tracemalloc

    import pyarrow as pa

    body = pa.py_buffer(b"a,b\n" + b'1,"x\ny"\n' * 1_500_000)
    tracemalloc.start()
    try:
        read = files._records(body)
        got = [next(read) for _ in range(1000)]
        assert tracemalloc.get_traced_memory()[1] < 6 << 20
    finally:
        tracemalloc.stop()
    assert got[0] == {"a": "1", "b": "x\ny"} and sum(1 for _ in files._records(body.slice(0, 4 + 8 * 1000))) == 1000
    with pytest.raises(UnicodeDecodeError, match="position 12000004"):
        next(files._records(pa.py_buffer(body.to_pybytes() + b"\xff")))
