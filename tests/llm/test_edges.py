"""Every corpus operator and pipeline stage on nulls, blanks, ties, repeated rows, long texts, empty tables and clashing columns."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillspark.llm import chat, decontaminate, html_text, knn_quality, packing, queries, secrets, simhash, srs, substrings, toxicity

#: Names that operators use inside, as columns of the input.
CLASHES = ["k1", "k2", "_k1", "_fp", "_rank", "_hash", "_kept", "_con_id", "_sub_id", "_sub_ranges", "_sub_own", "text_hash", "fp", "least", "place", "label", "score", "_quality", "n_words", "_n_words", "term", "position", "a.b", "Hit_Items"]


@pytest.fixture(scope="module")
def odd(spark):
    r = random.Random(1)
    said = lambda n: " ".join(r.choice(["ka", "lo", "mi", "nu", "pe", "ro", "sa", "tu"]) + r.choice(["ban", "der", "fil", "gor", "hum"]) for _ in range(n))
    long, shared = said(60_000), said(55)
    rows = [(1, said(80)), (2, None), (3, ""), (4, " \t\n"), (5, long), (6, shared), (7, f"x {shared} y"), (7, f"x {shared} y"), (7, "other text of the id"), (None, shared), (None, None), (None, None), (8, "w" * 200_000), (9, said(80)), (10, "a\x00b ퟿ 😀")]
    rows += [(20 + k, said(40)) for k in range(20)]
    df = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.repartition(3).cache()


@pytest.fixture(scope="module")
def clashing(odd):
    return odd.withColumns({c: F.lit("there") for c in CLASHES})


@pytest.fixture(scope="module")
def folder(spark, odd, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    shared = odd.where("doc_id = 6").first().text
    spark.createDataFrame([(k, k % 2, int(k % 3 == 0)) for k in range(40)] + [(1, None, None), (None, 1, 1), (6, 2, 7)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, shared), (1, "another text of it"), (2, None), (3, ""), (None, shared)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def on_documents(spark, folder):
    labels, bench = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("labels", "benchmark"))
    return {
        "quality": lambda d: knn_quality.quality(d, labels), "simhash": simhash.near_duplicates, "one": simhash.one_of_each, "toxicity": lambda d: toxicity.toxicity(d, labels),
        "contamination": lambda d: decontaminate.contamination(d, bench), "clean": lambda d: decontaminate.clean(d, bench), "scan": secrets.scan, "redact": secrets.redact,
        "substrings": substrings.dedup, "packing": lambda d: packing.pack(d, queries.tokenizer_path()),
    }


NAMES = ["quality", "simhash", "one", "toxicity", "contamination", "clean", "scan", "redact", "substrings", "packing"]


@pytest.mark.parametrize("name", NAMES)
def test_clashing_columns_change_nothing(spark, odd, clashing, folder, name):
    run = on_documents(spark, folder)[name]
    plain, clashed = run(odd), run(clashing)
    same = [c for c in plain.columns if c in clashed.columns and c not in CLASHES or c in ("score", "n_words") and name not in ("one", "clean", "redact", "scan")]
    show = lambda df: sorted(map(repr, df.select(*[F.col(f"`{c}`") for c in same if c not in ("sequence_id", "offset", "padded_length")]).collect()))
    assert show(plain) == show(clashed)
    if name in ("one", "clean", "redact"):
        assert clashed.columns == clashing.columns and clashed.where("`a.b` <> 'there' OR _kept <> 'there'").count() == 0
    if name not in ("one", "clean", "packing"):
        assert plain.count() == odd.count()
    assert run(odd.limit(0)).count() == 0


def test_stages_on_odd_documents(spark, odd, clashing, folder):
    kept = clashing
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, clashing.limit(0), folder).count() == 0, name
        kept = stage(spark, kept, folder).cache()
        assert kept.columns == clashing.columns, name
    rows = kept.collect()
    assert sum(r.text is None for r in rows) <= 1 and not any(r.doc_id in (6, 7) and "x " in (r.text or "") for r in rows)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, folder)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in rows}


def test_contamination_keeps_texts_of_one_id_apart(spark, odd, folder):
    got = decontaminate.contamination(odd, spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert sorted((r.doc_id or 0, r.contaminated) for r in got.where("doc_id = 7 or doc_id is null or doc_id = 6").collect()) == [(0, False), (0, False), (0, True), (6, True), (7, False), (7, True), (7, True)]


def test_labels_beyond_zero_and_one_do_not_count(spark, odd, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    other = labels.unionByName(spark.createDataFrame([(24, 5, -1)], labels.schema)).where("doc_id is null or doc_id <> 6")
    for run in (knn_quality.quality, toxicity.toxicity):
        a, b = (sorted((r.doc_id or -1, r.score) for r in run(odd, x).collect()) for x in (labels.where("doc_id is null or doc_id not in (6, 24)"), other.where("doc_id is null or not (doc_id = 24 and quality < 2)")))
        assert a == b


def test_vectors_pages_and_conversations_with_clashing_columns(spark):
    names = {c: F.lit("x") for c in ("id", "vec", "cell", "shard", "_html", "chunk", "a", "b", "block", "_kept", "turns")}
    vectors = spark.createDataFrame([(k, [float(k % 7), 1.0, float(k)]) for k in range(50)], "vec_id long, embedding array<double>")
    assert srs.nearest(vectors.withColumns(names), F.col("id") % 20 == 0, k=3).count() == 9
    pages = spark.createDataFrame([(1, "<p>Some words of it.</p>"), (2, None)], "page_id long, html string").withColumns(names)
    assert sorted((r.page_id, r.text) for r in html_text.main_text(pages).collect()) == [(1, "Some words of it."), (2, "")]
    talk = spark.createDataFrame([(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, None, "y" * 100_000)], "conv_id long, turn long, role string, text string").withColumns(names)
    assert [r.conv_id for r in chat.chat_format(talk).collect()] == [2]
