"""Queries that SQL cannot express, on whole small tables, against plain versions without Spark's part in them."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

import corpus_pipeline
from quillspark.llm import decontaminate, knn_quality, queries, secrets, toxicity
from tests.llm.test_text_operators import brute_components, brute_fingerprint


@pytest.fixture(scope="module")
def documents(spark, small):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}


def masked(model, text):
    """Spans that the forest itself takes for secrets, and the text without them."""
    spans = [(a, b) for a, b in secrets.candidates(text or "") if model.predictProbability(Vectors.dense(secrets.features(text, a, b)))[1] >= 0.5]
    out = text or ""
    for a, b in reversed(spans):
        out = out[:a] + secrets.MASK + out[b:]
    return spans, out


def test_secrets_query(spark, small, documents):
    model = secrets.forest(spark)
    rows = queries.op6_secrets(spark, small).collect()
    assert len(rows) == len(documents)
    for r in rows:
        spans, out = masked(model, documents[r.doc_id])
        assert [(f.start, f.start + f.length) for f in r.findings] == spans and r.redacted_sha256 == hashlib.sha256(out.encode()).hexdigest()


def test_words_after_a_value_count(spark):
    digest = "4d44c79e8bf7c55759c4958dd60ed83d2ef8cd4e"
    key = "q7ZP3LM9X2KD81TVw4Rb6YcN0sHf"
    texts = [f"{digest} (sha1)", f"{digest} is the commit", f"{key} # api key", f"{key} is our password"]
    out = secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [len(r.findings) for r in out] == [0, 0, 1, 1]


def test_quality_query(spark, small, documents):
    """Every cosine to every labelled text, in double precision, sorted."""
    model = knn_quality.fit(spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet"))

    def score(text):
        if not (text or "").split():
            return model.prior
        at, weight = knn_quality.terms(text)
        x = np.zeros(knn_quality.TERMS)
        x[at] = weight * model.idf[at]
        for part in (slice(0, knn_quality.CHARACTERS), slice(knn_quality.CHARACTERS, None)):
            x[part] /= np.linalg.norm(x[part]) + 1e-12
        v = x @ model.directions.astype(float)
        cosine = model.vectors.astype(float) @ (v / (np.linalg.norm(v) + 1e-12))
        near = sorted(range(len(cosine)), key=lambda k: -cosine[k])[: model.neighbours]
        votes = [max(cosine[k], 1e-6) ** model.power for k in near]
        return sum(v * model.labels[k] for v, k in zip(votes, near, strict=True)) / sum(votes)

    rows = queries.op2_quality(spark, small).collect()
    assert len(rows) == len(documents)
    for r in rows:
        assert r.score == pytest.approx(score(documents[r.doc_id]), abs=1e-3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3)


def plain_features(text, entries):
    """The features by their definitions: every word anew, every pair of places."""
    words, one = (text or "").split(), toxicity.Measures(entries)
    n = len(words)
    if not n:
        return [0.0] * len(toxicity.FEATURES)
    rows = [list(map(float, one.of(w))) for w in words]
    total = [sum(r[k] for r in rows) for k in range(10)]
    hits = [k for k, r in enumerate(rows) if r[0] or r[1] or r[4]]
    you = [k for k, r in enumerate(rows) if r[2]]
    spot = max((sum(a <= b < a + 50 for b in hits) for a in hits), default=0) / min(n, 50)
    near = sum(any(abs(a - b) <= 5 for b in you) for a in hits) / n
    whole = len(hits) - total[1] - total[4]
    letters = max(total[6], 1)
    return [np.log1p(n), whole / n, total[1] / n, np.log1p(len(hits)), spot, near, len(you) / n, total[5] / letters, total[7] / n, total[8] / n, total[9] / n, total[3] / n, total[4] / n]


def test_toxicity_query(spark, small, documents):
    model = toxicity.fit(spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet"))

    def leaf(tree, x):
        feature, threshold, left, right, value, _ = tree
        at = 0
        while feature[at] >= 0:
            at = left[at] if x[feature[at]] <= threshold[at] else right[at]
        return value[at]

    def score(text):
        x = plain_features(text, model.entries)
        p = 1 / (1 + np.exp(-2 * sum(w * leaf(t, x) for w, t in zip(model.weights, model.forest, strict=True))))
        return float(np.clip(np.interp(p, *model.steps) if model.steps else p, 0, 1))

    rows = queries.op4_toxicity(spark, small).collect()
    assert len(rows) == len(documents)
    for r in rows:
        assert r.score == pytest.approx(score(documents[r.doc_id]), abs=1e-6)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5)


def test_pipeline_query(spark, small, documents):
    """Stage after stage by plain loops; of the packing every document's ids, in pieces without gaps in full sequences."""
    from tokenizers import Tokenizer

    good = {r.doc_id for r in queries.op2_quality(spark, small).where("score >= 0.3").collect()}
    ids = sorted(good)
    component = brute_components([brute_fingerprint(documents[d]) for d in ids], ids)
    kept = {d: documents[d] for d, c in zip(ids, component, strict=True) if d == c}
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?)", list(kept.items()))
    duck.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{small}/benchmark.parquet'")
    bad = {d for d, c in duck.execute(f"SELECT doc_id, contaminated FROM ({decontaminate.ORACLE_SQL})").fetchall() if c}
    model = secrets.forest(spark)
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    want = {d: [*tokenizer.encode(masked(model, t)[1], add_special_tokens=False).ids, 2] for d, t in kept.items() if d not in bad}
    assert bad and len(want) < len(kept) < len(good) < len(documents)
    pieces = corpus_pipeline.run(spark, small).collect()
    assert {p.doc_id for p in pieces} == set(want)
    for d, encoded in want.items():
        at = 0
        for p in sorted((p for p in pieces if p.doc_id == d), key=lambda p: p.start):
            piece = np.array(encoded[p.start : p.start + p.length], dtype="<u4")
            assert p.start == at and p.doc_tokens == len(encoded) and p.ids_crc32 == zlib.crc32(piece.tobytes())
            at += p.length
        assert at == len(encoded)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for held in sequences.values():
        ends = [0]
        for offset, length in sorted(held):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 4096
    assert not any(re.search("AKIA[0-9A-Z]{16}", masked(model, t)[1]) for t in kept.values())
