"""Collocations, best-two-fit packing and spelling variants against plain versions, and on odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillspark.llm import best_fit, collocations, queries, spelling

CLASHES = ["word", "n", "phrase", "a", "k", "w", "bucket", "near", "form", "_moved", "piece", "group", "place", "none", "Words", "a.b", "_deal"]


def plain_phrases(rows, least=3, longest=4, top=2000, share=80):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + m])) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    found = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    inside = defaultdict(int)
    for (lang, p), a in found.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                inside[lang, p[i : i + m]] = max(inside[lang, p[i : i + m]], a)
    out = defaultdict(list)
    for (lang, p), a in found.items():
        if 100 * inside[lang, p] < share * a or not inside[lang, p]:
            score, k = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, x, y, n[lang], -s) for lang, all_of in out.items() for rank, (s, a, p, x, y) in enumerate(sorted(all_of)[:top], 1))


@pytest.fixture(scope="module")
def talk(spark):
    r = random.Random(3)
    said = lambda: " ".join(r.choice(["New", "york", "CITY", "hall", "Ärger", "of", "of", "mind"]) + r.choice(["", "", "", ",", ".", "\t", "\n", "\x0b"]) for _ in range(r.randrange(60)))
    rows = [(k, r.choice(["en", "de", None, "und"]), said()) for k in range(60)] + [(None, "en", None), (None, None, ""), (70, "en", " \t.,"), (70, "en", "x\x00 y\x1c  z" * 40), (71, "xx", "a b " * 20_000), (71, "xx", "a b " * 20_000)]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4).cache()


def test_phrases_as_a_plain_count(spark, talk, monkeypatch):
    want = plain_phrases([(x.lang, x.text) for x in talk.collect()])
    got = sorted(map(tuple, collocations.collocations(talk, least=3).collect()))
    assert got == want and len(want) > 20
    # A sketch of few cells lets nearly all through: the same comes out.
    assert sorted(map(tuple, collocations.collocations(talk, least=3, bits=4, rows=1).collect())) == want
    clashed = talk.withColumns({c: F.lit("x") for c in CLASHES})
    assert sorted(map(tuple, collocations.collocations(clashed, least=3, bits=12, top=5).collect())) == plain_phrases([(x.lang, x.text) for x in talk.collect()], top=5)
    assert collocations.collocations(talk.limit(0)).count() == 0


def test_sketches_are_never_too_low(spark, talk):
    texts = talk.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    reached = {(r.row, r.block): np.frombuffer(r.reached, dtype=np.uint8) for r in collocations.merged(collocations.sketches(texts, 30, 2, 12, 2), 30).collect()}
    n = Counter()
    for chunk in collocations.chunks([b for b in texts.toArrow().to_batches()]):
        for _, _, hashes in chunk.ngrams(2):
            n.update(hashes.tolist())
    for h, times in n.items():
        if times >= 30:
            for row in range(2):
                cell = int(collocations.cells(np.array([h], dtype=np.uint64), row, 12)[0])
                assert reached[row, 0][cell >> 3] >> (cell & 7) & 1
    assert sum(np.unpackbits(x).sum() for x in reached.values()) < 2 * len(n)


@pytest.mark.parametrize("seed", range(3))
def test_best_two_fit_is_tight(seed):
    r = random.Random(seed)
    sizes = [min(2048, max(1, int(r.lognormvariate(5.5, 1.2)))) for _ in range(3000)]
    bins = best_fit.best_two_fit(sizes, 2048)
    assert sorted(p for b in bins for p in b) == list(range(3000)) and all(sum(sizes[p] for p in b) <= 2048 for b in bins)
    assert len(bins) <= -(-sum(sizes) // 2048) + 1


def test_two_replace_the_shortest():
    # Greedily 6 + 3 leaves 1 of 10; 2 + 2 in place of the 3 fill it.
    assert sorted(map(sorted, best_fit.best_two_fit([6, 3, 2, 2], 10))) == [[0, 2, 3], [1]]
    assert best_fit.best_two_fit([], 10) == [] and best_fit.best_two_fit([10, 10], 10) == [[0], [1]]


def test_pieces_are_whole_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    odd = spark.createDataFrame([(None, None), (None, ""), (7, "the cat"), (7, "the cat"), (-1, "word " * 9000)], "doc_id long, text string")
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    for df, rows in ((docs, queries.op12_best_fit(spark, small).collect()), (odd, best_fit.pack(odd.withColumns({c: F.lit("x") for c in CLASHES}), queries.tokenizer_path()).collect())):
        want = Counter()
        for doc_id, text in df.select("doc_id", "text").collect():
            ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
            for a in range(0, len(ids), 2048):
                own = ids[a : a + 2048]
                want[doc_id, a // 2048, a, len(own), zlib.crc32(np.array(own, dtype="<u4").tobytes())] += 1
        assert Counter(tuple(r)[:5] for r in rows) == want
        held = defaultdict(list)
        for r in rows:
            held[r.sequence_id].append((r.offset, r.length))
        for pieces in held.values():
            end = 0
            for offset, length in sorted(pieces):
                assert offset == end
                end += length
            assert end <= 2048
        tokens = sum(r.length for r in rows)
        assert len(held) <= -(-tokens // 2048) + 1
    assert best_fit.pack(odd.limit(0), queries.tokenizer_path()).count() == 0


def plain_variants(rows, shortest=7, least=2, ratio=10, every=31):
    words = Counter()
    for doc_id, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for w in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            words[w] += 1
    words = {w: n for w, n in words.items() if n >= least and len(w) >= shortest}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    near = {w: [o for o in words if abs(len(o) - len(w)) < 2 and one_edit(o, w)] for w in words}
    form = {w: best[1] if near[w] and -(best := min((-words[o], o) for o in near[w]))[0] >= ratio * n else None for w, n in words.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


@pytest.mark.parametrize("every", [31, 2])
def test_variants_of_short_alphabets(spark, every):
    """Few letters, so that runs of one letter, moved letters and edits at both ends abound; long words too."""
    r = random.Random(every)
    word = lambda: "".join(r.choice("aaabé") for _ in range(r.choice([6, 7, 7, 8, 8, 9, 13])))
    rows = [(k % 50, " ".join(word() + r.choice(["", "-", "1"]) for _ in range(60)).replace("b", r.choice("bB"))) for k in range(60)]
    rows += [(None, None), (None, ""), (3, "y" * 5_000), (4, "Y" * 5_000), (5, "y" * 4_999 + " " + "y" * 4_999), (6, "aaaaaaa " * 3000), (6, "aaaaaaa " * 3000), (7, "abcdefghijklmnopqrstuvwxyzabcdef " * 3 + "abcdefghijklmnopqrstuvwxyzabcdeg " * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = plain_variants(rows, every=every)
    assert {tuple(x) for x in spelling.variants(df.withColumns({c: F.lit("x") for c in CLASHES}), every=every).collect()} == want
    assert sum(x[4] > 0 for x in want) > 50 and any(x[1] for x in want)
    assert spelling.variants(df.limit(0)).count() == 0


def test_forms_are_followed_to_the_last(spark):
    forms = spark.createDataFrame([(str(k), str(k + 1)) for k in range(11)], "word string, form string")
    assert {r.word: r.root for r in spelling.roots(forms).collect()} == {str(k): "11" for k in range(11)}


@pytest.mark.parametrize("name", ["op11_collocations", "op13_spelling"])
def test_counting_queries_match_their_sql(spark, small, name):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    got = queries.QUERIES[name](spark, small)
    want = duck.execute(queries.ORACLE_SQL[name]).fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want)) and want
