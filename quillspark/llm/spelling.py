"""Spelling variant grouping: words one edit apart, found in an inverted index of positional 2-grams with a count filter.

The vocabulary is counted first. The index is dealt out by parts of words: a word is cut into short parts, and one edit
changes one of them, so two near words agree in all before it and all behind it. All words that agree so are one bucket; the
2-grams that touch the changed part are indexed there by their place in it. Longer words are looked up from both ends of the
part, since an inserted letter moves what follows. The postings of a word's 2-grams are merged from a heap, and whoever shares
as many of them as one edit must leave is compared letter by letter. A bucket's words differ in 2 or 3 neighbouring letters
(up to an eighth of a word of over 24), so its size is bounded by the alphabet, not by the corpus.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import forget, written

#: Most letters of a part, and most parts of a word.
PART, PARTS = 3, 8
#: Words of which a task keeps count at once.
HELD = 200_000


def counted(documents: DataFrame, shortest: int, least: int, every: int) -> DataFrame:
    """word, n: the words of the texts, ``every``-th ones (by CRC-32 of id and word) short of a letter, and their occurrences."""
    runs = re.compile(f"[a-zÀ-ÿ]{{{shortest},}}")

    def of(batches):
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(runs.findall((text or b"").lower().decode())).items():
                    h = zlib.crc32(word.encode(), head)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < shortest:
                            continue
                    held[word] += n
                if len(held) >= HELD:
                    yield out()
        yield out()

    # Only A-Z is put in lower case: that is what lower() does with bytes.
    source = documents.select(F.col("doc_id").cast("string"), F.col("text").cast("string").cast("binary").alias("text"))
    return source.mapInArrow(of, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def parts(length: int) -> list[tuple[int, int]]:
    """Begin and end of each part of a word of ``length`` letters."""
    n = min(-(-length // PART), PARTS)
    return [(length * k // n, length * (k + 1) // n) for k in range(n)]


def dealt(words: DataFrame, shortest: int) -> DataFrame:
    """bucket, length, part, word, n: each word once for each part of it, and for each part of a word shorter by one letter."""
    letters = F.char_length("word")
    n = lambda length: F.least(F.ceil(length / PART), F.lit(PARTS)).cast("int")

    def rows(length: Column) -> Column:
        begin = lambda k: F.floor(length * k / n(length)).cast("int")
        # The letters before the part, and as many from the end as such a word has behind it.
        key = lambda k: F.struct(
            F.xxhash64(length, k, F.substring(F.col("word"), F.lit(1), begin(k)), F.substring(F.col("word"), letters - (length - begin(k + 1)) + 1, length)).alias("bucket"),
            length.alias("length"), k.alias("part"),
        )
        return F.transform(F.sequence(F.lit(0), n(length) - 1), key)

    shorter = F.when(letters > shortest, rows(letters - 1)).otherwise(F.array().cast("array<struct<bucket:bigint,length:int,part:int>>"))
    return words.select(F.explode(F.concat(rows(letters), shorter)).alias("k"), "word", "n").select("k.*", "word", "n")


def merged(lists: list[list[int]], least: int) -> Iterator[int]:
    """What stands in ``least`` or more of some ascending lists, by merging them from a heap."""
    if len(lists) >= least:
        for k, same in groupby(heapq.merge(*lists)):
            if sum(1 for _ in same) >= least:
                yield k


def near_pairs(short: list[str], long: list[str], begin: int, end: int, last: bool) -> Iterator[tuple[str, str]]:
    """Pairs one edit apart of a bucket: of ``short`` words among each other, and of a ``short`` and a ``long`` one.

    The words agree in all but the letters from ``begin`` to ``end`` (one further in the long ones). A pair that an inserted
    letter sets apart is found in the part in which the words first differ only, so it comes once.
    """
    size = end - begin
    gram = lambda w, k: f" {w} "[begin + k : begin + k + 2]
    index: defaultdict[tuple[int, str], list[int]] = defaultdict(list)
    for k, word in enumerate(short):
        keys = [(j, gram(word, j)) for j in range(size + 1)]
        # One letter replaced touches two 2-grams.
        for other in merged([index[key] for key in keys if key in index], size - 1):
            if sum(a != b for a, b in zip(word[begin:end], short[other][begin:end], strict=True)) == 1:
                yield short[other], word
        for key in keys:
            index[key].append(k)
    for word in long:
        keys = {(j, gram(word, j + moved)) for j in range(size + 1) for moved in (0, 1)}
        # One letter inserted touches one 2-gram of the shorter word.
        for other in merged([index[key] for key in keys if key in index], size):
            a, b = short[other][begin:end], word[begin : end + 1]
            same = next((j for j in range(size) if a[j] != b[j]), size)
            if a[same:] == b[same + 1 :] and (same < size or last):
                yield short[other], word


def neighbours(words: DataFrame, shortest: int) -> DataFrame:
    """word, n_near, best: for words with near words their number, and the one of the largest n as (-n, word)."""

    def of(batches):
        found: dict[str, tuple[int, tuple[int, str]]] = {}
        counts: dict[str, int] = {}

        def add(word: str, other: str) -> None:
            n, best = found.get(word, (0, (0, "")))
            found[word] = (n + 1, min(best, (-counts[other], other)))

        def out() -> pa.RecordBatch:
            near, best = [x[0] for x in found.values()], [x[1] for x in found.values()]
            columns = [pa.array(list(found), pa.string()), pa.array(near, pa.int64()), pa.array([-b[0] for b in best], pa.int64()), pa.array([b[1] for b in best], pa.string())]
            found.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "near_n", "near"])

        rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
        for _, bucket in groupby(rows, key=lambda row: row[0]):
            held = list(bucket)
            if len(held) < 2:
                continue
            # Unlike buckets may share a hash.
            own: defaultdict[tuple, tuple[list[str], list[str]]] = defaultdict(lambda: ([], []))
            for _, length, part, word, n in held:
                begin, end = parts(length)[part]
                longer = len(word) > length
                own[length, part, word[:begin], word[end + longer :]][longer].append(word)
                counts[word] = n
            for (length, part, _, rest), (short, long) in own.items():
                if short and len(short) + len(long) > 1:
                    for a, b in near_pairs(short, long, *parts(length)[part], not rest):
                        add(a, b)
                        add(b, a)
            counts.clear()
            if len(found) > HELD // 20:
                yield out()
        yield out()

    pairs = dealt(words, shortest).repartition("bucket").sortWithinPartitions("bucket").select("bucket", "length", "part", "word", "n")
    each = pairs.mapInArrow(of, "word string, n_near long, near_n long, near string")
    return each.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near").alias("word"))).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where one comes to from each word by following its ``form`` to the last.

    Each round doubles how far a word has come; a form occurs several times as often as its word, so the rounds are few.
    """
    held = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = held.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        new = written(held.select("word", "root").join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.isnotnull("_next").alias("_moved")), "roots")
        forget(held)
        held = new
        if held.where("_moved").isEmpty():
            return held.select("word", "root")


def variants(documents: DataFrame, shortest: int = 7, least: int = 2, ratio: int = 10, every: int = 31) -> DataFrame:
    """word, form, root, n, n_near, form_n: the words of the texts, each with the near word that it is a variant of.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case, of ``shortest`` letters and ``least`` occurrences
    or more; one of ``every`` runs of a document (by CRC-32 of id and run) is taken short of a letter. Near words differ by
    exactly one letter inserted, deleted or replaced. A word's form is its near word of the largest n (ties: the first in
    code-point order) if that is ``ratio`` times its own or more, else null; its root is where the forms end, the word itself
    if it has none. Null texts have no words, a null id counts as empty, repeated rows count as often as they occur, an empty
    table gives an empty one. Other columns are not read.
    """
    words = written(counted(documents, shortest, least, every), "words")
    near = neighbours(words, shortest)
    best = F.when(-F.col("best.minus_n") >= F.col("n") * ratio, F.col("best.word"))
    known = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), best.alias("form"), F.when(best.isNotNull(), -F.col("best.minus_n")).alias("form_n"))
    known = written(known, "variants")
    return known.join(roots(known.where("form IS NOT NULL")), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE_SQL = r"""
WITH RECURSIVE crcs AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS t
  FROM (SELECT unnest(range(0, 256)) AS b)
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc_id,
      unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]{7,}')) AS run
    FROM documents
  ) GROUP BY ALL
), hexed AS (
  SELECT run, n, hex(encode(doc_id || ':' || run)) AS x FROM runs
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    [4294967295] || list_transform(range(0, length(x) // 2), lambda k: ('0x' || x[2 * k + 1 : 2 * k + 2])::BIGINT),
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) AS h
  FROM hexed, crcs
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
  ) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), holes AS (
  SELECT word, substring(word, 1, i) AS head, substring(word, i + 2) AS rest FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other FROM holes a JOIN holes b USING (head, rest) WHERE a.word <> b.word
  UNION SELECT h.word, w.word FROM holes h JOIN words w ON w.word = h.head || h.rest
  UNION SELECT w.word, h.word FROM holes h JOIN words w ON w.word = h.head || h.rest
), best AS (
  SELECT near.word, count(*) AS n_near, min({'m': -words.n, 'w': other}) AS b FROM near JOIN words ON words.word = other GROUP BY near.word
), known AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN -b.m >= 10 * n THEN b.w END AS form, CASE WHEN -b.m >= 10 * n THEN -b.m END AS form_n
  FROM words LEFT JOIN best USING (word)
), steps AS (
  SELECT word, word AS here, 0 AS step FROM known
  UNION ALL SELECT s.word, k.form, step + 1 FROM steps s JOIN known k ON k.word = s.here WHERE k.form IS NOT NULL
), ends AS (
  SELECT word, arg_max(here, step) AS root FROM steps GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM known JOIN ends USING (word)
"""
