"""Substring dedup: passages of many words that a document of smaller id has too are removed, found through FM-indexes.

A window is ``length`` consecutive words. Its anchor, the least hash among its runs of ``GRAM`` words, depends on its words
alone, so equal windows share an anchor and windows are sharded by it: consecutive windows of one anchor are a segment.
Segments whose anchor only one document has cannot repeat and end there. The texts of the others, each kept once with its
least doc_id, go to shards of about ``SHARD_WORDS`` words. A shard builds a compressed FM-index over its texts and streams
them through it: backward search over the wavelet matrix gives the matching statistic of every place, and where that reaches
the threshold, the least doc_id among the match's suffixes is reported.

An anchor with more than ``HOT`` different texts (a passage repeated in many contexts) is cut again, by the least hash among
longer runs of words, of which the contexts have fewer in common; what only one text has ends there again. The last runs are
whole windows, each kept once, so that no shard grows with the corpus.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import forget, fresh, mapped, written
from quillspark.operators.skew import lookup
from quillspark.llm.fm_index import FMIndex, separated

GRAM, HOT, SHARD_WORDS = 8, 400, 60_000
#: Words of a window that the runs of a hot anchor's second cut leave out.
SPARE = 6
#: Windows of a segment, and words that are hashed at a time.
SEGMENT, STRETCH = 64, 100_000
#: Places of a shard's texts that are searched at a time.
STREAMED = 65_536
#: An odd multiplier and its inverse modulo 2^64, for hashes of byte runs by differences of prefix sums.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Segmenter:
    """Cuts texts into segments; keeps the powers of the hash between texts."""

    def __init__(self, length: int, gram: int = GRAM):
        self.length, self.gram, self.up, self.down = length, gram, _powers(_BASE, 1 << 16), _powers(_INVERSE, 1 << 16)

    def anchors(self, words: list[bytes]) -> np.ndarray:
        """The anchor of each window of ``words``."""
        joined = b" ".join(words)
        if len(joined) > len(self.up):
            self.up, self.down = _powers(_BASE, 2 * len(joined)), _powers(_INVERSE, 2 * len(joined))
        raw = np.frombuffer(joined, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(raw * self.up[: len(raw)])])
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        begins = (ends - lengths)[: len(words) - self.gram + 1]
        least = _mixed((sums[ends[self.gram - 1 :]] - sums[begins]) * self.down[begins])
        wide, step = self.length - self.gram + 1, 1
        while 2 * step <= wide:
            least, step = np.minimum(least[:-step], least[step:]), 2 * step
        rest = wide - step
        return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least

    def segments(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First window, number of windows, anchor of each segment of a text."""
        words = (text or "").encode("utf-8", "surrogatepass").split()
        n = len(words) - self.length + 1
        if n < 1:
            return (np.zeros(0, dtype=np.int64),) * 3
        anchor = np.concatenate([self.anchors(words[a : a + STRETCH + self.length - 1]) for a in range(0, n, STRETCH)])
        new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        run = np.diff(np.append(new, n))
        pieces = -(-run // SEGMENT)
        first = np.repeat(new, pieces) + SEGMENT * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        return first, np.diff(np.append(first, n)), anchor[first].view(np.int64)


def _cut(documents: DataFrame, length: int) -> DataFrame:
    """doc_id, text_hash, first, windows, anchor: the segments of all documents that have an id."""

    def of(batches):
        cutter = Segmenter(length)
        for batch in batches:
            found = [cutter.segments(t) for t in batch.column("text").to_pylist()]
            n = np.array([len(f[0]) for f in found], dtype=np.int64)
            rows = pa.array(np.repeat(np.arange(len(n)), n))
            columns = [pa.array(np.concatenate([f[k] for f in found])) for k in range(3)] if len(n) else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("text_hash").take(rows), columns[0].cast(pa.int32()), columns[1].cast(pa.int32()), columns[2]],
                names=["doc_id", "text_hash", "first", "windows", "anchor"],
            )

    return documents.where(F.col("doc_id").isNotNull()).mapInArrow(of, "doc_id long, text_hash long, first int, windows int, anchor long")


def _with_text(documents: DataFrame, segments: DataFrame, length: int) -> DataFrame:
    """The segments (doc_id, text_hash, first, windows, anchor) with their words, joined by one space, as text."""
    lists = segments.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("first", "windows", "anchor")).alias("segments"))

    def of(batches):
        for batch in batches:
            ids, hashes, texts, lists = (batch.column(c) for c in ("doc_id", "text_hash", "text", "segments"))
            rows, firsts, windows, anchors, out = [], [], [], [], []
            for row, (text, found) in enumerate(zip(texts.to_pylist(), lists.to_pylist(), strict=True)):
                words = text.encode("utf-8", "surrogatepass").split()
                joined = b" ".join(words)
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
                for s in found:
                    a, b = s["first"], s["first"] + s["windows"] + length - 2
                    begin = int(ends[a - 1]) + 1 if a else 0
                    rows.append(row)
                    firsts.append(a)
                    windows.append(s["windows"])
                    anchors.append(s["anchor"])
                    out.append(joined[begin : int(ends[b])].decode("utf-8", "surrogatepass"))
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids.take(at), hashes.take(at), pa.array(firsts, pa.int32()), pa.array(windows, pa.int32()), pa.array(anchors, pa.int64()), pa.array(out, pa.string())],
                names=["doc_id", "text_hash", "first", "windows", "anchor", "text"],
            )

    joined = documents.dropDuplicates(["doc_id", "text_hash"]).join(lists, ["doc_id", "text_hash"])
    return joined.select("doc_id", "text_hash", "text", "segments").mapInArrow(of, "doc_id long, text_hash long, first int, windows int, anchor long, text string")


def _searched(texts: DataFrame, length: int, words: int) -> DataFrame:
    """k1, k2, runs: for each text of a shard, runs of windows and the least doc_id that has them.

    ``texts`` has k1, k2, text, least and spread, which decides the shard; ``words`` is the sum of their words.
    """
    shards = max(1, -(-words // SHARD_WORDS))

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        split = [t.encode("utf-8", "surrogatepass").split() for t in rows["text"]]
        lengths = np.array([len(s) for s in split], dtype=np.int64)
        number: dict[bytes, int] = {}
        tokens = np.array([number.setdefault(w, len(number) + 1) for s in split for w in s], dtype=np.int64)
        index = FMIndex(tokens, lengths)
        stream, begins = separated(tokens, lengths)
        n = lengths - length + 1
        owner = np.repeat(np.arange(len(n)), n)
        ends = begins[owner] + length - 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        values = rows["least"].to_numpy(np.int64)
        least = values[owner]
        run, low, high = (np.concatenate(c) for c in zip(*(index.matching(stream, ends[a : a + STREAMED], length) for a in range(0, len(ends), STREAMED)), strict=True))
        above = run >= length
        least[above] = index.least(values, low[above], high[above])
        runs, at = [], 0
        for k in n.tolist():
            own = least[at : at + k]
            cut = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            runs.append([{"a": int(a), "b": int(b), "least": int(own[a])} for a, b in zip(cut, np.append(cut[1:], k), strict=True)])
            at += k
        return pd.DataFrame({"k1": rows["k1"], "k2": rows["k2"], "runs": runs})

    return texts.withColumn("shard", F.pmod("spread", F.lit(shards))).groupBy("shard").applyInPandas(of, "k1 long, k2 long, runs array<struct<a:int,b:int,least:long>>")


def _keyed(texts: DataFrame) -> DataFrame:
    """With k1, k2: 128 bits of hash of the text."""
    return texts.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit("again"), "text")})


def _cut_again(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """s1, s2, at, least, windows, anchor, text: the texts k1, k2 cut by the least hash among runs of ``gram`` words."""

    def of(batches):
        cutter = Segmenter(length, gram)
        for batch in batches:
            rows, firsts, windows, anchors, out = [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                words = text.split(" ")
                for first, n, anchor in zip(*(x.tolist() for x in cutter.segments(text)), strict=True):
                    rows.append(row)
                    firsts.append(first)
                    windows.append(n)
                    anchors.append(anchor)
                    out.append(" ".join(words[first : first + n + length - 1]))
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(at) for c in ("k1", "k2")), pa.array(firsts, pa.int32()), batch.column("least").take(at), pa.array(windows, pa.int32()), pa.array(anchors, pa.int64()), pa.array(out, pa.string())],
                names=["s1", "s2", "at", "least", "windows", "anchor", "text"],
            )

    return texts.select("k1", "k2", "least", "text").mapInArrow(of, "s1 long, s2 long, at int, least long, windows int, anchor long, text string")


def _distinct(found: DataFrame) -> DataFrame:
    """Each text of ``found`` once, with its least doc_id."""
    return found.groupBy("k1", "k2").agg(F.min("least").alias("least"), *(F.first(c).alias(c) for c in ("anchor", "windows", "text")))


def _answers(texts: DataFrame, length: int, grams: list[int]) -> DataFrame:
    """k1, k2, runs: what ``_searched`` gives for each of the distinct ``texts`` (k1, k2, least, windows, anchor, text).

    The texts of hot anchors are cut again by runs of ``grams[0]`` words, those of what is hot then by ``grams[1]``, and so
    on; the last of ``grams`` is ``length``, and of whole windows no anchor is hot.
    """
    hot = written(texts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("anchor"), "hot") if grams else None
    plain = lookup(texts, hot, ["anchor"], "left_anti") if hot else texts
    words = plain.agg(F.sum(F.col("windows") + (length - 1))).first()[0] or 0
    out = _searched(plain.select("k1", "k2", "text", "least", F.xxhash64("anchor").alias("spread")), length, words)
    if hot is None or hot.isEmpty():
        return out
    cut = written(_keyed(_cut_again(lookup(texts, hot, ["anchor"]), length, grams[0])), "cut")
    pieces = written(lookup(cut, cut.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")), ["anchor"], size="n"), "pieces")
    forget(cut)
    # A piece whose anchor no other has is nowhere else: its windows' least doc_id is that of its text.
    alone = pieces.where("n = 1").select("s1", "s2", F.array(F.struct(F.col("at").alias("a"), (F.col("at") + F.col("windows")).alias("b"), "least")).alias("runs"))
    several = pieces.where("n > 1")
    got = _answers(written(_distinct(several), "texts"), length, grams[1:])
    moved = F.transform("runs", lambda r: F.struct((r["a"] + F.col("at")).alias("a"), (r["b"] + F.col("at")).alias("b"), r["least"].alias("least")))
    back = several.select("k1", "k2", "s1", "s2", "at").join(got, ["k1", "k2"]).select("s1", "s2", moved.alias("runs"))
    return out.union(alone.union(back).groupBy("s1", "s2").agg(F.flatten(F.collect_list("runs")).alias("runs")))


def repeated(documents: DataFrame, length: int = 50) -> DataFrame:
    """doc_id, text_hash, ranges: word ranges [a, b) that windows cover which a document of smaller id has too.

    ``documents`` has doc_id, text and text_hash.
    """
    segments = written(_cut(documents, length), "segments")
    twice = segments.groupBy("anchor").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("anchor")
    found = written(_keyed(_with_text(documents, lookup(segments, twice, ["anchor"]), length)), "found")
    forget(segments)
    texts = written(_distinct(found.withColumn("least", F.col("doc_id"))), "texts")
    answers = written(_answers(texts, length, [max(GRAM, length - SPARE), length]), "answers")

    run = F.explode("runs")
    covered = found.select("doc_id", "text_hash", "first", "k1", "k2").join(answers, ["k1", "k2"]).select("doc_id", "text_hash", "first", run.alias("run")).where("run.least < doc_id")
    ranges = covered.select("doc_id", "text_hash", F.struct((F.col("first") + F.col("run.a")).alias("a"), (F.col("first") + F.col("run.b") + (length - 1)).alias("b")).alias("range"))
    return ranges.groupBy("doc_id", "text_hash").agg(F.collect_set("range").alias("ranges"))


def dedup(documents: DataFrame, length: int = 50) -> DataFrame:
    """All columns of ``documents``, and n_words, n_removed, kept: the text without the words of repeated windows.

    Each word covered by a window of ``length`` words whose words also stand in a document of smaller doc_id is removed;
    windows are judged on the input. ``kept`` is the remaining words joined by one space. Null texts have no words; texts
    with a null doc_id are neither changed nor compared; rows that share a doc_id do not count against each other, and
    repeated rows are returned as often as they occur. Columns called like results are replaced.
    """
    names = ["n_words", "n_removed", "kept"]
    held = documents.drop(*names)
    keyed = held.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    sub_id, sub_hash, sub_ranges, own = fresh(held, "_sub_id", "_sub_hash", "_sub_ranges", "_sub_own")
    ranges = repeated(keyed, length).toDF(sub_id, sub_hash, sub_ranges)
    joined = held.withColumn(own, F.xxhash64(F.col("text").cast("string"))).join(ranges, (F.col("doc_id").cast("long") == F.col(sub_id)) & (F.col(own) == F.col(sub_hash)), "left")
    columns = held.columns
    joined = joined.select(*[F.col(f"`{c}`") for c in columns], sub_ranges)
    where = columns.index("text")

    def of(batches):
        for batch in batches:
            n, removed, kept = [], [], []
            for text, found in zip(batch.column(where).to_pylist(), batch.column(len(columns)).to_pylist(), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                n.append(len(words))
                if found:
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(change, [r["a"] for r in found], 1)
                    np.add.at(change, [r["b"] for r in found], -1)
                    stays = np.cumsum(change)[:-1] == 0
                    words = [w for w, s in zip(words, stays.tolist(), strict=True) if s]
                removed.append(n[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=[*columns, *names])

    schema = held.schema
    out = type(schema)(schema.fields[:]).add("n_words", "long").add("n_removed", "long").add("kept", "string")
    return mapped(joined, of, out)


#: The digest of ``dedup`` in DuckDB, for tables without null or repeated doc_ids.
ORACLE_SQL = r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    p AS (SELECT doc_id, k, md5(array_to_string(w[k:k + 49], ' ')) AS h FROM (SELECT *, unnest(range(1, len(w) - 48)) AS k FROM d)),
    f AS (SELECT h, min(doc_id) AS least FROM p GROUP BY 1),
    g AS (SELECT DISTINCT doc_id, unnest(range(k, k + 50)) AS place FROM p JOIN f USING (h) WHERE least < doc_id),
    u AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM d),
    k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n FROM u ANTI JOIN g USING (doc_id, place) GROUP BY 1)
    SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
