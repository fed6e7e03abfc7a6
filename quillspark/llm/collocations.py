"""Phrase collocations: merged count-min sketches choose n-grams, a second pass counts the chosen ones exactly, then they are
scored and those inside longer ones go.

Each task counts the n-grams of its texts in a sketch of fixed size, and the sketches are added up block by block on the
executors. A sketch never counts too low, so an n-gram whose cells do not all reach the least count cannot be frequent: the
second pass leaves it out, and nothing frequent is lost. Counters stop at the least count, since only that is asked of them,
and so what the driver gets of the sum is one bit a cell. How large the sketch is decides how many n-grams the second pass
counts in vain, never what comes out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import written
from quillspark.operators.skew import lookup

#: Bytes that end a piece of a text; words end at blanks and tabs too.
ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(ord(".") if b in ENDS else b for b in range(256))
#: Tokens that are worked on at once, but a text is never cut.
CHUNK = 1_000_000
#: Cells of a block of a sketch.
BLOCK = 1 << 17
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(29))


def tokens(text: bytes | None) -> list[bytes]:
    """Words and ends of pieces, these as b".", of a text in UTF-8; A-Z in lower case. A null text has none."""
    return (text or b"").lower().translate(_TABLE).replace(b".", b" . ").split()


class Chunk:
    """Some texts' words: numbered, with the n-grams that do not run over the end of a piece."""

    def __init__(self, words: list[bytes], langs: list[str], lang_of: list[int], lengths: list[int]):
        """``words`` of all texts, one after the other; per text its number in ``langs`` and its number of words."""
        known = dict.fromkeys(words)
        del known[b"."]  # each text ends with one
        self.words, self.langs = words, langs
        numbers = {b".": -1} | {w: k for k, w in enumerate(known)}
        self.word = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        self.lang = np.repeat(np.array(lang_of, dtype=np.int64), lengths)
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in known] or [0], dtype=np.uint64)
        seeds = np.array([xxhash.xxh64_intdigest(x.encode(), 1) for x in langs], dtype=np.uint64)
        self.hash = hashes[self.word] ^ seeds[self.lang]
        self.inside = self.word >= 0

    def ngrams(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Order, places and hashes of the n-grams of each order from 1 to ``longest``."""
        inside, hashes, plain = self.inside, self.hash, self.hash
        for order in range(1, longest + 1):
            if order > 1:
                inside = inside[:-1] & self.inside[order - 1 :]
                hashes = hashes[:-1] * _MIX[0] + plain[order - 1 :]
                hashes = (hashes ^ (hashes >> _MIX[2])) * _MIX[1]
            at = np.flatnonzero(inside)
            yield order, at, hashes[at]


def chunks(batches) -> Iterator[Chunk]:
    """Chunks of the batches' texts (columns lang and text, this one as bytes)."""
    words: list[bytes] = []
    langs: dict[str, int] = {}
    order: list[int] = []
    lengths: list[int] = []

    for batch in batches:
        for lang, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            own = tokens(text)
            own.append(b".")
            words += own
            order.append(langs.setdefault(lang, len(langs)))
            lengths.append(len(own))
            if len(words) >= CHUNK:
                yield Chunk(words, list(langs), order, lengths)
                words, langs, order, lengths = [], {}, [], []
    if words:
        yield Chunk(words, list(langs), order, lengths)


def cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cell of each hash in one row of a sketch of 2 ** ``bits`` cells a row."""
    with np.errstate(over="ignore"):
        mixed = (hashes ^ (hashes >> np.uint64(32))) * (_MIX[row % 2] + np.uint64(2 * row))
    return (mixed >> np.uint64(64 - bits)).astype(np.uint32)


def sketches(texts: DataFrame, least: int, longest: int, bits: int, rows: int) -> DataFrame:
    """row, block, counts: the blocks, where not empty, of each task's count-min sketch, deflated."""

    def of(batches):
        sketch = np.zeros((rows, 1 << bits), dtype=np.uint8)
        for chunk in chunks(batches):
            for _, _, hashes in chunk.ngrams(longest):
                for row in range(rows):
                    found = np.sort(cells(hashes, row, bits))
                    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.zeros(0, dtype=np.int64)
                    n = np.minimum(np.diff(first, append=len(found)), least)
                    at = found[first]
                    sketch[row, at] = np.minimum(sketch[row, at] + n, least)
        for row in range(rows):
            for block in range(0, 1 << bits, BLOCK):
                part = sketch[row, block : block + BLOCK]
                if part.any():
                    # Few different bytes, so their code words alone make it small.
                    packer = zlib.compressobj(1, zlib.DEFLATED, -15, 9, zlib.Z_HUFFMAN_ONLY)
                    body = packer.compress(part.tobytes()) + packer.flush()
                    yield pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([block // BLOCK], pa.int32()), pa.array([body], pa.binary())], names=["row", "block", "counts"])

    return texts.mapInArrow(of, "row int, block int, counts binary")


def merged(parts: DataFrame, least: int) -> DataFrame:
    """row, block, reached: the sum of the sketches' blocks, as one bit a cell: whether it reaches ``least``.

    A task holds its own blocks' sums, whatever the number of sketches.
    """

    def of(batches):
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row, block, body in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                own = np.frombuffer(zlib.decompress(body, -15), dtype=np.uint8)
                sums = held.get((row, block))
                # Both are at most ``least``, below 128: no overflow.
                held[row, block] = own if sums is None else np.minimum(sums + own, least)
        for (row, block), sums in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([block], pa.int32()), pa.array([np.packbits(sums >= least, bitorder="little").tobytes()], pa.binary())], names=["row", "block", "reached"])

    return parts.repartition("row", "block").mapInArrow(of, "row int, block int, reached binary")


def counted(texts: DataFrame, reached: np.ndarray, longest: int, bits: int) -> DataFrame:
    """lang, words, phrase, a: how often each n-gram that the sketch lets through occurs in some texts; words is its order.
    Order 0 with an empty phrase is the number of all words. An n-gram may come in several rows, to be added up."""
    sent = texts.sparkSession.sparkContext.broadcast(reached)

    def of(batches):
        bitmap = sent.value
        for chunk in chunks(batches):
            out: list[tuple[np.ndarray, int, list[bytes], np.ndarray]] = []
            n = np.bincount(chunk.lang[chunk.inside], minlength=len(chunk.langs))
            out.append((np.flatnonzero(n), 0, [b""] * int((n > 0).sum()), n[n > 0]))
            # Numbers of the n-grams that begin at each place, among those of their order; -1 where one does not come through.
            before = single = np.full(len(chunk.word), -1, dtype=np.int64)
            for order, at, hashes in chunk.ngrams(longest):
                through = np.ones(len(at), dtype=bool)
                for row in range(len(bitmap)):
                    cell = cells(hashes, row, bits)
                    through &= (bitmap[row, cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0
                if order == 1:
                    at = at[through]
                    keys = chunk.word[at] * len(chunk.langs) + chunk.lang[at]
                else:
                    # What is frequent has frequent parts.
                    through &= (before[at] >= 0) & (before[at + 1] >= 0)
                    at = at[through]
                    keys = (before[at] << 32) | single[at + order - 1]
                if not len(at):
                    break
                _, first, inverse, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
                before = np.full(len(chunk.word), -1, dtype=np.int64)
                before[at] = inverse
                single = before if order == 1 else single
                place = at[first]
                out.append((chunk.lang[place], order, [b" ".join(chunk.words[p : p + order]) for p in place.tolist()], counts))
            names = np.array(chunk.langs, dtype=object)
            for lang, order, phrases, counts in out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[lang], pa.string()), pa.array([order] * len(phrases), pa.int32()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())],
                    names=["lang", "words", "phrase", "a"],
                )

    return texts.mapInArrow(of, "lang string, words int, phrase string, a long")


def frequent(documents: DataFrame, least: int = 30, longest: int = 4, bits: int = 25, rows: int = 2) -> DataFrame:
    """lang, words, phrase, a: all n-grams of up to ``longest`` words that occur ``least`` times or more in the texts of a
    language, and for each language a row of 0 words with the number of its words; written to the shared folder."""
    if not 0 < least < 128:
        raise ValueError("a sketch's counters go up to 127")
    texts = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").cast("binary").alias("text"))
    reached = np.zeros((rows, (1 << bits) // 8), dtype=np.uint8)
    for row, block, bitmap in merged(sketches(texts, least, longest, bits, rows), least).collect():  # one bit a cell
        reached[row, block * BLOCK // 8 : block * BLOCK // 8 + len(bitmap)] = np.frombuffer(bitmap, dtype=np.uint8)
    exact = counted(texts, reached, longest, bits).groupBy("lang", "words", "phrase").agg(F.sum("a").alias("a"))
    return written(exact.where((F.col("a") >= least) | (F.col("words") == 0)), "phrases")


def _wide(c: str):
    return F.col(c).cast("decimal(38,0)")


def collocations(documents: DataFrame, least: int = 30, longest: int = 4, top: int = 2000, share: int = 80, bits: int = 25, rows: int = 2) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best ``top`` phrases of 2 to ``longest`` words.

    A phrase occurs ``a`` times (``least`` or more) within pieces of texts; of its cuts into two parts the one of the lowest
    score, 2,000,000 a / (l + r) rounded down, counts; a phrase goes if ``share`` percent of its occurrences or more are
    inside one longer candidate's count. Null texts are empty, a null lang is und; repeated rows count as often as they
    occur; ties of score go by a, then by phrase; an empty table gives an empty one. Other columns are not read.
    """
    known = frequent(documents, least, longest, bits, rows)
    phrases = known.where("words >= 2")
    part = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    spread = phrases.withColumn("w", F.split("phrase", " ")).select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    sides = spread.select(
        "lang", "phrase", "a", "k", F.explode(F.array(F.struct(F.lit(0).alias("side"), part(F.lit(1), F.col("k")).alias("part")), F.struct(F.lit(1).alias("side"), part(F.col("k") + 1, F.size("w")).alias("part")))).alias("s")
    ).select("lang", "phrase", "a", "k", "s.*")
    parts = known.where("words >= 1").select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    found = lookup(sides, parts, ["lang", "part"])
    each = found.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"))
    # Whole numbers of up to 38 digits; div rounds down.
    scored = each.withColumn("score", F.expr("2000000BD * cast(a AS decimal(20,0)) div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0)))"))
    cut = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
    # The largest count of a longer candidate around each phrase.
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("w") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))))
    around = phrases.where("words >= 3").withColumn("w", F.split("phrase", " ")).select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = cut.join(around, ["lang", "phrase"], "left").where(F.isnull("longer") | (_wide("longer") * 100 < _wide("a") * share)).drop("longer")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First the best of each of 64 parts of a language, so that no task ranks a whole language.
    some = kept.withColumn("_deal", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_deal").orderBy(*order))).where(F.col("_place") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    sizes = known.where("words = 0").select("lang", F.col("a").alias("n"))
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", F.col("score").cast("long"))


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), lists AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \x09]+'), lambda x: x <> '') AS w FROM pieces
), sizes AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang
), grams AS (
  SELECT lang, m AS words, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS a
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM lists, (SELECT unnest([1, 2, 3, 4]) AS m))
  GROUP BY ALL HAVING count(*) >= 30
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE words >= 2
), cuts AS (
  SELECT lang, phrase, w, a, unnest(range(1, words)) AS k, words FROM candidates
), scored AS (
  SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a) // (x.a + y.a) AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:c.words], ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_parts AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, w, a, m, unnest(range(1, words - m + 2)) AS i FROM candidates, (SELECT unnest([2, 3]) AS m) WHERE m < words)
  GROUP BY ALL
), kept AS (
  SELECT z.* FROM lowest z LEFT JOIN inner_parts p ON p.lang = z.lang AND p.phrase = z.phrase
  WHERE p.longer IS NULL OR 100::HUGEINT * p.longer < 80::HUGEINT * z.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
