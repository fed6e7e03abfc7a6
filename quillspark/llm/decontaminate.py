"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

One pass tokenises the corpus and stores the postings (document, term, position) of every word that the benchmark has; a
term is a word's 64-bit hash, and a document's key 128 bits of hash of its id and text. A
window (``width`` consecutive benchmark words; a shorter item is one window) is looked up from its two rarest words: their
lists, moved by the words' offsets in the item, are intersected, which leaves a few places (document, item, offset between
the two). There the lists of all words around are intersected, and runs of ``width`` agreeing words are the exact matches.
A window that several items have is looked for in one of them only, and the items come last: a template in thousands of
benchmark items costs what it costs in one. ``proximity`` finds near matches on the same index.

What is broadcast is counted first: vocabulary, rare words and documents with candidates are broadcast while they number at
most ``BROADCAST_ROWS``; beyond that the whole vocabulary is indexed, and the others are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import forget, fresh, written
from quillspark.operators.skew import lookup

#: What stands between words whether A-Z are lower-cased or not: ASCII but letters and digits, one by one, which matches faster than ranges.
GAP = "[" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: At most so many rows are broadcast: some ten MB.
BROADCAST_ROWS = 400_000
#: Stands behind the last word of each document in the index, so that every document and its number of words is there.
END = " "
DOC = ["k1", "k2"]


def _split(text: Column) -> Column:
    """Words of a text, not yet lower-cased: runs of digits, letters and non-ASCII characters. Null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def _lowered(word: Column) -> Column:
    """A-Z lower-cased; where all is ASCII that is what ``lower`` does, and it is faster."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased."""
    return F.transform(_split(text), _lowered)


def _small(df: DataFrame) -> DataFrame:
    """``df`` to be broadcast if its checked size allows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def doc_key(documents: DataFrame) -> list[Column]:
    """128 bits of hash of a row's id and text, nulls told apart; rows of one doc_id with different texts differ."""
    known = [F.col("doc_id"), F.col("doc_id").isNull(), F.col("text"), F.col("text").isNull()]
    return [F.xxhash64(*known), F.xxhash64(*known[::-1])]


def _term(word: Column) -> Column:
    return F.xxhash64(_lowered(word))


def items(benchmark: DataFrame, width: int) -> DataFrame:
    """item_id, item, n, size, at, term: a row for each word of each item with an id and words.

    ``item`` is a hash of id and words, so texts that share an item_id stay apart; ``size`` is the length of its windows.
    """
    held = benchmark.where(F.col("item_id").isNotNull()).select("item_id", words(F.col("text")).alias("words")).distinct()
    n = F.size("words")
    return held.where(n > 0).select(
        "item_id", F.xxhash64("item_id", "words").alias("item"), n.alias("n"), F.least(n, F.lit(width)).alias("size"), F.posexplode(F.transform("words", _term)).alias("at", "term")
    )


def index(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """k1, k2, term, position: the stored postings of ``terms`` (term), and the END of every document."""
    # Keys come first: beside posexplode they would be computed anew for each word.
    keyed = documents.select(*[k.alias(c) for k, c in zip(doc_key(documents), DOC, strict=True)], "text")
    each = keyed.select(*DOC, F.posexplode(F.array_append(_split(F.col("text")), F.lit(END))).alias("position", "word"))
    each = each.select(*DOC, _term(F.col("word")).alias("term"), "position")
    vocabulary = terms.select("term").union(terms.sparkSession.range(1).select(F.xxhash64(F.lit(END)).alias("term"))).distinct()
    small = vocabulary.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    # Beyond the bound, a join would shuffle all words; indexing all of them does not.
    return written(each.join(F.broadcast(vocabulary), "term", "left_semi").select(*DOC, "term", "position") if small else each, "postings")


def distinct_windows(words_of: DataFrame) -> DataFrame:
    """w1, w2, item, start, item_id, here: every window of every item, under 128 bits of hash of its words; ``here`` is true at
    one item and start of each different window."""
    texts = words_of.groupBy("item", "size").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "term"))), lambda w: w["term"]).alias("terms"), F.min("item_id").alias("item_id"))
    starts = F.sequence(F.lit(0), F.size("terms") - F.col("size"))
    each = texts.select("item", "item_id", F.explode(F.transform(starts, lambda s: F.struct(s.alias("start"), F.slice("terms", s + 1, F.col("size")).alias("w")))).alias("x"))
    each = each.select("item", "item_id", "x.start", F.xxhash64("x.w").alias("w1"), F.xxhash64(F.size("x.w"), F.reverse("x.w")).alias("w2"))
    first = each.groupBy("w1", "w2").agg(F.min(F.struct("item", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
    return lookup(each, first, ["w1", "w2"], size="n").select("w1", "w2", "item", "start", "item_id", (F.col("first") == F.struct("item", "start")).alias("here"))


def rarest(words_of: DataFrame, postings: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """item_id, item, n, size, start, ats: each window that may match, with the places of its two rarest words, rarest first.

    With ``only`` (item, start) just those windows are looked at. Rarity is the length of a word's list; ties go to the smaller term, then the smaller place. A window with a word that no
    document has cannot match and is left out.
    """
    lists = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    known = words_of.join(lists, "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    first = F.greatest(F.col("at") - F.col("size") + 1, F.lit(0))
    each = known.withColumn("start", F.explode(F.sequence(first, F.least(F.col("at"), F.col("n") - F.col("size")))))
    each = each if only is None else each.join(_small(only), ["item", "start"], "left_semi")
    ranked = each.groupBy("item_id", "item", "n", "size", "start").agg(F.array_sort(F.collect_list(F.struct("df", "term", "at"))).alias("ranked"))
    # A word that comes twice has one list; the second is that of another word, where there is one.
    other = F.filter("ranked", lambda r: r["term"] != F.col("ranked")[0]["term"])
    ats = F.array_distinct(F.array(F.col("ranked")[0]["at"], F.coalesce(F.try_element_at(other, F.lit(1)), F.col("ranked")[0])["at"]))
    return ranked.where(F.col("ranked")[0]["df"] > 0).select("item_id", "item", "n", "size", "start", ats.alias("ats"))


def candidates(postings: DataFrame, words_of: DataFrame, windows: DataFrame) -> DataFrame:
    """k1, k2, item, shift, low, high: places where the two rarest words of a window may stand as in the item.

    ``shift`` is a word's position in the document less its place in the item, ``low`` and ``high`` the first and last place
    seen there. Each list is read once, for all windows that its word is rare in.
    """
    rare = windows.select("item", F.explode("ats").alias("at"), F.size("ats").alias("need")).groupBy("item", "at").agg(F.min("need").alias("need"))
    rare = rare.join(words_of.select("item", "at", "term"), ["item", "at"])
    shifted = postings.join(_small(rare), "term").select(*DOC, "item", "need", (F.col("position") - F.col("at")).alias("shift"), "at")
    met = shifted.groupBy(*DOC, "item", "shift").agg(F.min("at").alias("low"), F.max("at").alias("high"), F.min("need").alias("need"))
    return met.where((F.col("need") == 1) | (F.col("low") < F.col("high"))).drop("need")


def matches(postings: DataFrame, benchmark: DataFrame, width: int = 13) -> tuple[DataFrame, DataFrame]:
    """(k1, k2, w1, w2, first, size: each exact occurrence of a benchmark window, from ``first`` on in the document;
    w1, w2, item_ids: the items of each window), both written."""
    # Some hundred words a benchmark item; read several times below.
    words_of = written(items(benchmark, width), "items")
    known = written(distinct_windows(words_of), "known")
    windows = written(rarest(words_of, postings, known.where("here").select("item", "start")), "windows")
    found = written(candidates(postings, words_of, windows), "candidates")
    low, high = F.greatest(F.col("low") - F.col("size") + 1, F.lit(0)), F.least(F.col("high") + F.col("size") - 1, F.col("n") - 1)
    lengths = words_of.select("item", "n", "size").distinct()
    asked = found.join(_small(lengths), "item").select(*DOC, "item", "size", "shift", F.explode(F.sequence(low, high)).alias("at"))
    asked = asked.join(_small(words_of.select("item", "at", "term")), ["item", "at"]).withColumn("position", F.col("shift") + F.col("at"))
    # Only the lists of documents with candidates are intersected; the first key alone tells most of them.
    near = postings.join(_small(found.select("k1").distinct()), "k1", "left_semi")
    agreed = near.join(asked, [*DOC, "term", "position"]).groupBy(*DOC, "item", "size", "shift").agg(F.array_sort(F.collect_set("at")).alias("ats"))
    # A run of as many words as a window has begins wherever the word that many places on is that much further.
    whole = F.filter("ats", lambda at, k: F.get("ats", k + F.col("size") - 1) == at + F.col("size") - 1)
    runs = agreed.select(*DOC, "item", "size", "shift", F.explode(whole).alias("start"))
    hits = runs.join(_small(known.select("item", "start", "w1", "w2")), ["item", "start"]).select(*DOC, "w1", "w2", (F.col("shift") + F.col("start")).alias("first"), "size").distinct()
    hits, owners = written(hits, "matches"), written(known.groupBy("w1", "w2").agg(F.collect_set(F.col("item_id").cast("string")).alias("item_ids")), "owners")
    for df in (words_of, known, windows, found):
        forget(df)
    return hits, owners


def proximity(documents: DataFrame, benchmark: DataFrame, width: int = 13, within: int = 12) -> DataFrame:
    """doc_id, item_id, start, position: places where every word of a window stands near its rarest word, in any order.

    All words of the window occur among the ``within`` words on either side of ``position``. Exact matches are among them
    when ``within >= width - 1``.
    """
    words_of = written(items(benchmark, width), "items")
    postings = index(documents, words_of)
    windows = written(rarest(words_of, postings), "windows")
    inside = (F.col("at") >= F.col("start")) & (F.col("at") < F.col("start") + F.col("size"))
    asked = windows.select("item", "start", "ats").join(words_of, "item").where(inside)
    need = asked.groupBy("item_id", "item", "start").agg(F.count_distinct("term").alias("need"))
    rare = windows.select("item", "start", F.col("ats")[0].alias("at")).join(words_of, ["item", "at"]).select("item", "start", "term")
    spot = postings.join(_small(rare), "term").select(*DOC, "item", "start", F.col("position").alias("spot")).distinct()
    # Positions within reach lie in the spot's stretch of the document or one beside it.
    reach = F.lit(within + 1)
    stretch = F.floor(F.col("spot") / reach)
    terms = asked.select("item", "start", "term").distinct()
    beside = spot.join(_small(terms), ["item", "start"]).withColumn("stretch", F.explode(F.array(stretch - 1, stretch, stretch + 1)))
    near = postings.join(_small(spot.select("k1").distinct()), "k1", "left_semi").withColumn("stretch", F.floor(F.col("position") / reach))
    seen = near.join(beside, [*DOC, "term", "stretch"]).where(F.abs(F.col("position") - F.col("spot")) <= within)
    full = seen.groupBy(*DOC, "item", "start", "spot").agg(F.count_distinct("term").alias("have")).join(_small(need), ["item", "start"]).where("have = need")
    ids = documents.select("doc_id", *[k.alias(c) for k, c in zip(doc_key(documents), DOC, strict=True)]).distinct()
    return full.join(ids, DOC).select("doc_id", "item_id", "start", F.col("spot").alias("position")).distinct()


def _judged(postings: DataFrame, benchmark: DataFrame, width: int, share: int) -> DataFrame:
    """k1, k2, n_words, n_hit, hit_items, contaminated of the documents with matches."""
    hits, owners = matches(postings, benchmark, width)
    places = hits.select(*DOC, F.explode(F.sequence(F.col("first"), F.col("first") + F.col("size") - 1)).alias("place")).distinct()
    n_hit = places.groupBy(*DOC).agg(F.count(F.lit(1)).alias("n_hit"))
    # Documents with the same windows have the same items: they are put together once for each such set of windows.
    sets = hits.groupBy(*DOC).agg(F.array_sort(F.collect_set(F.struct("w1", "w2"))).alias("ws")).withColumns({"s1": F.xxhash64("ws"), "s2": F.xxhash64(F.reverse("ws"))})
    sets = written(sets, "sets")
    each = sets.groupBy("s1", "s2").agg(F.first("ws").alias("ws")).select("s1", "s2", F.explode("ws").alias("w")).select("s1", "s2", "w.*")
    by_set = each.join(_small(owners), ["w1", "w2"]).select("s1", "s2", F.explode("item_ids").alias("item_id")).groupBy("s1", "s2").agg(F.array_sort(F.collect_set("item_id")).alias("hit_items"))
    met = n_hit.join(sets.select(*DOC, "s1", "s2").join(_small(by_set), ["s1", "s2"]).drop("s1", "s2"), DOC)
    lengths = postings.where(F.col("term") == F.xxhash64(F.lit(END))).groupBy(*DOC).agg(F.max("position").cast("long").alias("n_words"))
    return lengths.join(met, DOC, "left").withColumn("contaminated", F.coalesce(F.col("n_hit") * share >= F.col("n_words"), F.lit(False)))


def contamination(documents: DataFrame, benchmark: DataFrame, width: int = 13, share: int = 20) -> DataFrame:
    """All columns of ``documents``, and n_words, n_hit, n_items, items_sha256, contaminated.

    A word inside any occurrence of a window is hit; a document is contaminated if words are hit and ``share * n_hit >=
    n_words``. Rows of the same doc_id are told apart by their texts; a repeated row is returned as often as it occurs.
    Null texts and ids, empty tables and items without words give zero hits and the SHA-256 of the empty string; texts of any
    length are read whole. Columns of ``documents`` that have the names of results are replaced, others may have any names.
    """
    names = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    kept = [c for c in documents.columns if c.lower() not in names]
    postings = index(documents, items(benchmark, width))
    inner = fresh(documents, "_k1", "_k2", "_n_words", "_n_hit", "_hit_items", "_contaminated")
    judged = written(_judged(postings, benchmark, width, share).select(*DOC, "n_words", "n_hit", "hit_items", "contaminated").toDF(*inner), "judged")
    forget(postings)
    k1, k2, n_words, n_hit, hit_items, contaminated = inner
    held = documents.withColumns(dict(zip(inner[:2], doc_key(documents), strict=True))).select(*[F.col(f"`{c}`") for c in kept], k1, k2)
    found = F.coalesce(hit_items, F.array().cast("array<string>"))
    return held.join(judged, [k1, k2], "left").select(
        *[F.col(f"`{c}`") for c in kept], F.col(n_words).alias("n_words"), F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"), F.size(found).cast("long").alias("n_items"),
        F.sha2(F.array_join(found, ",").cast("binary"), 256).alias("items_sha256"), F.col(contaminated).alias("contaminated"),
    )


def clean(documents: DataFrame, benchmark: DataFrame, width: int = 13, share: int = 20) -> DataFrame:
    """The rows of ``documents`` that ``contamination`` does not find contaminated, all columns as they are; the same cases hold."""
    postings = index(documents, items(benchmark, width))
    k1, k2 = fresh(documents, "_k1", "_k2")
    dirty = written(_judged(postings, benchmark, width, share).where("contaminated").select(*DOC).toDF(k1, k2), "contaminated")
    forget(postings)
    held = documents.withColumns(dict(zip((k1, k2), doc_key(documents), strict=True)))
    return held.join(_small(dirty), [k1, k2], "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns])


#: The same as ``contamination`` in DuckDB, for tables without repeated doc_ids.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ORACLE_SQL = f"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM benchmark WHERE item_id IS NOT NULL),
    i AS (SELECT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS phrase FROM (SELECT *, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS k FROM b WHERE len(w) > 0)),
    p AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM i))),
    h AS (SELECT DISTINCT doc_id, item_id, k, n FROM p JOIN i USING (n, phrase)),
    c AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM h) GROUP BY 1),
    g AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM h GROUP BY 1)
    SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
    FROM d LEFT JOIN c USING (doc_id) LEFT JOIN g USING (doc_id)
"""
