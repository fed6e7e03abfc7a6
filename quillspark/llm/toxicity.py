"""Toxicity by gradient-boosted trees over dense features, calibrated isotonically.

The lexicon is learned from a bounded sample of labelled documents: words and word beginnings whose odds of standing in a
toxic document are high. Trees and calibration are MLlib's, fitted to that sample; their nodes are then broadcast, so one
pass over the corpus parses, measures and scores each whole text without a shuffle.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import held_out, labelled_sample, scored, written
from quillspark.llm.trees import boosted_score, exported

#: Lengths of the word beginnings that are counted beside whole words; entries kept at most.
BEGINNINGS, ENTRIES = (4, 5, 6, 7, 8), 400
#: Words whose measures a worker remembers (about 60 MB).
WORDS = 300_000
#: Pronouns of the second person.
YOU = frozenset("you your yours yourself u ur du dich dir dein deine deinen ihr euch tu toi te ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())
#: Letters that digits and signs stand for in obfuscated words.
PLAIN = str.maketrans("013457@$!", "oieastasi")
_LETTERS = re.compile(r"[^\W\d_]+")
FEATURES = ("log_words", "word_density", "start_density", "log_hits", "dense_spot", "near_you", "you_density", "capitals", "shouted", "exclaimed", "punctuation", "obfuscated", "obfuscated_hits")


def units(text: Column) -> Column:
    """Distinct lower-cased letter runs of a text, and their beginnings, marked by a trailing ``*``."""
    words = F.array_distinct(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+"), lambda w: w != ""))
    starts = [F.transform(F.filter(words, lambda w, n=n: F.length(w) > n), lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*"))) for n in BEGINNINGS]
    return F.array_distinct(F.concat(words, *starts))


def lexicon(sample: DataFrame, share: float = 0.015, log_odds: float = 2.5) -> dict[str, float]:
    """Units of the labelled sample by log-odds of label 1: at most ENTRIES, each in at least ``share`` of the toxic texts.

    Equal texts count once. That share keeps out the rare words of a few toxic texts and their near copies.
    """
    toxic = F.col("label") == 1
    sample = sample.dropDuplicates(["text", "label"])
    n = sample.agg(F.count_if(toxic), F.count_if(~toxic)).first()
    each = sample.select("label", F.explode(units(F.col("text"))).alias("unit")).groupBy("unit").agg(F.count_if(toxic).alias("t"), F.count_if(~toxic).alias("c"))
    odds = F.log((F.col("t") + 0.5) / (n[0] + 1)) - F.log((F.col("c") + 0.5) / (n[1] + 1))
    best = each.where(F.col("t") >= max(3.0, share * n[0])).withColumn("odds", odds).where(F.col("odds") >= log_odds)
    return {r["unit"]: r["odds"] for r in best.orderBy(F.desc("t"), F.desc("odds"), "unit").limit(ENTRIES).collect()}


class Measures:
    """What each word adds to the features, remembered between texts: at most WORDS words, then anew."""

    def __init__(self, entries: dict[str, float]):
        self.entries, self.known, self.table = entries, {}, np.zeros((WORDS, 10), dtype=np.float32)

    def listed(self, word: str) -> bool:
        return any(f"{word[:k]}*" in self.entries for k in BEGINNINGS if len(word) > k)

    def of(self, word: str) -> tuple:
        """hit, beginning only, second person, mixed, obfuscated hit, capitals, letters, shouted, exclamation marks, other signs."""
        lower = word.lower()
        runs = _LETTERS.findall(lower)
        hit = any(r in self.entries for r in runs)
        start = not hit and any(map(self.listed, runs))
        core = lower.strip(".,;:!?\"'()[]{}|#$%&*-")
        mixed = len(core) > 2 and not core.isalpha() and any(c.isalpha() for c in core)
        plain = re.sub(r"[^a-z]", "", core.translate(PLAIN)) if mixed and core.isascii() and len(core) < 40 else ""
        hidden = mixed and not hit and not start and (plain in self.entries or self.listed(plain))
        big, small = sum(c.isupper() for c in word), sum(map(len, runs))
        return hit, start, any(r in YOU for r in runs), mixed, hidden, big, small, small > 1 and big == small, word.count("!"), len(word) - small

    def rows(self, words: list[str]) -> np.ndarray:
        """A row a word."""
        known = self.known
        try:
            return self.table[[known[w] for w in words]]
        except KeyError:
            new = set(words).difference(known)
            if len(known) + len(new) > WORDS:
                known.clear()
                new = set(words)
            if len(new) > WORDS:  # a text of more different words than are remembered
                return np.array([self.of(w) for w in words], dtype=np.float32)
            for w in new:
                self.table[len(known)] = self.of(w)
                known[w] = len(known)
            return self.table[[known[w] for w in words]]


def features(text: str | None, measures: Measures) -> list[float]:
    """FEATURES of a whole text; all zero for a text without words."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    rows = measures.rows(words)
    _, starts, _, mixed, hidden, capitals, letters, shouted, exclaimed, marks = rows.sum(axis=0, dtype=np.float64).tolist()
    h, y = np.flatnonzero(rows[:, 0] + rows[:, 1] + rows[:, 4]), np.flatnonzero(rows[:, 2])
    spot = near = 0.0
    if len(h):
        spot = float((np.searchsorted(h, h + 50) - np.arange(len(h))).max()) / min(n, 50)
        if len(y):
            right = np.searchsorted(y, h)
            gap = np.minimum(np.abs(y[np.minimum(right, len(y) - 1)] - h), np.abs(h - y[np.maximum(right - 1, 0)]))
            near = float((gap <= 5).sum()) / n
    whole = len(h) - starts - hidden
    return [float(np.log1p(n)), whole / n, starts / n, float(np.log1p(len(h))), spot, near, len(y) / n, capitals / max(letters, 1), shouted / n, exclaimed / n, marks / n, mixed / n, hidden / n]


class Toxicity:
    """A fitted scorer: lexicon, exported trees with their weights, and the calibration's steps."""

    def __init__(self, entries: dict[str, float], forest: list, weights: list[float], steps: tuple[np.ndarray, np.ndarray] | None, prior: float):
        self.entries, self.forest, self.weights, self.steps, self.prior = entries, forest, weights, steps, prior
        self.measures: Measures | None = None  # made where texts are scored

    def margin(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-2 * boosted_score(self.forest, self.weights, x)))

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Calibrated probability of label 1 for each text."""
        if not self.forest or not texts:
            return np.full(len(texts), self.prior)
        if self.measures is None:
            self.measures = Measures(self.entries)
        p = self.margin(np.array([features(t, self.measures) for t in texts]))
        return np.clip(np.interp(p, *self.steps) if self.steps else p, 0.0, 1.0)


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = 6000, rounds: int = 20, depth: int = 3) -> Toxicity:
    """Fitted to at most ``rows`` labelled ids outside the held-out fold; a quarter of them only calibrates.

    Where only one label occurs there is nothing to fit, and every text scores that label (0.5 without any).
    """
    sample = written(labelled_sample(documents, labels, label, rows).select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "label").withColumn("fits", F.crc32(F.concat(F.lit("fit"), F.col("doc_id").cast("string")).cast("binary")) % 4 != 0), "labelled")
    share = sample.groupBy("label").count().collect()
    if len(share) < 2:
        return Toxicity({}, [], [], None, float(share[0]["label"]) if share else 0.5)
    entries = lexicon(sample.where("fits"))

    def of(batches):
        measures = Measures(entries)
        for batch in batches:
            x = pa.array([features(t, measures) for t in batch.column("text").to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(batch.column("label").to_pylist(), pa.float64()), batch.column("fits"), x], names=["doc_id", "label", "fits", "x"])

    got = sample.mapInArrow(of, "doc_id long, label double, fits boolean, x array<double>").toPandas()
    got = got.sort_values(["doc_id", "label"]).reset_index(drop=True)  # the same rows in the same order, whatever the partitions
    train = got[got["fits"]]
    spark = documents.sparkSession
    fitted = spark.createDataFrame([(float(y), [float(v) for v in x]) for y, x in zip(train["label"], train["x"], strict=True)], "label double, x array<double>")
    model = GBTClassifier(labelCol="label", featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=7).fit(fitted.select("label", array_to_vector("x").alias("features")).coalesce(2))
    out = Toxicity(entries, [exported(t) for t in model.trees], list(model.treeWeights), None, float(got["label"].mean()))
    rest = got[~got["fits"]]
    if rest["label"].nunique() == 2:
        p = out.margin(np.array(rest["x"].tolist()))
        curve = IsotonicRegression(labelCol="label", featuresCol="p").fit(spark.createDataFrame([(float(a), float(b)) for a, b in zip(p, rest["label"], strict=True)], "p double, label double"))
        out.steps = (np.array(curve.boundaries.toArray()), np.array(curve.predictions.toArray()))
    return out


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = 0.5, **parameters) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``documents``; predicted is 1 if score >= threshold.

    Null and empty texts score as texts without any hit; repeated rows score alike; an empty table gives an empty one.
    """
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return scored(texts, "score", fit(documents, labels, **parameters)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
