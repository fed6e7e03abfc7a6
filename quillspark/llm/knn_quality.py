"""Quality by nearest-neighbour voting in a latent-semantic space.

A document's terms are its words, hashed to ``WORDS`` numbers, and trigrams of its character classes (layout, case, digits,
symbols) with a few counts of word repetition. Either kind is tf-idf weighted (square-rooted relative frequencies, inverse
document frequencies of the sample) and of length one before the two are joined, and a truncated SVD of a bounded sample of
labelled documents projects them on its leading directions. The sample's vectors are broadcast, every document's cosine to
each of them is computed exactly, in blocks, and its nearest neighbours vote with their similarity as weight.
"""

from __future__ import annotations

import zlib
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import held_out, labelled_sample, scored

#: Character classes: 0 other, 1 blank, 2 line end, 3 a-z, 4 A-Z, 5 digit, 6 non-ASCII, 7 .,;: 8 !? 9 | 10 symbols, 11 quotes and brackets
_CLASS = np.zeros(256, dtype=np.int32)
for _k, _chars in ((1, b" \t"), (2, b"\n\r\x0b\x0c"), (3, bytes(range(97, 123))), (4, bytes(range(65, 91))), (5, b"0123456789"), (6, bytes(range(128, 256))), (7, b".,;:"), (8, b"!?"), (9, b"|"), (10, b"#$%&*+=<>@^_~\\/"), (11, b"\"'()[]{}`-")):
    _CLASS[list(_chars)] = _k
CLASSES = 12
#: Terms of characters come first, then those of words.
CHARACTERS, WORDS = CLASSES**3 + 3, 1 << 13
TERMS = CHARACTERS + WORDS


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Numbers and weights of the terms of a text; None if it has no words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return None
    c = _CLASS[np.frombuffer(b"\n " + raw + b"\n", dtype=np.uint8)]
    counts = np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CHARACTERS).astype(np.float64)
    counts /= len(c) - 2
    n = len(words)
    counts[-3] = sum(map(eq, words, words[1:])) / n  # a word said twice in a row
    counts[-2] = sum(map(eq, words, words[2:])) / n
    counts[-1] = max(0.0, 1 - len(set(words)) / n - 0.3)  # few different words
    said = Counter(raw.lower().split())
    number = np.fromiter(map(zlib.crc32, said), np.int64, len(said)) & (WORDS - 1)
    counts = np.concatenate([counts, np.bincount(number, weights=np.fromiter(said.values(), float, len(said)), minlength=WORDS) / n])
    at = np.flatnonzero(counts)
    return at, np.sqrt(counts[at])


class LatentVotes:
    """Latent-semantic vectors of labelled documents; the votes of the nearest ones score a document."""

    def __init__(self, sample: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, dims: int, neighbours: int, power: float):
        seen = np.bincount(np.concatenate([at for at, _ in sample]), minlength=TERMS) if sample else np.zeros(TERMS)
        self.idf = (np.log((1 + len(sample)) / (1 + seen)) + 1).astype(np.float32)
        x = np.zeros((len(sample), TERMS), dtype=np.float32)
        for row, (at, weight) in zip(x, sample, strict=True):
            row[at] = self.weighted(at, weight)
        self.directions = self.leading(x, min(dims, len(x)))
        self.labels, self.neighbours, self.power = labels.astype(np.float32), min(neighbours, len(x)), power
        self.prior = float(labels.mean()) if len(labels) else 0.5
        self.vectors = self.projected(sample)

    def weighted(self, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Weights with idf, characters' and words' each of length one."""
        out = weight.astype(np.float32) * self.idf[at]
        words = np.searchsorted(at, CHARACTERS)
        for part in (out[:words], out[words:]):
            part /= np.sqrt(part @ part) + 1e-12
        return out

    @staticmethod
    def leading(x: np.ndarray, dims: int, rounds: int = 4, spare: int = 16) -> np.ndarray:
        """Leading right singular vectors of ``x`` as columns, by subspace iteration."""
        if not dims:
            return np.zeros((x.shape[1], 0), dtype=np.float32)
        q = np.random.default_rng(1).standard_normal((x.shape[1], min(dims + spare, len(x)))).astype(np.float32)
        for _ in range(rounds):
            q = np.linalg.qr(x.T @ (x @ q))[0]
        return np.ascontiguousarray(q @ np.linalg.svd(x @ q, full_matrices=False)[2].T[:, :dims])

    def projected(self, documents: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        out = np.zeros((len(documents), self.directions.shape[1]), dtype=np.float32)
        for row, (at, weight) in zip(out, documents, strict=True):
            row[:] = self.weighted(at, weight) @ self.directions[at]
        return out / (np.linalg.norm(out, axis=1, keepdims=True) + 1e-12)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Score per text, 0 to 1; without words or labelled neighbours, the sample's share of label 1."""
        out = np.full(len(texts), self.prior)
        if not self.neighbours:
            return out
        # A block of texts at a time, so that their terms never stand in memory for a whole batch.
        for a in range(0, len(texts), 256):
            documents = [terms(t) for t in texts[a : a + 256]]
            some = np.array([k for k, d in enumerate(documents) if d is not None], dtype=np.int64)
            if not len(some):
                continue
            cosine = self.projected([documents[k] for k in some]) @ self.vectors.T
            near = np.argpartition(-cosine, self.neighbours - 1, axis=1)[:, : self.neighbours]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-6).astype(np.float64) ** self.power
            out[a + some] = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", rows: int = 3000, dims: int = 48, neighbours: int = 15, power: float = 4.0) -> LatentVotes:
    """Fitted to at most ``rows`` labelled texts outside the held-out fold (see ``labelled_sample``), which are read whole.

    Only the terms of the sample reach the driver, a few KB a document whatever its length.
    """

    def of(batches):
        for batch in batches:
            kept = [(i, y, *t) for i, y, t in zip(batch.column("doc_id").to_pylist(), batch.column("label").to_pylist(), map(terms, batch.column("text").to_pylist()), strict=True) if t]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in kept], pa.int64()), pa.array([k[1] for k in kept], pa.int32()), pa.array([k[2].astype("<u2").tobytes() for k in kept], pa.binary()), pa.array([k[3].astype("<f4").tobytes() for k in kept], pa.binary())],
                names=["doc_id", "label", "at", "weight"],
            )

    got = labelled_sample(documents, labels, label, rows).select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "label")
    got = got.mapInArrow(of, "doc_id long, label int, at binary, weight binary").toPandas().sort_values(["doc_id", "at", "weight"])
    sample = [(np.frombuffer(a, "<u2"), np.frombuffer(w, "<f4")) for a, w in zip(got["at"], got["weight"], strict=True)]
    return LatentVotes(sample, got["label"].to_numpy(float), dims, neighbours, power)


def quality(documents: DataFrame, labels: DataFrame, threshold: float = 0.3, **parameters) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``documents``; predicted is 1 if score >= threshold.

    A text that is null or has no words scores the sample's share of label 1 (0.5 if the sample is empty); texts of any
    length are read whole; repeated rows score alike; an empty table gives an empty one; labels other than 0 and 1 do not
    count, and further columns are ignored.
    """
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return scored(texts, "score", fit(documents, labels, **parameters)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
