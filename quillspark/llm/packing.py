"""Packing of tokenised documents into fixed-length sequences: first-fit decreasing in randomised groups of documents.

A document's full-length chunks are sequences of their own; only what is left of each document is packed. The groups are
drawn by a hash of a document's id, ids' checksum and place in its partition, so each is a random sample of about ``group``
documents whatever the table's order, null or repeated ids, and each is packed alone: first-fit decreasing, where a tournament tree over the bins' free space finds the first bin that a
piece fits into in logarithmic time.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import slices, written

#: Entries of a worker's memory of encoded words; emptied when full (about 150 MB).
REMEMBERED = 500_000

# Letters that composition, lower-casing and the word pattern treat alike wherever they stand: ASCII and U+00C0 to U+017F
# without the two signs and the dotted capital I; then ASCII punctuation but the apostrophe.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ž]*)([!-&(-/:-@\[-`{-~]*)", re.ASCII)


@functools.cache
def _tokenizer(path: str):
    """The tokenizer of a file, loaded once a worker: a load a task would leave some MB behind each time."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def word_encoder(path: str) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian unsigned 32-bit integers, for word-end BPE tokenizers.

    Such a tokenizer never joins over white space, so words are encoded one by one and remembered. Plain words go straight
    to the model; any other goes through the whole tokenizer, which knows added tokens ('<|endoftext|>') in a text.
    """
    tokenizer = _tokenizer(path)
    model = tokenizer.model
    # Byte-level alphabets show printable bytes as themselves and the others from U+0100 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    alphabet = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    known: dict[str, bytes] = {}

    def ids(word: str) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if plain is None:
            found = tokenizer.encode(word, add_special_tokens=False).ids
        else:
            found = []
            for part in plain.groups():
                if part:
                    part = part.lower()
                    found += [t.id for t in model.tokenize(part if part.isascii() else part.encode().decode("latin-1").translate(alphabet))]
        return np.array(found, dtype="<u4").tobytes()

    def encode(text: str) -> bytes:
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white space to Python only
            return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        words = text.split()
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for w in set(words).difference(known):
                known[w] = ids(w)
            return b"".join([known[w] for w in words])

    return encode


def tokenised(documents: DataFrame, tokenizer_path: str, length: int, end_id: int) -> DataFrame:
    """doc_id, doc_tokens, crcs, place: per row the number of ids with the end id, the CRC-32 of each cut of ``length`` ids, and its place in the partition."""

    def of(batches):
        encode = word_encoder(tokenizer_path)
        end = np.array([end_id], dtype="<u4").tobytes()
        at = 0
        for batch in slices(batches):
            n, crcs = [], []
            for text in batch.column("text").to_pylist():
                ids = encode(text or "") + end
                n.append(len(ids) // 4)
                crcs.append([zlib.crc32(ids[a : a + 4 * length]) for a in range(0, len(ids), 4 * length)])
            place = pa.array(np.arange(at, at + len(n), dtype=np.int64))
            at += len(n)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), place], names=["doc_id", "doc_tokens", "crcs", "place"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(of, "doc_id long, doc_tokens long, crcs array<long>, place long")


def first_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, in the order given, each put into the first bin with room.

    ``tree`` is a tournament over the bins: each inner node holds the most free space below it.
    """
    leaves = 1 << max(len(sizes) - 1, 0).bit_length()
    tree = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    for k, size in enumerate(sizes.tolist()):
        at = 1
        while at < leaves:
            at *= 2
            if tree[at] < size:
                at += 1
        bins[k], offsets[k] = at - leaves, capacity - tree[at]
        tree[at] -= size
        at //= 2
        while at:
            best = max(tree[2 * at], tree[2 * at + 1])
            if tree[at] == best:
                break
            tree[at] = best
            at //= 2
    return bins, offsets


def pack(documents: DataFrame, tokenizer_path: str, length: int = 4096, end_id: int = 2, group: int = 2048) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length: one row per piece.

    Null and empty texts are one piece, the end id. Rows with a null doc_id are packed too. Repeated rows are packed as
    often as they occur; an empty table gives an empty one. ``padded_length`` is ``length``, or the sequence's own number
    of ids where that is a power of two. Sequence ids are unique and differ between groups, not gapless.
    """
    held = written(tokenised(documents, tokenizer_path, length, end_id), "tokenised")
    groups = max(1, -(-held.count() // group))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        first = int(rows["group"].iloc[0]) << 32
        rows = rows.sort_values(["none", "doc_id", "doc_tokens", "place"]).reset_index(drop=True)
        n = rows["doc_tokens"].to_numpy(np.int64)
        full, rest = n // length, n % length
        # Whole chunks first, a sequence each; then the rests, longest first, ties by doc_id.
        doc = np.repeat(np.arange(len(n)), full)
        chunk = np.arange(len(doc)) - np.repeat(np.cumsum(full) - full, full)
        ids = rows["doc_id"].astype("Int64").mask(rows["none"])
        order = np.argsort(-rest, kind="stable")
        order = order[rest[order] > 0]
        bins, offsets = first_fit(rest[order], length)
        filled = np.zeros(len(doc) + (int(bins.max()) + 1 if len(bins) else 0), dtype=np.int64)
        sequence = np.concatenate([np.arange(len(doc)), len(doc) + bins])
        doc = np.concatenate([doc, order])
        start = np.concatenate([chunk * length, full[order] * length])
        size = np.minimum(length, n[doc] - start)
        np.add.at(filled, sequence, size)
        crcs = rows["crcs"].to_numpy()
        used = filled[sequence]
        return pd.DataFrame({
            "doc_id": ids.iloc[doc].reset_index(drop=True), "start": start, "length": size,
            "ids_crc32": np.array([crcs[d][s // length] for d, s in zip(doc.tolist(), start.tolist(), strict=True)], dtype=np.int64),
            "doc_tokens": n[doc], "sequence_id": first + sequence, "offset": np.concatenate([np.zeros(len(chunk), dtype=np.int64), offsets]),
            "padded_length": np.where((used & (used - 1)) == 0, used, length),
        })

    # pandas would make floats of ids among nulls.
    drawn = held.withColumns({"none": F.isnull("doc_id"), "doc_id": F.coalesce("doc_id", F.lit(0))})
    drawn = drawn.withColumn("group", F.pmod(F.xxhash64("doc_id", "doc_tokens", F.col("crcs")[0], "place"), F.lit(groups)))
    return drawn.groupBy("group").applyInPandas(
        place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_length long"
    )
