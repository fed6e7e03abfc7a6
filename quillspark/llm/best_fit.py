"""Best-two-fit packing of tokenised documents, cut only where one is longer than a sequence.

Documents are dealt into groups drawn at random, and each group is packed alone. A sequence is filled greedily with the
longest piece that still fits. When nothing fits any more, its shortest piece is taken out again, and if two unpacked pieces
fit into the gap so widened more tightly than it did, they take its place. Which lengths are left is kept as the bits of one
whole number, and turned round in a second one: a shift of it laid over the first shows all pairs of a given sum at once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import written
from quillspark.llm.packing import tokenised


def best_two_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of the places in ``sizes`` (each from 1 to ``capacity``); no bin's sizes add up to more than ``capacity``."""
    left: list[list[int]] = [[] for _ in range(capacity + 1)]
    for place in range(len(sizes) - 1, -1, -1):
        left[sizes[place]].append(place)
    there = back = 0  # bit n, and bit capacity - n, where a piece of length n is left
    for n, places in enumerate(left):
        if places:
            there |= 1 << n
            back |= 1 << (capacity - n)

    def take(n: int) -> int:
        nonlocal there, back
        place = left[n].pop()
        if not left[n]:
            there ^= 1 << n
            back ^= 1 << (capacity - n)
        return place

    def pair(least: int, most: int) -> tuple[int, int] | None:
        """The two unpacked lengths of the largest sum from ``least`` to ``most``; of these the most unlike."""
        for total in range(most, least - 1, -1):
            both = there & (back >> (capacity - total)) if total <= capacity else 0
            if both and total % 2 == 0 and both >> (total // 2) & 1 and len(left[total // 2]) < 2:
                both ^= 1 << (total // 2)
            if both:
                n = both.bit_length() - 1
                return n, total - n
        return None

    bins = []
    while there:
        held, gap = [], capacity
        while fitting := there & ((2 << gap) - 1):
            n = fitting.bit_length() - 1
            held.append((n, take(n)))
            gap -= n
        if gap:
            n, place = held[-1]  # pieces come longest first
            if found := pair(n + 1, n + gap):
                held.pop()
                held += [(m, take(m)) for m in found]
                left[n].append(place)
                there |= 1 << n
                back |= 1 << (capacity - n)
        bins.append([place for _, place in held])
    return bins


def pack(documents: DataFrame, tokenizer_path: str, length: int = 2048, end_id: int = 0, group: int = 4096) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.

    Documents of up to ``length`` ids, their end id among them, are one piece; longer ones are cut into pieces of ``length``
    and a last one of what is left, and pieces of ``length`` are sequences of their own. Null and empty texts are one piece,
    the end id. Rows with a null doc_id are packed too; repeated rows are packed as often as they occur; an empty table gives
    an empty one. Sequence ids are unique and differ between groups, not gapless. The groups, of about ``group`` documents,
    are drawn by a hash of id, length, checksum and place in the partition, so that neither order nor repeated ids matter.
    """
    held = written(tokenised(documents, tokenizer_path, length, end_id), "tokenised")
    groups = max(1, -(-held.count() // group))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        first = int(rows["group"].iloc[0]) << 32
        rows = rows.sort_values(["none", "doc_id", "doc_tokens", "place"]).reset_index(drop=True)
        n, crcs = rows["doc_tokens"].to_numpy(np.int64), rows["crcs"].to_numpy()
        pieces = -(-n // length)
        doc = np.repeat(np.arange(len(n)), pieces)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        size = np.minimum(length, n[doc] - piece * length)
        sequence, offset = np.zeros(len(doc), dtype=np.int64), np.zeros(len(doc), dtype=np.int64)
        for k, places in enumerate(best_two_fit(size.tolist(), length)):
            sequence[places] = first + k
            offset[places] = np.cumsum(size[places]) - size[places]
        return pd.DataFrame({
            "doc_id": rows["doc_id"].astype("Int64").mask(rows["none"]).iloc[doc].reset_index(drop=True), "piece": piece.astype(np.int32), "start": piece * length, "length": size,
            "ids_crc32": np.array([crcs[d][p] for d, p in zip(doc.tolist(), piece.tolist(), strict=True)], dtype=np.int64), "sequence_id": sequence, "offset": offset,
        })

    # pandas would make floats of ids among nulls.
    drawn = held.withColumns({"none": F.isnull("doc_id"), "doc_id": F.coalesce("doc_id", F.lit(0))})
    drawn = drawn.withColumn("group", F.pmod(F.xxhash64("doc_id", "doc_tokens", F.col("crcs")[0], "place"), F.lit(groups)))
    return drawn.groupBy("group").applyInPandas(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
