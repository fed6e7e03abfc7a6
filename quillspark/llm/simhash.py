"""SimHash near-duplicates by the generalised pigeonhole principle.

The 64 bits are grouped into parts, correlated bits together, and every fingerprint allots its own threshold to each part
(-1 skips a part) so that the thresholds sum to ``distance - parts + 1``: whoever lies within ``distance`` bits then lies
within the threshold on some part. A dynamic programme over estimated candidate counts makes that allotment; probes that
differ from the fingerprint in up to the threshold's bits of a part are looked up, and the candidates are verified.

Probing is between distinct fingerprints. Buckets of up to ``LIGHT`` fingerprints are probed by an ordinary join, whose
output is at most ``LIGHT`` rows a probe. Larger ones are split again by the bits outside their part: whoever lies within
``distance`` bits agrees on one of ``distance + 1`` groups of these. What stays full then is a group of near copies; it is
cut into blocks, block pairs are compared whole, and of the links found only a spanning forest leaves a task, so such a group
never becomes all its pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import fresh, written
from quillspark.llm.components import components

#: Fingerprints of a bucket that is probed by a join; larger buckets are compared in blocks of BLOCK.
LIGHT, BLOCK = 48, 4096
#: Fingerprints that the parts and the counts of the allotment are estimated from.
SAMPLE = 20_000

_BITS = np.array([1 << i for i in range(64)], dtype=np.uint64)


def fingerprint(text: str | None, size: int = 3) -> int:
    """The 64-bit SimHash of a text; 0 for a text without words."""
    if text is None:
        return 0
    # bytes.lower() and bytes.split() treat ASCII alone: A-Z, and the blanks 0x20 and 0x09 to 0x0D.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - size + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    begins = [0, *ends[: n - 1].tolist()]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], 42) for a, b in zip(begins, (ends[size - 1 :] - 1).tolist(), strict=True)])
    # Big-endian digests: bit 0 of unpackbits is the highest. Blocks bound the unpacked bits of a long text.
    rows = np.frombuffer(hashes, dtype=np.uint8).reshape(n, 8)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 8192):
        ones += np.unpackbits(rows[at : at + 8192], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(documents: DataFrame, *kept: str) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a long) and the long columns ``kept``: one row per row of ``documents``."""

    def of(batches):
        for batch in batches:
            fp = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp, type=pa.int64()), *map(batch.column, kept)], names=["doc_id", "fp", *kept])

    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *kept)
    return texts.mapInArrow(of, "doc_id long, fp long" + "".join(f", {c} long" for c in kept))


def grouped_bits(sample: np.ndarray, parts: int) -> list[np.ndarray]:
    """The 64 bits in ``parts`` groups of equal size, each grown from a free bit by the most correlated bits left."""
    bits = ((sample[:, None] & _BITS[None, :]) != 0).astype(float)
    seen = bits - bits.mean(axis=0) if len(sample) else np.zeros((1, 64))
    norm = np.sqrt((seen**2).sum(axis=0)) + 1e-9
    linked = np.abs(seen.T @ seen) / norm[:, None] / norm[None, :]
    free, groups = list(range(64)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        group = [free.pop(0)]
        while len(group) < size:
            best = max(free, key=lambda b: (linked[b, group].sum(), -b))
            free.remove(best)
            group.append(best)
        groups.append(np.array(sorted(group)))
    return groups


def part_values(fp: np.ndarray, group: np.ndarray) -> np.ndarray:
    out = np.zeros(len(fp), dtype=np.uint64)
    for k, bit in enumerate(group):
        out |= ((fp >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
    return out


class Allotment:
    """Parts and estimates from a sample of ``of`` distinct fingerprints, and the thresholds they give to a fingerprint."""

    def __init__(self, sample: np.ndarray, of: int, distance: int):
        self.distance = distance
        self.scale = max(of, 1) / max(len(sample), 1)
        # As many parts as make probes and candidates fewest, on the sample itself. With one part more than ``distance`` all
        # probes would be exact, but its buckets are soon too full: that count is left out, so that a growing corpus keeps
        # the probes it began with.
        options = []
        for parts in range(1, distance + 1):
            self.use(grouped_bits(sample, parts), sample)
            options.append((self.thresholds(sample[:2000])[1].mean() if len(sample) else parts, parts))
        self.use(grouped_bits(sample, min(options)[1]), sample)

    def use(self, groups: list[np.ndarray], sample: np.ndarray) -> None:
        self.groups = groups
        self.flips = [
            [np.array([sum(1 << b for b in c) for r in range(t + 1) for c in combinations(range(len(g)), r)], dtype=np.uint64) for t in range(self.distance - len(groups) + 2)]
            for g in groups
        ]
        self.seen = [np.unique(part_values(sample, g), return_counts=True) for g in groups]

    def count(self, k: int, values: np.ndarray) -> np.ndarray:
        """Estimated fingerprints with each of these values of part k: the sample's, or the even spread if it has none."""
        known, n = self.seen[k]
        floor = self.scale * max(n.sum(), 1) / 2.0 ** len(self.groups[k])
        if not len(known):
            return np.full(values.shape, floor)
        at = np.minimum(np.searchsorted(known, values), len(known) - 1)
        return np.where(known[at] == values, n[at] * self.scale, floor)

    def thresholds(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Threshold of each part for each fingerprint, -1 for none, and the estimated cost, by dynamic programming."""
        parts, top = len(self.groups), self.distance - len(self.groups) + 1
        best = np.zeros((len(fp), 1))  # columns: the sum of (threshold + 1) over the parts so far
        picks = []
        for k in range(parts):
            value = part_values(fp, self.groups[k])
            cost = [np.zeros(len(fp))]
            for t in range(top + 1):
                flips = self.flips[k][t]
                # The estimate of a wide ball is taken on its own part value and the even spread beyond it.
                own = self.count(k, value)
                cost.append(1.0 * len(flips) + own + (len(flips) - 1) * self.scale * len(self.seen[k][0]) / 2.0 ** len(self.groups[k]))
            width = min(best.shape[1] + top + 1, self.distance + 2)
            new, pick = np.full((len(fp), width), np.inf), np.zeros((len(fp), width), dtype=np.int64)
            for s in range(best.shape[1]):
                for t1, c in enumerate(cost):
                    if s + t1 < width:
                        better = best[:, s] + c < new[:, s + t1]
                        new[better, s + t1] = (best[:, s] + c)[better]
                        pick[better, s + t1] = t1
            best = new
            picks.append(pick)
        left = np.full(len(fp), self.distance + 1)  # the thresholds sum to distance - parts + 1
        out = np.zeros((len(fp), parts), dtype=np.int64)
        rows = np.arange(len(fp))
        for k in reversed(range(parts)):
            out[:, k] = picks[k][rows, left]
            left = left - out[:, k]
        return out - 1, best[:, self.distance + 1]


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest of the links a-b."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        if (p := find(x)) != (q := find(y)):
            root[max(p, q)] = min(p, q)
            kept.append((x, y))
    return kept


def _star_links(a: np.ndarray, b: np.ndarray, near: np.ndarray) -> list[tuple[int, int]]:
    """At most len(a) + len(b) links that join what the links of the matrix ``near`` join, found by spreading labels."""
    none = near.shape[1]
    label = np.where(near.any(axis=1), near.argmax(axis=1), none)
    while True:
        column = np.where(near, label[:, None], none).min(axis=0, initial=none)
        new = np.where(near, column[None, :], none).min(axis=1, initial=none)
        if (new == label).all():
            break
        label = new
    rows, columns = np.flatnonzero(label < none), np.flatnonzero(column < none)
    return [*zip(a[rows].tolist(), b[label[rows]].tolist(), strict=True), *zip(b[columns].tolist(), b[column[columns]].tolist(), strict=True)]


def _hot(index: DataFrame, key: list[str]) -> DataFrame:
    """``key`` and blocks of the buckets with more than LIGHT fingerprints, written."""
    counts = index.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LIGHT)
    return written(counts.select(*key, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "heavy")


def _light(index: DataFrame, probes: DataFrame, hot: DataFrame, key: list[str], distance: int) -> DataFrame:
    """a, b, a < b: links found by probing the buckets that are not hot."""
    light = index.join(hot, key, "left_anti").withColumnRenamed("fp", "b")
    apart = (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    return probes.withColumnRenamed("fp", "a").join(light, key).where(apart).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _compared(index: DataFrame, probes: DataFrame, hot: DataFrame, key: list[str], distance: int) -> DataFrame:
    """a, b, a < b: links that join what the hot buckets link; every block of a bucket's index meets every block of its probes."""

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        a, b = left["fp"].to_numpy(np.int64).view(np.uint64), right["fp"].to_numpy(np.int64).view(np.uint64)
        kept: list[tuple[int, int]] = []
        for at in range(0, len(a), 256):
            near = np.bitwise_count(a[at : at + 256, None] ^ b[None, :]) <= distance
            kept += _star_links(a[at : at + 256].view(np.int64), b.view(np.int64), near)
        kept = _forest(*np.array(kept, dtype=np.int64).reshape(-1, 2).T)
        return pd.DataFrame([(min(p), max(p)) for p in kept], columns=["a", "b"], dtype="int64")

    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    group, sides = [*key, "i", "j"], [f"p_{c}" for c in (*key, "i", "j")]
    by_index = index.join(hot, key).select(*key, "fp", block.alias("i"), others.alias("j"))
    by_probe = probes.join(hot, key).select(*key, "fp", others.alias("i"), block.alias("j")).toDF(*sides[:-2], "fp", *sides[-2:])
    return by_probe.groupBy(*sides).cogroup(by_index.groupBy(*group)).applyInPandas(compare, "a long, b long").where("a != b")


def links(distinct: DataFrame, distance: int = 3) -> DataFrame:
    """a, b, a < b: links between distinct fingerprints (column fp) that join exactly those that ``distance`` bits join.

    Without hot buckets these are all pairs within ``distance`` bits; with some, a star for each component.
    """
    found, hot = _found(distinct, distance)
    return components(found).where("node != root").select(F.col("root").alias("a"), F.col("node").alias("b")) if hot else found


def _found(distinct: DataFrame, distance: int) -> tuple[DataFrame, bool]:
    """a, b, a < b: what probing and blocks find, and whether there are hot buckets. ``distinct`` is read several times."""
    total = distinct.count()
    drawn = distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toPandas()["fp"].to_numpy(dtype=np.int64).view(np.uint64)
    plan = Allotment(drawn, total, distance)

    def keys(batches):
        """probe, part, value, fp: index entries (probe false) and probes of every fingerprint."""
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            allotted = plan.thresholds(fp)[0]
            for k, group in enumerate(plan.groups):
                value = part_values(fp, group)
                for probe, rows, flips in [(False, np.ones(len(fp), dtype=bool), np.zeros(1, dtype=np.uint64))] + [(True, allotted[:, k] == t, f) for t, f in enumerate(plan.flips[k])]:
                    if not rows.any():
                        continue
                    v = (value[rows][:, None] ^ flips[None, :]).ravel().view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(v), probe)), pa.array(np.full(len(v), k, dtype=np.int32)), pa.array(v), pa.array(np.repeat(fp[rows], len(flips)).view(np.int64))],
                        names=["probe", "part", "value", "fp"],
                    )

    entries = written(distinct.select("fp").mapInArrow(keys, "probe boolean, part int, value long, fp long"), "entries")
    index, probes = entries.where("not probe").drop("probe"), entries.where("probe").drop("probe")
    key = ["part", "value"]
    hot = _hot(index, key)
    few = _light(index, probes, hot, key, distance).distinct()
    if hot.isEmpty():
        return few, False

    # The bits outside each part, in distance + 1 groups.
    outside = [np.array_split(np.setdiff1d(np.arange(64), group), distance + 1) for group in plan.groups]

    def again(batches):
        """probe, part, value, sub, inner, fp: a row for each group of the other bits."""
        for batch in batches:
            part, fp = batch.column("part").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)
            for k in np.unique(part):
                rows = np.flatnonzero(part == k)
                taken = batch.take(pa.array(rows))
                for sub, bits in enumerate(outside[k]):
                    inner = part_values(fp[rows], bits).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [taken.column("probe"), taken.column("part"), taken.column("value"), pa.array(np.full(len(rows), sub, dtype=np.int32)), pa.array(inner), taken.column("fp")],
                        names=["probe", "part", "value", "sub", "inner", "fp"],
                    )

    # A probe that meets no index entry of a hot bucket is dropped by the join.
    crowded = entries.join(hot.select(*key), key).select("probe", "part", "value", "fp")
    split = written(crowded.mapInArrow(again, "probe boolean, part int, value long, sub int, inner long, fp long"), "split")
    index, probes = split.where("not probe").drop("probe"), split.where("probe").drop("probe")
    key = ["part", "value", "sub", "inner"]
    full = _hot(index, key)
    found = _light(index, probes, full, key, distance)
    if not full.isEmpty():
        found = found.union(_compared(index, probes, full, key, distance))
    return few.union(found), True


def _classes(distinct: DataFrame, distance: int) -> DataFrame:
    """fp, least, root: ``distinct`` (fp, least) with the smallest fingerprint that each leads to."""
    found = components(_found(distinct, distance)[0])
    return distinct.join(found, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(documents: DataFrame, distance: int = 3) -> DataFrame:
    """doc_id, fingerprint, component_id: one row per row of ``documents``.

    ``component_id`` is the smallest doc_id that fingerprints within ``distance`` bits of each other lead to. Null and blank
    texts have fingerprint zero, linked like any other; rows with a null doc_id are kept and linked too, and only a
    component of such rows alone has a null id. Repeated rows are returned as often as they occur; an empty table gives an
    empty one.
    """
    held = written(fingerprints(documents), "fingerprints")
    distinct = written(held.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    classes = _classes(distinct, distance)
    roots = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    labelled = classes.join(roots, "root").select("fp", "component_id")
    return held.join(labelled, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(documents: DataFrame, distance: int = 3) -> DataFrame:
    """``documents`` without the near-duplicates: one row of each component stays, all columns as they are.

    It is the row of the smallest doc_id (null after all others), of several those whose text hashes lowest; of rows that
    share doc_id and text one stays. An empty table gives an empty one; further columns may have any names.
    """
    # The two hashes of a row's id and text stand for it, so that nulls join and an id of many texts is no one key.
    k1, k2, fp, rank = fresh(documents, "_k1", "_k2", "_fp", "_rank")
    known = [F.col("doc_id").cast("long"), F.col("doc_id").isNull(), F.col("text").cast("string"), F.col("text").isNull()]
    keyed = documents.withColumns({k1: F.xxhash64(*known), k2: F.xxhash64(*reversed(known))})
    held = written(fingerprints(keyed, k1, k2), "fingerprints")
    distinct = written(held.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    choice = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", k1, k2)).alias("row")
    by_print = held.groupBy("fp").agg(choice)
    classes = _classes(distinct, distance).select(F.col("fp").alias(fp), "root")
    kept = by_print.join(classes, F.col("fp") == F.col(fp)).groupBy("root").agg(F.min("row").alias("row")).select(f"row.{k1}", f"row.{k2}")
    # Repeated rows are alike, so any of them stays.
    first = Window.partitionBy(k1, k2).orderBy(k1)
    out = keyed.join(kept, [k1, k2], "left_semi").withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1)
    return out.select(*[F.col(f"`{c}`") for c in documents.columns])
