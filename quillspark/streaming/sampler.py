"""A sampler that chooses what to validate next, decision by decision, as arbitrary state of a stream."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

FIELDS = "fields array<string>, sizes array<long>"
STATE = f"{FIELDS}, selected array<long>, scored array<long>, sums array<double>"


def best_field(sizes: list[int], selected: list[int], scored: list[int], blend: float, weight: float) -> int | None:
    """The field to ask about next, by ``sampling.ucb_scores``, of those that have items left; None if none has.

    Scores count to nine decimals, ties go to the first field, so that all machines choose alike.
    """
    total, groups, asked = max(1, sum(sizes)), max(1, len(sizes)), sum(selected)
    best, most = None, -math.inf
    for k, size in enumerate(sizes):
        if selected[k] >= size:
            continue
        quota = (1 - blend) / groups + blend * size / total
        unsure = math.sqrt(2 * math.log(max(asked, 2)) / (scored[k] + 1))
        score = round(quota - selected[k] / max(asked, 1) + weight * unsure, 9)
        if score > most:
            best, most = k, score
    return best


def choices(decisions: DataFrame, catalogue: DataFrame, dataset: str, session: str, order: str, score: str, blend: float = 0.5, weight: float = 0.25) -> DataFrame:
    """session, order, field, item, accuracy: what each decision of a stream was about, which follows from those before it.

    ``catalogue`` (the dataset's column, field, size) is a table; a session is about one dataset, and its fields, in their
    order, are part of its state: how often each was chosen, how many of its decisions had a score, and their sum. ``item``
    counts a field's items from 0; ``accuracy`` is the field's smoothed accuracy before the decision. A decision without a
    score counts as a choice only. When all items are through, or the dataset is unknown, field is null. Decisions of a batch
    are taken in the order of ``order``, a session's in one task, since each needs the one before; batches follow each other.
    """
    held = catalogue.groupBy(dataset).agg(F.array_sort(F.collect_list(F.struct("field", F.col("size").cast("long").alias("size")))).alias("_c"))
    held = held.select(dataset, F.transform("_c", lambda c: c["field"]).alias("_fields"), F.transform("_c", lambda c: c["size"]).alias("_sizes"))
    stream = decisions.join(held, dataset, "left").select(session, F.col(order).alias("_order"), F.col(score).cast("double").alias("_score"), "_fields", "_sizes")
    kinds = decisions.schema

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(batches).sort_values("_order", kind="stable")
        if state.exists:
            fields, sizes, selected, scored, sums = map(list, state.get)
        else:
            first = rows.iloc[0]
            fields, sizes = ([], []) if first["_fields"] is None else (list(first["_fields"]), [int(n) for n in first["_sizes"]])
            selected, scored, sums = [0] * len(fields), [0] * len(fields), [0.0] * len(fields)
        out = []
        for place, value in zip(rows["_order"], rows["_score"], strict=True):
            k = best_field(sizes, selected, scored, blend, weight)
            if k is None:
                out.append((key[0], place, None, None, None))
                continue
            out.append((key[0], place, fields[k], selected[k], (sums[k] + 1) / (scored[k] + 2)))
            selected[k] += 1
            if not pd.isna(value):
                scored[k] += 1
                sums[k] += float(value)
        state.update((fields, sizes, selected, scored, sums))
        frame = pd.DataFrame(out, columns=[session, order, "field", "item", "accuracy"])
        yield frame.astype({"item": "Int64"})

    result = f"`{session}` {kinds[session].dataType.simpleString()}, `{order}` {kinds[order].dataType.simpleString()}, field string, item long, accuracy double"
    return stream.groupBy(session).applyInPandasWithState(step, result, STATE, "append", GroupStateTimeout.NoTimeout)
