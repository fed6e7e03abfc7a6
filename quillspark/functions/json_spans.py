"""Places of the leaves of a JSON text, as JSON pointers with character spans."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANK = re.compile(r"[ \t\n\r]*")
_PLAIN = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null")
SPANS = "array<struct<leaf:string,start:long,stop:long>>"


def leaf_spans(text: str | None) -> list[dict]:
    """leaf (RFC 6901 pointer), start, stop of each string, number and literal; strings without their quotes. Empty if the text is no single JSON value."""
    out: list[dict] = []
    if text is None:
        return out
    skip = lambda at: _BLANK.match(text, at).end()
    # Open containers: closing sign, pointer, next index (None in objects).
    stack: list[list] = []
    at, pointer = skip(0), ""
    try:
        while True:
            sign = text[at]
            if sign in "{[":
                close = "}" if sign == "{" else "]"
                at = skip(at + 1)
                if text[at] == close:
                    at += 1
                else:
                    stack.append([close, pointer, None if sign == "{" else 0])
                    pointer, at = _member(text, at, stack[-1], skip)
                    continue
            elif sign == '"':
                _, end = json.decoder.scanstring(text, at + 1, True)
                out.append({"leaf": pointer, "start": at + 1, "stop": end - 1})
                at = end
            else:
                m = _PLAIN.match(text, at)
                if not m:
                    return []
                out.append({"leaf": pointer, "start": at, "stop": m.end()})
                at = m.end()
            at = skip(at)
            while stack and text[at] == stack[-1][0]:
                stack.pop()
                at = skip(at + 1)
            if not stack:
                return out if at == len(text) else []
            if text[at] != ",":
                return []
            pointer, at = _member(text, skip(at + 1), stack[-1], skip)
    except (IndexError, ValueError):
        return []


def _member(text: str, at: int, container: list, skip) -> tuple[str, int]:
    """Pointer of a container's next member, and where its value begins."""
    if container[2] is not None:
        container[2] += 1
        return f"{container[1]}/{container[2] - 1}", at
    if text[at] != '"':
        raise ValueError
    name, at = json.decoder.scanstring(text, at + 1, True)
    at = skip(at)
    if text[at] != ":":
        raise ValueError
    return f"{container[1]}/{name.replace('~', '~0').replace('/', '~1')}", skip(at + 1)


def spans(text: Column) -> Column:
    """``leaf_spans`` of a column, in Arrow batches; exploded, they join token spans (``confidence.widest_overlap``)."""

    @F.pandas_udf(SPANS)
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(leaf_spans)

    return of(text)


LOGPROBS = "array<struct<leaf:string,logprob:double>>"


def leaf_logprobs(text: str | None, offset: int | None, sizes: Sequence[int], logprobs: Sequence[float]) -> list[dict]:
    """leaf, logprob: each leaf of a JSON text with the mean of the log-probabilities of its tokens, null without any.

    ``sizes`` are the lengths of consecutive tokens, in whose text ``text`` begins at ``offset``. A token, clipped to the text,
    counts for the leaf that it shares most characters with, of several the first. A pointer that occurs twice has its last
    place. Empty without an offset, or if no leaf has a token.
    """
    spans_ = {s["leaf"]: (s["start"], s["stop"]) for s in leaf_spans(text)} if offset is not None else {}
    leaves = sorted((start, stop, rank, leaf) for rank, (leaf, (start, stop)) in enumerate(spans_.items()) if stop > start)
    found: dict[str, list[float]] = {}
    first, end = 0, -(offset or 0)
    for size, logprob in zip(sizes, logprobs, strict=True):
        begin, end = max(0, end), end + size
        stop = min(len(text or ""), end)
        while first < len(leaves) and leaves[first][1] <= begin:
            first += 1
        best, most, k = None, (0, 0), first
        while k < len(leaves) and leaves[k][0] < stop:
            shared = (min(stop, leaves[k][1]) - max(begin, leaves[k][0]), -leaves[k][2])
            if shared[0] > 0 and shared > most:
                best, most = leaves[k][3], shared
            k += 1
        if best is not None:
            found.setdefault(best, []).append(logprob)
    return [{"leaf": leaf, "logprob": sum(found[leaf]) / len(found[leaf]) if leaf in found else None} for leaf in spans_] if found else []


def logprobs(text: Column, offset: Column, sizes: Column, values: Column) -> Column:
    """``leaf_logprobs`` of columns, in Arrow batches."""

    @F.pandas_udf(LOGPROBS)
    def of(texts: pd.Series, offsets: pd.Series, sizes: pd.Series, values: pd.Series) -> pd.Series:
        rows = zip(texts, offsets, sizes, values, strict=True)
        return pd.Series([leaf_logprobs(t, None if o is None or pd.isna(o) else int(o), s, v) for t, o, s, v in rows], dtype=object)

    return of(text, offset, sizes, values)
