"""All registered queries of the engine's own operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillspark.plans import answers, checked, coverage, duplicates, identities, linked, records, reported, scanned, stored, streams, summaries, validation

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for _module in (coverage, summaries, identities, duplicates, validation, records, linked, checked, reported, streams, answers, stored, scanned):
    QUERIES.update(_module.QUERIES)
    ORACLE_SQL.update(_module.ORACLE_SQL)
