"""Every query of the engine's own operators against its SQL in DuckDB, and the entry points."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from quillspark.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return c


def rows(df):
    df = df[sorted(df.columns)].astype(object)

    def plain(v):
        if pd.isna(v):
            return ""
        if isinstance(v, bool):
            return str(v)
        try:
            return repr(round(float(v), 6) + 0.0) if not isinstance(v, str) and math.isfinite(v) else str(v)
        except TypeError:
            return str(v)

    return list(df.columns), sorted(tuple(map(plain, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_its_sql(spark, small, duck, name):
    got = registry.QUERIES[name](spark, small).toPandas()
    assert rows(got) == rows(duck.execute(registry.ORACLE_SQL[name]).df())


def test_entry(spark, small):
    out = __spark_entry__.entry(spark)
    assert out.columns == ["expected", "covered", "missing", "extra", "ratio"] and out.count() == 1


def test_every_sql_has_its_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_plans_prune_and_push_down(spark, small):
    plan = registry.QUERIES["q01_coverage_report"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan and "ReadSchema: struct<o_orderkey:bigint>" in plan
