"""Registered queries against their DuckDB oracle at sf0.001 (the driver
runs the same comparison at sf0.01)."""

import hashlib
import json
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from tessera.plans import QUERIES
from tessera.sources.tables import TABLES

#: Queries of the training-data subpackage are tested in its own folder.
OWN = dict(QUERIES)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def digest(df):
    cols = sorted(df.columns)
    rows = sorted(json.dumps([_norm(r[c]) for c in cols], default=str)
                  for _, r in df[cols].iterrows())
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_declared():
    assert set(OWN) <= set(E.queries()) and set(OWN) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "approx_tokens" in df.columns


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF001).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert digest(got) == digest(want)
