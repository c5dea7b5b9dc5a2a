"""Every query that has a twin in SQL gives the twin's rows."""

import duckdb
import pandas as pd
import pytest

from collatio.plans.catalog import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def rows(frame):
    def plain(v):
        if v is None or v is pd.NA or v != v:
            return "null"
        return repr(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(plain(v) for v in r) for r in frame[sorted(frame.columns)].itertuples(index=False))


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(name, spark, sf_dir, con):
    ours, theirs = QUERIES[name](spark, sf_dir).toPandas(), con.sql(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)
