"""Every registered query against its SQL on the sample tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from gallery.features import feature_oracles, feature_queries
from gallery.oracle import all_oracles
from gallery.queries import all_queries
from tests.helpers import plan

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="sample tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = []
    for row in rows:
        values = [row[i] for i in order]
        out.append(tuple(repr(float(x)) if isinstance(x, float) else repr(x) for x in values))
        assert not any(isinstance(x, float) and math.isnan(x) for x in values)
    return sorted(out)


def registered():
    return all_queries() | feature_queries()


def test_every_query_has_an_oracle():
    assert set(registered()) == set(all_oracles() | feature_oracles())
    assert set(registered()) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", sorted(registered()))
def test_query_matches_sql(spark, duck, key):
    df = queries()[key](spark, SF_DIR)
    expected = duck.execute(oracle_sql()[key])
    names = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(names)
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas"):
        assert unwanted not in plan(df)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(names, expected.fetchall())


def test_entry(spark):
    assert entry(spark).count() == 8
