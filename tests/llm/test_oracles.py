"""The queries of this subpackage against their SQL on the sample tables."""

import os
from pathlib import Path

import duckdb
import pytest

from tests.test_oracle import canonical
from veritable.llm.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="sample tables not present")
@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    expected = con.execute(ORACLES[key])
    names = [d[0] for d in expected.description]
    df = QUERIES[key](spark, SF_DIR)
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(names, expected.fetchall())
