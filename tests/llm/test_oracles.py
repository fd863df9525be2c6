"""The queries with SQL twins against them, on the small tables."""

from pathlib import Path

import duckdb
import pytest

from punctual.llm import registry

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{DATA}/documents.parquet')")
    df = registry.QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({registry.ORACLES[name]})").fetchall()
    got = [tuple(r) for r in df.select(*columns).collect()]
    near = lambda rows: sorted(tuple(float(f"{v:.10g}") if isinstance(v, float) else v for v in r) for r in rows)
    assert near(got) == near(want)
