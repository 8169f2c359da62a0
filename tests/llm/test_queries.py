"""Every query of this package that has SQL, against DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from ledgerloom.llm import queries as llm
from tests.test_queries import DATA, canonical


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    got, want = llm.queries()[name](spark, str(DATA)).toPandas(), con.execute(llm.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and canonical(got) == canonical(want)
