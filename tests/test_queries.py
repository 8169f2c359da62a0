"""Every query with SQL against DuckDB on the smallest tables, and the package's borders."""

import json
import math
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from ledgerloom import queries as core

DATA = Path("/root/testdata/sf0.001")
ROOT = Path(__file__).resolve().parent.parent


def value(x):
    if x is None or isinstance(x, float) and math.isnan(x) or type(x).__name__ in ("NAType", "NaTType"):
        return None
    x = x.item() if hasattr(x, "item") else x
    return int(x) if isinstance(x, float) and x == int(x) else x


def canonical(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted((tuple(map(value, r)) for r in pdf.itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_sql(spark, duck, name):
    got = core.queries()[name](spark, str(DATA)).toPandas()
    want = duck.execute(core.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_every_registry_is_conformed(spark, tmp_path):
    records = {
        "15057023": [{"CMPNY_NM": "가나", "TELNO": "031-1"}, {"CMPNY_NM": "다라", "EMPLY_CNT": 7}],
        "15065485": [{"ncrGsKname": "마바", "ncrGsMaster": "김"}],
        "15086381": [{"기업명": "사아", "인력": 12}],
        "no rules": [{"기업명": "자차"}],
    }
    flat = [(s, json.dumps(r)) for s, rs in records.items() for r in rs]
    raw = spark.createDataFrame([(i, s, 1, text) for i, (s, text) in enumerate(flat)], "rec_id bigint, source_dataset_id string, file_seq int, payload string")
    raw.write.parquet(str(tmp_path / "raw_records.parquet"))
    got = core.queries()["conform_raw"](spark, str(tmp_path)).select("source_dataset_id", "company_name", "employees")
    assert sorted(map(tuple, got.collect()), key=repr) == [("15057023", "가나", None), ("15057023", "다라", 7.0), ("15065485", "마바", None), ("15086381", "사아", 12.0)]
    raw.limit(0).write.mode("overwrite").parquet(str(tmp_path / "raw_records.parquet"))
    assert core.queries()["conform_raw"](spark, str(tmp_path)).count() == 0


def test_core_without_optional_package():
    code = "import sys; sys.modules['ledgerloom.llm'] = None; import __spark_entry__ as e; assert e.llm is None; assert 'p1_found' in e.queries() and 'p3_found' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_nothing_imports_the_optional_package():
    for path in (ROOT / "ledgerloom").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path
