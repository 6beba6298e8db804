"""Every registered query of the engine against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from seqloom.plans import decisions, details  # noqa: F401
from seqloom.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.sql(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{SF}/{t}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLES:
        assert len(got)
        return
    want = duck.sql(ORACLES[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns) and len(got) == len(want)
    a, b = (x[cols].sort_values(cols).reset_index(drop=True) for x in (got, want))
    for c in cols:
        if a[c].dtype.kind == "f":
            assert ((a[c] - b[c]).abs().fillna(0) < 2e-6).all() and (a[c].isna() == b[c].isna()).all(), c
        else:
            assert a[c].tolist() == b[c].tolist(), c


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["query", "taxid", "rep", "flag"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_without_a_session():
    import subprocess
    import sys

    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    told = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"], cwd=home, capture_output=True, text=True, timeout=120)
    assert told.returncode == 0 and int(told.stdout) >= len(QUERIES), told.stderr[-500:]
