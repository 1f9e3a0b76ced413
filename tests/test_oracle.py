"""Every registered query with SQL equals its DuckDB oracle (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import canon

SQLS = E.oracle_sql()
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def _rows(rows, cols):
    order = sorted(cols)
    idx = [cols.index(c) for c in order]
    return sorted("|".join(canon(r[i]) for i in idx) for r in rows)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, con, sf_small, name):
    df = E.queries()[name](spark, sf_small)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQLS[name])
    assert sorted(df.columns) == sorted(rel.columns)
    d_rows = rel.fetchall()
    assert _rows(s_rows, df.columns) == _rows(d_rows, rel.columns)


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "label" in df.columns and "slot" in df.columns


def test_entry_in_fresh_interpreter():
    """The driver may call entry() first, in a new process."""
    import subprocess
    import sys
    code = ("import sys; sys.path.insert(0, '.'); from pyspark.sql import SparkSession; "
            "s = SparkSession.builder.master('local[2]').getOrCreate(); "
            "import __spark_entry__ as E; print('ROWS', E.entry(s).count())")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600,
                         cwd=__import__("os").path.dirname(__import__("os").path.dirname(__file__)))
    assert "ROWS" in out.stdout, out.stderr[-2000:]
    assert int(out.stdout.split("ROWS")[1].split()[0]) > 0
