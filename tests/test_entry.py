"""Driver contract: entry(), queries() and oracle_sql(), plus oracle agreement at sf0.001."""

import re

import duckdb
import pytest

import __spark_entry__ as E
from revlens.sources.tables import TABLES

from .conftest import SF0001


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["sentiment", "word", "n", "rank"]


def test_oracles_subset_of_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 70 and len(o) >= 55


def _norm(v):
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    return v


def _own_oracles():
    """Every oracle query of the library itself; the corpus operators have tests of their own."""
    return sorted(n for n in E.oracle_sql() if not re.match(r"op\d+_|pipeline", n))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", _own_oracles())
def test_oracle_agreement_sf0001(spark, con, name):
    sdf = E.queries()[name](spark, SF0001)
    cols = sdf.columns
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    order = sorted(cols)
    a = sorted((tuple(_norm(r[c]) for c in order) for r in sdf.collect()), key=repr)
    b = sorted((tuple(_norm(dict(zip(ocols, r))[c]) for c in order) for r in cur.fetchall()), key=repr)
    assert a == b


def test_queries_load_without_the_jars(tmp_path):
    """Registration reads no file of the Spark install."""
    import subprocess
    import sys

    code = (
        "import builtins, zipfile, glob; glob.glob = lambda *a, **k: []; zipfile.ZipFile = None\n"
        "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    )
    repo = E.__file__.rsplit("/", 1)[0]
    said = subprocess.run([sys.executable, "-c", code], cwd=repo, capture_output=True, text=True, check=True)
    assert int(said.stdout.split()[0]) >= 81 and int(said.stdout.split()[1]) >= 61
