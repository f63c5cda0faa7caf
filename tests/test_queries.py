"""Every registered query of the core runs on the smallest tables; those with SQL must agree with it."""

from __future__ import annotations

import math
import os

import pytest

from tierlens import queries, site_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(FOLDER):
        c.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{FOLDER}/{f}')")
    return c


def _norm(rows):
    return sorted((tuple(None if isinstance(v, float) and math.isnan(v) else str(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("Q, name", [(q, n) for q in (queries, site_queries) for n in q.queries()])
def test_query(spark, duck, Q, name):
    df = Q.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = _norm(map(tuple, df.select(*cols).collect()))
    if name in Q.oracles():
        cur = duck.execute(Q.oracles()[name])
        names = [d[0] for d in cur.description]
        want = _norm(tuple(r[names.index(c)] for c in cols) for r in cur.fetchall())
        assert sorted(names) == cols and got == want


def test_the_library_stands_without_the_corpus_package():
    import subprocess
    import sys

    code = "import sys; sys.modules['tierlens.llm'] = None; import __spark_entry__ as e; assert 'p1_found' not in e.queries() and 'hosts' in e.queries()"
    assert subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__)))).returncode == 0
