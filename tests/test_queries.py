"""Every registered document query against its SQL at the smallest scale."""

import math
import os

import duckdb
import pytest

from foliospark.plans import matrix

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(x):
    if hasattr(x, "tolist"):
        x = x.tolist()
    if x is None or str(x) in ("<NA>", "nan", "NaT"):
        return None
    return int(x) if isinstance(x, float) and math.isfinite(x) and x == int(x) else x


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted(repr(tuple(map(plain, r))) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(matrix.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    assert rows(matrix.queries()[name](spark, DATA).toPandas()) == rows(con.sql(matrix.oracle_sql()[name]).df())


def test_rows_only_queries(spark):
    for name in set(matrix.queries()) - set(matrix.oracle_sql()):
        assert matrix.queries()[name](spark, DATA).count() > 0
