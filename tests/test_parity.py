"""Every query of the library that SQL can express gives DuckDB's rows; the others give rows."""

import math
import os

import duckdb
import pytest

from cairnwork.plans.catalogue import QUERIES, SQL

SF = os.environ.get("PARITY_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    if name not in SQL:
        assert names
        return
    out = duck.execute(SQL[name])
    order = sorted(range(len(out.description)), key=lambda i: out.description[i][0])
    assert names == [out.description[i][0] for i in order]
    want = sorted((tuple(plain(r[i]) for i in order) for r in out.fetchall()), key=repr)
    assert len(got) == len(want)
    assert got == want
