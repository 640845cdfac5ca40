"""Registered queries against their SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from sparkraster.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_equals_its_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    got = sorted("|".join(plain(r[c]) for c in names) for r in df.collect())
    ref = duck.execute(catalogue.SQL[name])
    at = [[x[0] for x in ref.description].index(c) for c in names]
    assert sorted(x[0] for x in ref.description) == names
    assert got == sorted("|".join(plain(r[i]) for i in at) for r in ref.fetchall())


def test_whole_layers_are_read(spark):
    from sparkraster.sources import fixtures

    cells = fixtures.layers(spark, DATA).count()
    assert catalogue.QUERIES["block_halo_all"](spark, DATA).agg({"own": "sum"}).first()[0] == cells
    assert catalogue.QUERIES["layer_roundtrip_all"](spark, DATA).count() == cells


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["row", "col", "code"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
