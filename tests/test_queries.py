"""Every query of the library against its SQL on the small tables."""

import os

import duckdb
import pytest

from seqloom import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 8)
    return tuple(plain(x) for x in v) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    got = sorted(repr(plain(tuple(r))) for r in df.select(*names).collect())
    if name not in plans.ORACLES:
        assert got
        return
    rel = duck.sql(plans.ORACLES[name])
    assert sorted(rel.columns) == names
    assert got == sorted(repr(plain(r)) for r in rel.select(*(f'"{c}"' for c in names)).fetchall())


def test_region_ids_of_all_rows(spark, duck):
    n = duck.sql("select count(*) from (select distinct l_orderkey, l_returnflag, l_linestatus from lineitem)").fetchall()[0][0]
    got = plans.QUERIES["region_ids"](spark, SF)
    assert got.count() == got.select("l_orderkey", "chr", "strand").distinct().count() == n


def test_entry(spark):
    import __spark_entry__

    assert set(plans.QUERIES) <= set(__spark_entry__.queries()) and set(plans.ORACLES) <= set(__spark_entry__.oracle_sql())
    assert __spark_entry__.entry(spark).limit(1).count() == 1
