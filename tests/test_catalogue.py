"""Every registered query of the engine against its SQL twin, and the driver's entry."""

import duckdb
import pytest
from oracle import connect, difference

from skein.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, con, name):
    df = catalogue.queries()[name](spark, SF)
    assert difference(df, con, catalogue.oracle_sql()[name]) == ""


def _parts(con, folder, *keys):
    con.execute(f"copy (select k::bigint as p_partkey, 'name' as p_name from unnest({list(keys)}) as t(k)) to '{folder}/part.parquet'")
    con.execute(f"create view part as select * from '{folder}/part.parquet'")
    return str(folder)


def test_chunk_order_of_a_file_name_that_begins_another(spark, tmp_path):
    # one number, 9.901: the topic of file 9.901 and the one of file 9.901-54 that is titled so
    own = duckdb.connect()
    df = catalogue.queries()["chunk_order"](spark, _parts(own, tmp_path, 332901, 385742))
    assert difference(df, own, catalogue.oracle_sql()["chunk_order"]) == ""


def test_chunk_order_of_rows_that_its_sql_leaves_open(spark, tmp_path):
    # two topics of one number and file name: the one with lists is listed first, its labels follow both
    df = catalogue.queries()["chunk_order"](spark, _parts(duckdb.connect(), tmp_path, 18974, 71815))
    got = sorted((tuple(r) for r in df.select("rank", "p_partkey", "emit").collect()))
    assert got == [(1, 71815, 0), (2, 18974, 0), (3, 71815, 1), (4, 71815, 2), (5, 71815, 3)]


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
