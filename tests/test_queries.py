"""Every registered query against its SQL, and the properties the driver relies on."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from tablehouse.oracle import oracle_texts
from tablehouse.queries import all_queries

SQLS = oracle_texts()
QUERIES = all_queries()


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQLS])
def test_same_as_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), SQLS[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQLS)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "player1_same_rate" in df.columns


def test_sql_only_for_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_row_order_does_not_matter(spark, sf_dir):
    from tablehouse.fixtures import Fixtures
    from tablehouse.plans import risk

    fx = Fixtures(spark, sf_dir)
    result, user = fx.result, fx.user
    a = risk.collusion_pairs(result, user)
    b = risk.collusion_pairs(result.orderBy("gameresult"), user.repartition(7, "preloginip"))
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()
