"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from skumill import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return value


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query_equals_sql(spark, con, name):
    got = queries.queries()[name](spark, SF)
    want = con.sql(queries.oracle_sql()[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    left = sorted(repr(tuple(map(plain, r))) for r in got.select(*cols).collect())
    right = sorted(repr(tuple(map(plain, r))) for r in want.select(*[f'"{c}"' for c in cols]).fetchall())
    assert left == right


def test_every_query_has_sql():
    assert set(queries.queries()) == set(queries.oracle_sql())


def test_plans_join_by_hash_and_prune_columns(spark):
    for name in ("reconcile_first_match", "three_way_match", "size_list_match"):
        plan = queries.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "l_comment" not in plan
    plan = queries.queries()["bid_price"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "Exchange" not in plan
