"""Repeated vectors, and the queries of the latest operators on the given tables."""

import duckdb
import pytest

import __spark_entry__
from skumill.llm import queries
from skumill.llm.kdsearch import top_k
from tests.llm.test_fim_simhash import simple

SF = "/root/testdata/sf0.001"


def test_equal_rows_fill_a_rank_each(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0])] + [(1, [5.0, 0.0])] * 3 + [(2, [4.0, 0.0])] * 9 + [(3, [9.0, 1.0]), (100, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for shard_rows in (4, 1000):
        got = sorted((r.query_id, r["rank"], r.vec_id) for r in top_k(df, shard_rows=shard_rows).collect())
        assert got == [(0, 1, 3), (0, 2, 1), (0, 3, 1), (0, 4, 1), (0, 5, 2)] + [(100, 1, 3), (100, 2, 0), (100, 3, 0), (100, 4, 1), (100, 5, 1)]


@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_fill_in_middle"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.queries()[name](spark, SF), con.sql(queries.oracle_sql()[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert sorted(map(repr, map(tuple, got.select(*cols).collect()))) == sorted(map(repr, want.select(*cols).fetchall()))


def test_simhash_of_the_given_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fp = {d: simple(t) for d, t in docs.items()}
    lead = dict.fromkeys(docs)
    for d in sorted(docs):  # flood from the smallest id on
        if lead[d] is None:
            lead[d], todo = d, [d]
            while todo:
                a = todo.pop()
                for b in docs:
                    if lead[b] is None and (fp[a] ^ fp[b]).bit_count() <= 3:
                        lead[b] = d
                        todo.append(b)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op13_simhash_neardup(spark, SF).collect()}
    assert got == {d: (f"{fp[d]:016x}", lead[d]) for d in docs}
    assert any(lead[d] != d for d in docs)


def test_the_latest_operators_are_registered():
    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))


def test_many_equal_rows_get_gapless_slots(spark, monkeypatch):
    from skumill.llm import sharding

    monkeypatch.setattr(sharding, "RUN", 100)
    df = spark.range(20_000).selectExpr("7L AS doc_id", "'same' AS text").unionByName(spark.range(500).selectExpr("cast(NULL AS bigint) AS doc_id", "cast(id AS string) AS text"))
    got = sharding.shard_table(df).collect()
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert len(got) == 20_500 and all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert len({r.shard for r in got if r.doc_id == 7}) == 1
