"""The registered queries and the pipeline on the smallest tables."""

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from skumill.llm import queries
from skumill.llm.neardup import near_duplicates
from skumill.llm.decontam import contamination

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_kdtree_topk", "op4_decontaminate", "op10_warc"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.queries()[name](spark, SF)
    want = con.sql(queries.oracle_sql()[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert sorted(map(repr, map(tuple, got.select(*cols).collect()))) == sorted(map(repr, want.select(*cols).fetchall()))


def test_every_operator_has_its_query():
    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts, first = docs.columns, [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    assert near_duplicates(docs).where("not kept").count() == 0
    assert contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").count() == 0
    out = corpus_pipeline.run(spark, SF)
    assert out.count() == counts[-1] and out.join(first, "doc_id").count() == counts[-1]


def test_pipeline_stages_on_odd_rows(spark):
    odd = [(None, "no id at all, but words enough to be a text.", "en", None), (1, None, None, "s"), (2, "", "en", "s"), (2, "", "en", "s"), (3, "w " * 100_000, "en", "s"), (4, "same five words and one more", None, None), (5, "same five words and one more", "de", "x")]
    docs = spark.createDataFrame([(*r, 0, 1, "k", [1]) for r in odd], "doc_id long, text string, lang string, source string, n_chars int, cluster int, __extra string, size array<int>")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() <= docs.count(), name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    kept = corpus_pipeline.near_duplicate(spark, docs, SF)
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.where("doc_id is not null").collect()) == [(False, k) for k in (1, 2, 2, 3, 4)]
    assert corpus_pipeline.decontamination(spark, docs, SF).count() == len(odd)
    last = corpus_pipeline.bpe(spark, docs, SF)
    assert last.count() == len(odd) and last.where("n_tokens = 0").count() == 3
    assert corpus_pipeline.bpe(spark, docs.limit(0), SF).count() == 0
