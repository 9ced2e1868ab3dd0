"""Queries on the given tables against libraries, brute force and held-out labels; very long texts."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skumill.llm import queries, sharding, warc

SF = "/root/testdata/sf0.001"


def texts(spark, sf=SF):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def test_ids_and_texts_are_those_of_the_library(spark):
    own = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    own.no_truncation()
    own.no_padding()
    want = {}
    for doc_id, text in texts(spark).items():
        ids = own.encode(text, add_special_tokens=False).ids
        back = own.decode(ids, skip_special_tokens=False)
        want[doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
    got = queries.op5_bpe_round_trip(spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want and len(got) == len(want)


def test_counts_and_cuts_are_those_of_the_library(spark):
    own = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    own.no_truncation()
    own.no_padding()
    every = texts(spark)
    count = lambda t: len(own.encode(t, add_special_tokens=False).ids)
    got = queries.op6_token_counts(spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got} == {d: (len(t.encode()), n := count(t), n > 512) for d, t in every.items()} and len(got) == len(every)
    cut = [r for r in got if r.over_limit][:20]
    assert cut and all(r.fit_chars == len(every[r.doc_id]) for r in got if not r.over_limit)
    for r in cut:  # no longer prefix, up to a hundred characters more, has so few tokens
        text = every[r.doc_id]
        assert count(text[: r.fit_chars]) <= 512 and all(count(text[:k]) > 512 for k in range(r.fit_chars + 1, min(len(text), r.fit_chars + 100) + 1))


def test_near_duplicates_are_those_of_the_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(queries.OP7_SQL).fetchall()
    got = queries.op7_minhash_neardup(spark, SF).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [(r.score, r.predicted, labels[r.doc_id], r.held_out, r.doc_id) for r in queries.op9_quality(spark, sf).collect() if r.doc_id in labels]
    assert all(held == (zlib.crc32(str(d).encode()) % 3 == 1) for *_, held, d in got)
    held = [g for g in got if g[3]]
    good, bad = [s for s, _, y, *_ in held if y == 1], [s for s, _, y, *_ in held if y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert len(held) > 80 and auc > 0.95 and np.mean([p == y for _, p, y, *_ in held]) > 0.9


def test_very_long_texts_and_pages(spark, tmp_path):
    long = [(1, "wörter " * 700_000), (2, None), (3, "short"), (4, "wörter " * 700_000)]
    docs = spark.createDataFrame(long, "doc_id long, text string")
    got = {r.doc_id: r for r in sharding.shard_table(docs).collect()}
    assert got[1]["size"] == 8 * 700_000 + 16 and got[1].text_crc32 == zlib.crc32(long[0][1].encode()) and len(got) == 4
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://h/").alias("url"), F.col("text").alias("html"))
    read = {r.page_id: r for r in warc.archive_and_read(spark, pages).collect()}
    assert (read[4].record_type, read[1].refers_to, read[1].payload_bytes) == ("response", 4, 8 * 700_000) and read[2].payload_bytes == 0
