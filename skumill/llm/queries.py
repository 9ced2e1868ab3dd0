"""The registered queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .bpe import round_trip_digests
from .chat import canonical_turns
from .common import table
from .decontam import contamination
from .fim import fim_digests
from .html_text import extracted
from .kdsearch import top_k
from .lexsearch import ranked_search
from .neardup import near_duplicates
from .quality import quality_scores
from .sharding import shard_table
from .simhash import simhash_duplicates
from .tokencount import token_counts
from .warc import archive_and_read


def op7_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s FROM words),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
rare AS (SELECT x FROM flat GROUP BY x HAVING count(*) > 1),
inter AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM flat a JOIN rare USING (x) JOIN flat b USING (x)
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, inter.v FROM reach JOIN inter ON reach.r = inter.u)
SELECT d.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.r) AS component_id, d.doc_id = min(r.r) AS kept
FROM documents d JOIN sets s USING (doc_id) JOIN reach r USING (doc_id) GROUP BY d.doc_id, s.s
"""


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), " + _LETTERS + r"), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP4_SQL = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT item_id, least(10, len(w)) AS k, unnest(list_transform(range(1, greatest(1, len(w) - 9) + 1), lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' '))) AS x
  FROM item WHERE len(w) > 0),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
runs AS (
  SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS p, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS x
  FROM doc, (SELECT DISTINCT k FROM win) WHERE len(w) >= k),
found AS (SELECT DISTINCT doc_id, runs.k, p, item_id FROM runs JOIN win ON runs.x = win.x AND runs.k = win.k),
places AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(places.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(places.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_table(table(spark, sf_dir, "documents"))


def op1_chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_turns(table(spark, sf_dir, "conversations"), labels="hidden")


def op2_kdtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


OP2_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_and_read(spark, table(spark, sf_dir, "pages"))


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, sha1(h) AS x FROM p),
e AS (
  SELECT page_id, n, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(x, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS BIGINT) + 1, 1)), '') AS digest FROM d),
f AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS last FROM e)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to FROM f
"""

def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = f"""
WITH doc AS (SELECT doc_id, {_WORDS} AS t FROM documents),
size AS (SELECT doc_id, len(t) AS n FROM doc WHERE len(t) > 0),
total AS (SELECT count(*) AS n_docs, sum(n) AS n_terms FROM size),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM doc) GROUP BY doc_id, term),
weight AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, n_docs),
item AS (SELECT item_id, unnest({_WORDS}) AS term FROM benchmark),
score AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // CAST(n_terms AS BIGINT))))) AS BIGINT) AS score
  FROM item JOIN tf USING (term) JOIN weight USING (term) JOIN size USING (doc_id), total GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM score WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_digests(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS x FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS plain,
    list_transform(range(0, 4), lambda k: CAST('0x' || substr(x, CAST(8 * k + 1 AS BIGINT), 8) AS BIGINT)) AS h FROM d),
c AS (SELECT *, len(u) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b FROM u),
p AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix,
    CASE WHEN plain OR h[3] % 100 >= 100 THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p
"""


def op13_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_turns": op1_chat_turns,
        "op2_kdtree_topk": op2_kdtree_topk,
        "op3_shard_tree": op3_shard_tree,
        "op4_decontaminate": op4_decontaminate,
        "op5_bpe_round_trip": op5_bpe_round_trip,
        "op6_token_counts": op6_token_counts,
        "op7_minhash_neardup": op7_minhash_neardup,
        "op8_html_text": op8_html_text,
        "op9_quality": op9_quality,
        "op10_warc": op10_warc,
        "op11_ranked_search": op11_ranked_search,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_simhash_neardup": op13_simhash_neardup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_kdtree_topk": OP2_SQL, "op4_decontaminate": OP4_SQL, "op7_minhash_neardup": OP7_SQL, "op10_warc": OP10_SQL, "op11_ranked_search": OP11_SQL, "op12_fill_in_middle": OP12_SQL}
