"""From raw documents to token ids in four stages.

Each stage gets the documents that its predecessor kept, written and read again,
and all but the last return them with the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skumill.llm.bpe import encode
from skumill.llm.common import free_name, stored, table
from skumill.llm.decontam import without_benchmark
from skumill.llm.neardup import without_near_duplicates
from skumill.llm.quality import train, with_scores

#: Documents of this similarity or more are near-duplicates; the contract of op7_ has a figure of its own.
SIMILAR = 80

#: The classifier, the near-duplicate components and the encoder have no SQL form.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more, all columns kept.

    Null, empty and wordless texts share one score and go or stay together, as
    repeated rows do; whole texts are read, however long.  Without usable labels
    every document scores 0.5 and stays; an empty table stays empty.  Any further
    columns may have any names.
    """
    model = train(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "__score")
    return with_scores(docs, model, score).where(F.col(score) >= 0.5).select(*docs.columns)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: that with the smallest doc_id.

    Rows without doc_id, text or words stay; rows that repeat a doc_id and its text
    stay or go together; of the texts of one doc_id each is linked for itself.
    Whole texts are compared; an empty table stays empty; all columns are kept.
    """
    return without_near_duplicates(docs, percent=SIMILAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window, all columns kept.

    Null, empty and wordless texts hold none and stay; rows that repeat a text stay
    or go together; whole texts are searched.  With an empty benchmark all stay, and
    an empty table stays empty.
    """
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and the digests of the ids and of the text that they decode to.

    One row for every row, repeated ones and those without doc_id too; a null text
    counts as empty and has no ids; whole texts are encoded; an empty table gives an
    empty result; further columns are left out.
    """
    done = encode(docs.select("doc_id", "lang", "source", F.col("text").cast("string").alias("text")), public_tokenizers.path("word_bpe_49k.json"))
    return done.select(
        "doc_id",
        "lang",
        "source",
        F.floor(F.octet_length("__ids") / 4).cast("long").alias("n_tokens"),
        F.col("__ids").alias("ids"),
        F.sha2("__ids", 256).alias("ids_sha256"),
        F.sha2(F.col("__decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [("quality", quality), ("near_duplicate", near_duplicate), ("decontamination", decontamination), ("bpe", bpe)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
