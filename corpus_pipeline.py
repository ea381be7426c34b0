"""Documents to token ids: a training-data pipeline in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor
kept.  All but the last return the columns of their input; the last returns
doc_id, n_tokens, ids and exact (whether decoding gives the text's very bytes).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradientlab.llm import bpe, decontaminate, langid, minhash, nbsvm
from gradientlab.llm.common import prepare, table
from gradientlab.session import stage_table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model, learnt from them, accepts."""
    prepare(spark)
    return langid.keep_accepted(docs, langid.fit(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from the labelled ones, does not reject."""
    prepare(spark)
    return nbsvm.keep_good(docs, nbsvm.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id."""
    prepare(spark)
    return minhash.keep_one(docs, 80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    prepare(spark)
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them."""
    prepare(spark)
    decoded = bpe.encode_and_decode(docs.select("doc_id", "text"), RANKS)
    return decoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("exact"),
    )


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("token_ids", token_ids),
]
#: Learnt models and merges are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    docs = table(prepare(spark), sf_dir.rstrip("/"), "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir.rstrip("/")), f"pipeline/{name}")
    return STAGES[-1][1](spark, docs, sf_dir.rstrip("/"))
