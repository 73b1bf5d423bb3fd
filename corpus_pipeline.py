"""The training-data pipeline over ``documents``.

Language ID, quality rules, SimHash near-dedup, source mixing, BPE encoding.
Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; its result is written as Parquet and read again as the next one's
documents.  All but the last return the columns of ``documents``.

Stages keep rows by decisions of their operator only: texts without a letter
or without a clear language go, texts that break a quality rule go, one row of
each near-duplicate group stays, mixing reads rows as often as the weights
ask, and encoding adds ``n_tokens`` and ``ids`` to every row.  Nulls, empty
texts, repeated rows and empty tables are treated as each operator says; an
empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm import bpe, language_id, mixing, quality, simhash
from flowlake.llm.common import table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_known(docs, language_id.learn(docs))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=simhash.SHINGLE, radius=simhash.RADIUS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = docs.select("doc_id", "lang", "source", bpe.encode(F.col("text")).alias("ids"))
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("simhash_dedup", remove_near_duplicates),
    ("source_mixing", mix_sources),
    ("bpe_encoding", encode_tokens),
]

#: The network of the first stage has no SQL form; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
