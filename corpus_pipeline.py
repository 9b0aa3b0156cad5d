"""The corpus pipeline: language ID, near-duplicate removal, decontamination, mixing, sharding.

Every stage gets all that its predecessor kept, read again from Parquet.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import language_id as lid
from strata.llm.common import load, settle
from strata.llm.decontaminate import contaminated, overlaps
from strata.llm.jaccard_join import jaccard_join
from strata.llm.mixing import mix
from strata.llm.sharding import shard_documents

MAX_BITS_PER_BYTE = 8.0  # a text that the best tree codes no shorter than plain bytes is in no learned language


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those in no learned language."""
    predicted = lid.predict(docs, lid.train(docs), keep=docs.columns)
    known = (F.col("lang_pred") != "und") & (F.col("bits_per_byte") < MAX_BITS_PER_BYTE)
    return predicted.where(known).select("kept.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group that the n-gram Jaccard join links."""
    rows = jaccard_join(docs, k=5, percent=80)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row_hash")
    stay = rows.where(F.col("component").isNotNull()).groupBy("component").agg(F.min(order).alias("s")).select(
        F.col("s.id").alias("s_id"), F.col("s.row_hash").alias("s_hash"))
    stay = stay.unionByName(rows.where(F.col("component").isNull()).select(
        F.col("id").alias("s_id"), F.col("row_hash").alias("s_hash")).distinct())
    hashed = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("row_hash"))
    kept = hashed.join(stay, hashed["id"].eqNullSafe(F.col("s_id")) & (F.col("row_hash") == F.col("s_hash")))
    return kept.dropDuplicates(["id", "row_hash"]).select("doc.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of whose words a twentieth or more lies in benchmark windows."""
    found = overlaps(docs, load(spark, sf_dir, "benchmark"), window=13, k=7, keep=docs.columns)
    return found.where(~contaminated(F.col("n_hit"), F.col("n_words"))).select("kept.*").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture in its order: no source has over a fifth of it, smaller ones are read again instead."""
    mixture = mix(docs, block=8, period=200, max_share=0.2, keep=docs.columns)
    ordered = mixture.repartitionByRange("mix.slot").sortWithinPartitions("mix.slot", "mix.place")
    return ordered.select("kept.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    return shard_documents(docs, shards=8)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

ORACLE_SQL = None  # the code lengths of stage 1 can't be had in SQL; tests/llm hold run() against a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
