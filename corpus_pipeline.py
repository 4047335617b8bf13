"""From raw documents to shards: five stages, each written and read again as Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.llm import decontaminate, mixing, near_dedup, quality_rules, sharding
from linkweave.session import settled

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null and empty texts are too short and go; repeated rows are judged alike; no rows
    give no rows; extra columns pass through.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.keep_good(docs, quality_rules.trusted_documents(labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates.

    Of repeated rows one stays. Texts without words are never alike; those without a
    doc_id stay. No rows give no rows; extra columns pass through.
    """
    return near_dedup.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them.

    Null and empty texts stay. No rows give no rows; extra columns pass through.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, benchmark)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each source as often as its target asks for, up to three times.

    Texts without words are not taken. No rows give no rows; extra columns pass through.
    """
    return mixing.repeat_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with `shard` and `slot`; columns of these names are replaced.

    Rows are numbered by doc_id, then by text, so that repeats have places of their own.
    """
    return sharding.shard_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
    ("sharding", shards),
]

# The stages hash, and SQL has no such hashes; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over `documents`: the digest of the last one's rows.

    (doc_id, source, n_chars, text_crc32, shard, slot)
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name)
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return docs.select(
        "doc_id", "source", "n_chars", F.crc32(text).alias("text_crc32"), "shard", "slot"
    )
