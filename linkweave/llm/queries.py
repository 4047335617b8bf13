"""One registered query for each operator, over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.llm import (
    decontaminate,
    license_scan,
    lm_score,
    mixing,
    near_dedup,
    periodic_runs,
    personal_data,
    prefix_trie,
    quality_model,
    quality_rules,
    sharding,
    suffix_dedup,
    token_records,
)
from linkweave.llm.oracle import LLM_SQL  # noqa: F401 - registered with the queries

Query = Callable[[SparkSession, str], DataFrame]
LLM_QUERIES: dict[str, Query] = {}

# Token vocabulary of op10_token_records.
VOCABULARY = "word_bpe_49k.json"


def query(function: Query) -> Query:
    LLM_QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_license_scan(spark, sf_dir):
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


@query
def op2_benchmark_decontamination(spark, sf_dir):
    return decontaminate.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


@query
def op3_quality_rules(spark, sf_dir):
    trusted = quality_rules.trusted_documents(_table(spark, sf_dir, "labels"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.quality_rules(docs, trusted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "llr",
    )


@query
def op4_feistel_sharding(spark, sf_dir):
    placed = sharding.shard(_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op5_source_mixing(spark, sf_dir):
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


@query
def op6_quality_classifier(spark, sf_dir):
    return quality_model.score_quality(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


@query
def op7_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


@query
def op8_minhash_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


@query
def op9_lm_scoring(spark, sf_dir):
    return lm_score.score_texts(_table(spark, sf_dir, "documents"))


@query
def op10_token_records(spark, sf_dir):
    read = token_records.encode_documents(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)
    )
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


def planted_period(doc_id: int | None, n: int) -> np.ndarray | None:
    """Word order of op11: in a tenth of the texts the rest from some word on is periodic."""
    spread = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if spread % 10 or not n:
        return None
    first = spread // 10 % n
    period = 1 + (n - first) // (3 + spread // 10 % 8)
    order = np.arange(n)
    order[first:] = first + (order[first:] - first) % period
    return order


@query
def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs.periodic_runs(_table(spark, sf_dir, "documents"), planted_period)
    longest = found.withColumn("longest", periodic_runs.longest_run(F.col("runs")))
    return longest.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "longest.start",
        "longest.length",
        "longest.period",
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(periodic_runs.run_lines(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_personal_data(spark, sf_dir):
    """The counts and the digest are those of the fixed patterns; n_added is the field's share."""
    field = personal_data.train_field(personal_data.labelled_table(spark))
    found = personal_data.personal_data(_table(spark, sf_dir, "documents"), field)

    def count(kind: str):
        return F.size(F.filter("patterns", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in personal_data.KINDS],
        F.sha2(personal_data.span_text(F.col("patterns")), 256).alias("base_sha256"),
        personal_data.span_text(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("patterns")).cast("bigint").alias("n_added"),
    )


# Fixed values of op13: conversations of a group, and how many lengths an opening can have.
TRIE_GROUP, TRIE_OPENINGS = 100, 6


@query
def op13_prefix_trie(spark, sf_dir):
    turns = prefix_trie.ordered_turns(_table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(
        *prefix_trie.share_openings(*turns, TRIE_GROUP, TRIE_OPENINGS)
    )
