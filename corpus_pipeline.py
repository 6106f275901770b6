"""Documents to training ids: each stage's output is written and read again as the next one's documents."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fleetgrain.llm import decontaminate, jaccard_groups, mixing, quality_rules, token_files
from fleetgrain.llm.common import prepare, table
from fleetgrain.session import shared_dir

TOKENIZER = "word_bpe_49k.json"


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base check or a certified rule rejects go."""
    return quality_rules.keep(docs, table(prepare(spark), sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies stays."""
    prepare(spark)
    return jaccard_groups.keep_first(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return decontaminate.keep(docs, table(prepare(spark), sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stands as often as its source's target asks for."""
    prepare(spark)
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, written and read back: doc_id, start, n_tokens, ids_crc32 of each copy."""
    prepare(spark)
    return token_files.digests(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", rules),
    ("near_copies", near_copies),
    ("benchmark_passages", benchmark_passages),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

# near copies form groups over several links and rules rest on exact binomial bounds, so there is no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
