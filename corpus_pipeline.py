"""A training corpus from raw documents: recognise languages, drop near copies and benchmark text, mix, shard."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tenderlake.llm import decontaminate, entropy_mix, jaccard_join, ppm_language, reshard
from tenderlake.llm.queries import shard_columns
from tenderlake.session import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents that a Python worker holds at a time. Workers live on from stage to stage, and so does the memory they once took.
BATCH_ROWS = 500
#: Workers give memory back to the system when they are done with it.
WORKER_ENVIRONMENT = {"MALLOC_ARENA_MAX": "2", "MALLOC_TRIM_THRESHOLD_": "1048576", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def lean(stage: Stage) -> Stage:
    """The stage with small batches and small workers; its result is computed later, so the settings stay."""

    def run_lean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        spark.sparkContext.environment.update(WORKER_ENVIRONMENT)
        return stage(spark, docs, sf_dir)

    return run_lean


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language (no text, no letter) go; all others stay unchanged.

    The model learns from the documents with a language; without any, nothing is recognised and all go.
    """
    return ppm_language.keep_known(docs, held_out="crc32(cast(cast(doc_id as string) as binary)) % 5 = 0")


def first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of n-gram links stays, the one with the smallest id."""
    return jaccard_join.keep_first(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of benchmark words go; all others stay unchanged."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for, at most three times."""
    return entropy_mix.plan_mix(docs).take(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of near equal bytes, written as files; returns a row per document with its place."""
    return shard_columns(reshard.reshard(docs))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", lean(known_languages)),
    ("ngram_jaccard_join", lean(first_of_near_copies)),
    ("benchmark_decontamination", lean(without_benchmark)),
    ("source_mixing", lean(mixed_sources)),
    ("sharding", lean(sharded)),
]

#: SQL cannot score texts by a fitted context tree.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and reread as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = staged(docs)
    return docs
