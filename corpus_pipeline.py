"""Documents to training tokens: the stages of the pipeline, in order.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet in the shared
folder and read again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontamination import decontaminate
from tidemark.llm.language import accepted, held_out
from tidemark.llm.mixing import mixed_rows
from tidemark.llm.near_dup import deduplicate
from tidemark.llm.text import settle, table
from tidemark.llm.token_files import tokenizer_path, written_and_read

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the labelled ones; a text without letters, or as near to four languages, goes."""
    return accepted(docs, docs.filter(~held_out()), among=~held_out())


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return deduplicate(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixed_rows(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and from them where each document lies."""
    return written_and_read(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language", keep_languages),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token files", write_token_files),
]

# Language models, sketches and tokenizers are beyond SQL; tests hold the rows against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
