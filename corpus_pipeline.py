"""A training corpus from the documents table, in stages.

Each stage reads what the one before it kept. Null and empty texts, long ones, ties, repeated
rows, empty tables and further columns, whatever their names, are treated as the docstring of
the stage's operator says; all stages but the last keep the columns they get.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.llm import (
    compression_bands,
    flow_mixing,
    line_neighbourhood,
    order_minhash,
    pattern_packing,
)
from accesslens.llm.common import written
from accesslens.llm.tokens import vocabulary
from accesslens.session import ship_package

MAX_TOKENS, END_ID = 4096, 1
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
#: Chunks a Python worker remembers and bytes of text it takes at once when it encodes: less
#: than usual, as the stages before have grown the executor it shares.
REMEMBERED, TOGETHER = 100_000, 2_000_000
#: Documents that are handed to a Python worker at once: both sides hold a batch several times.
BATCH_ROWS, BATCH_SETTING = 1_000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """From now on batches for Python have ``BATCH_ROWS`` rows at most; 0 is no limit.

    No result depends on it. ``run`` sets back what was set; stages that are called by
    themselves leave it, as they return tables that are computed later.
    """
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands and base rules keep."""
    small_batches(spark)
    return compression_bands.reject(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that came earlier; those left without words go."""
    cleaned = line_neighbourhood.deduplicate_lines(docs, drop_empty=True)
    if "n_chars" in docs.columns:
        n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", n_chars)
    return cleaned


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    small_batches(spark)
    return order_minhash.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    quotas = flow_mixing.source_quotas(WEIGHTS, SHARE, MOST)
    return flow_mixing.mix(docs, quotas, repeats=int(MOST))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    small_batches(spark)
    words = vocabulary("word_bpe_49k.json")
    memory = {"remembered": REMEMBERED, "together": TOGETHER}
    return pattern_packing.pack_documents(docs, words, MAX_TOKENS, END_ID, **memory)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near-dedup", near_duplicates),
    ("source mix", mixture),
    ("packing", packing),
]

#: Compression can't be expressed in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = spark.conf.get(BATCH_SETTING)
    try:
        for name, stage in STAGES:
            docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    finally:
        spark.conf.set(BATCH_SETTING, before)
    return docs


PIPELINE = {"pipeline": run}
PIPELINE_ORACLE: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
