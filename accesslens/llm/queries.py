"""The operators of this package as queries over the given tables.

Each takes a session and the folder of the tables, reads its table whole, and derives
the columns of its result from the operator's own output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.llm import (
    binary_records,
    compression_bands,
    flow_mixing,
    line_neighbourhood,
    max_score,
    order_minhash,
    pattern_packing,
    span_boosting,
    spelling_groups,
    text_density,
    token_alignment,
    url_boosting,
    weighted_sampling,
)
from accesslens.llm.common import required, written
from accesslens.llm.tokens import vocabulary
from accesslens.session import new_folder, ship_package


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(documents(spark, sf_dir))


def op2_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents' token ids as records and reads them back."""
    folder = new_folder(spark, "llm-records")
    binary_records.write_records(
        documents(spark, sf_dir), folder, vocabulary("byte_bpe_50k.json"), end_id=2
    )
    return binary_records.read_records(spark, folder)


def op3_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packing.pack_documents(
        documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), 4096, end_id=1
    )


def op4_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_density.extract(pages(spark, sf_dir))


def op5_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.edited_fingerprints(documents(spark, sf_dir))


def op6_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = required(documents(spark, sf_dir), ["doc_id", "text"])
    measured = compression_bands.with_measures(docs, "quality")
    return measured.select("doc_id", "quality.*")


def op7_url_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_boosting.judge(pages(spark, sf_dir))


def op8_flow_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow_mixing.mix_report(documents(spark, sf_dir))


def op9_span_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and digest of the base spans, and all spans, of each document."""
    found = span_boosting.find_spans(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["base"])

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(kind: str) -> Column:
        of_kind = F.filter(base, lambda s: s["kind"] == kind)
        return F.size(of_kind).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in span_boosting.KINDS]
    digest = F.sha2(listed(base), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, listed(F.col("spans")).alias("spans"))


def op10_line_neighbourhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's number of lines, of removed ones, and the text that stays."""
    docs = required(documents(spark, sf_dir), ["doc_id", "text"])
    return line_neighbourhood.deduplicate_lines(docs, counts=True)


def op11_max_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of all other vectors for every fiftieth one."""
    vectors = max_score.integer_terms(embeddings(spark, sf_dir))
    return max_score.search(vectors, vectors.where("id % 50 = 0"), k=5)


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups.variant_groups(documents(spark, sf_dir))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of each document, with a digest of its groups and its links' counts."""
    letters, pieces = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    rows = token_alignment.alignments(documents(spark, sf_dir), letters, pieces)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    rows = rows.withColumn("groups", digest).withColumnRenamed("groups", "groups_sha256")
    stored = written(rows, "alignments", compression="zstd")
    return token_alignment.with_link_counts(stored, token_alignment.n_pieces(pieces)).drop("row")


QUERIES = {
    "op1_order_minhash": op1_order_minhash,
    "op2_binary_records": op2_binary_records,
    "op3_pattern_packing": op3_pattern_packing,
    "op4_text_density": op4_text_density,
    "op5_weighted_sampling": op5_weighted_sampling,
    "op6_compression_bands": op6_compression_bands,
    "op7_url_boosting": op7_url_boosting,
    "op8_flow_mixing": op8_flow_mixing,
    "op9_span_boosting": op9_span_boosting,
    "op10_line_neighbourhood": op10_line_neighbourhood,
    "op11_max_score": op11_max_score,
    "op12_spelling_groups": op12_spelling_groups,
    "op13_token_alignment": op13_token_alignment,
}
