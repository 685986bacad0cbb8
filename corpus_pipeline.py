"""The corpus pipeline: documents through language, dedup, mixing and encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.

Edge cases are those of the operators: nulls, empty texts, ties, repeated rows and further columns
pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import content_dedup, mixing, ppm_language, prefix_bpe, simhash
from ledgerline.llm.common import table, unused, with_file_order, written
from ledgerline.llm.queries import REST_WEIGHT, WEIGHTS
from ledgerline.session import configure


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter; texts in a language that was not learned mostly stay, all do if none was."""
    configure(spark)
    return ppm_language.drop_unknown(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    configure(spark)
    return content_dedup.drop_exact_copies(docs, keep="largest")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest id."""
    configure(spark)
    return simhash.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix; the files they are written to keep it."""
    configure(spark)
    return mixing.in_mixed_order(docs, WEIGHTS, REST_WEIGHT)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document, and its position in the mix."""
    configure(spark)
    [place] = unused(docs, "_place")
    return prefix_bpe.encode_documents(with_file_order(docs, place), place_col=place)


STAGES = [("language", language), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix", mix), ("encode", encode)]

#: SQL has neither byte context trees, nor SimHash classes, nor BPE; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over what its predecessor kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
