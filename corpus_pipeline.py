"""From raw documents to packed training sequences: five stages, each one of the operators in ``shopseg.llm``.

Each stage takes ``(spark, docs, sf_dir)`` with ``docs`` in the columns of ``documents`` and returns a DataFrame: the
documents it keeps in the same columns, or, for the last one, the packed pieces. Stages are written as Parquet
and read again, so each starts from files that outlive any executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopseg.llm import decontaminate, language, linededup, packing, shared, simhash

SHINGLE, DISTANCE, WINDOW, CAPACITY = 4, 4, 10, 2048


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those too far from every centroid, or without a letter, go."""
    _, _, rejected = shared.spare(docs, *language.ADDED)
    return language.identify(docs, language.train(docs)).where(~F.col(rejected)).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that one of a smaller id holds; ``n_chars`` follows the text. None goes."""
    out = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs))
    _, _, kept = shared.spare(docs, *linededup.ADDED)
    text = F.when(F.col("text").isNull(), F.col("text")).otherwise(F.col(kept))
    return out.withColumns({"text": text, "n_chars": F.char_length(text).cast("long")}).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id."""
    return simhash.keep_one(docs, SHINGLE, DISTANCE)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), WINDOW)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in training sequences."""
    return packing.pack_documents(docs, CAPACITY)


STAGES = [
    ("language_id", keep_identified),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: Centroids, fingerprints by XXH64 and tokenization have no SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = shared.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = shared.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
