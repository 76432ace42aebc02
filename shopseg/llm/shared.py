"""Helpers all operators of this subpackage share."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopseg.session import checkpoint_dir

#: Upper- and lower-case ASCII letters, for A-Z lowering that leaves other letters alone.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """Cut lineage: ``df`` written as Parquet to the shared folder and read again.

    The files survive the loss of any executor, and nothing upstream runs twice. ``options``: of the writer.
    """
    path = shared_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def arrow_bytes(spark: SparkSession, size: int):
    """Actions inside hand about so many bytes at a time to Python, one row at least: for rows of very different sizes."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone: other columns, whatever their names, never get in the way."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def spare(docs: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores added until no column of ``docs`` is called so."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def keyed(docs: DataFrame, id_name: str = "__id", hash_name: str = "__h") -> DataFrame:
    """``docs`` plus two columns that tell documents apart even where ``doc_id`` is null or repeated."""
    return docs.withColumns({id_name: F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")),
                             hash_name: F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))})


def lower_ascii(col):
    """A-Z lowered, every other character kept.

    ``lower`` does just that to a pure ASCII string and is much faster there than ``translate``.
    """
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))
