"""Incremental core / niche split (K2 as a Structured Streaming job).

The reference routes the raw transaction file into a core file and a niche
file by reading it in 200,000-row chunks and appending each chunk's rows to
the right file, header once. The streaming form reads the transaction folder
as a file stream (every file once, exactly-once bookkeeping next to the
output), joins each micro-batch with the static ``User_ID ->
segment`` table and appends to ``segment=core`` / ``segment=niche``
partitions. ``availableNow`` processes what is there and stops, which is the
reference's one-shot behaviour; new files dropped later are picked up by the
next run without reprocessing old ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopseg.operators.basket import BROADCAST_ROWS
from shopseg.sources.transactions import TRANSACTION_COLUMNS

TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in TRANSACTION_COLUMNS])


def split_stream(spark: SparkSession, source_dir: str, segments: DataFrame, out_dir: str,
                 checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                 fmt: str = "csv") -> dict:
    """Route every raw row of ``source_dir`` (CSV with header) to its segment folder.

    ``segments``: ``User_ID int, segment string``. Rows of users without a
    segment are dropped, as in the reference. Returns the query's last progress.
    Progress is kept in ``checkpoint``, by default a hidden folder of ``out_dir``: the file sink's own
    log counts batches, so a run with a fresh checkpoint would take new files for written ones.
    """
    reader = spark.readStream.schema(TEXT_SCHEMA).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(source_dir)
    seg = segments.select(F.col("User_ID").cast("int").alias("_uid"), "segment")
    n = seg.count()
    seg = F.broadcast(seg) if n <= BROADCAST_ROWS else seg
    routed = (stream.join(seg, F.col("User_ID").cast("int") == F.col("_uid"), "inner").drop("_uid"))
    ckpt = checkpoint or f"{out_dir.rstrip('/')}/_split_checkpoint"
    writer = (routed.writeStream.format(fmt).outputMode("append").option("path", out_dir)
              .option("checkpointLocation", ckpt).partitionBy("segment").trigger(availableNow=True))
    if fmt == "csv":
        writer = writer.option("header", True)
    q = writer.start()
    q.awaitTermination()
    return q.lastProgress or {}
