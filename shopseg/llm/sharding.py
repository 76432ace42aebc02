"""Byte-balanced contiguous shards from global prefix sums.

Rows are range-partitioned by ``doc_id`` (sizes and checksums only, never the text); each partition's
running byte sum plus the total of the partitions before it is the row's global prefix sum, and the
row's midpoint decides its shard, so cuts lie at equal byte targets and a shard is off its target by at
most one document.

Null text counts as no bytes. Null ``doc_id`` sorts first and stays null. Rows that repeat a ``doc_id``
stay next to each other, ordered by size and checksum. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopseg.llm import shared


def shard_by_bytes(docs: DataFrame, shards: int = 16) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, start_byte`` with shards 0 to ``shards - 1``."""
    spark = docs.sparkSession
    sized = shared.texts(docs).select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"))
    sized = shared.written(sized, "sizes")  # the range partitioner samples its input: texts are read once
    order = ["doc_id", "size", "text_crc32", "row"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = shared.written(sized.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "dealt")

    # one row per partition, whatever the input
    totals = dealt.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    bases = totals.select("part", F.coalesce(F.sum("bytes").over(before), zero).alias("bytes_before"),
                          F.coalesce(F.sum("rows").over(before), zero).alias("rows_before"),
                          F.sum("bytes").over(Window.partitionBy()).alias("total"))
    within = Window.partitionBy("part").orderBy(*order)
    placed = dealt.join(F.broadcast(bases), "part").select(
        "doc_id", "size", "text_crc32",
        (F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
         + F.col("bytes_before")).alias("start_byte"),
        (F.row_number().over(within) - 1 + F.col("rows_before")).alias("at"), "total")
    # twice the midpoint against twice the total, in whole numbers
    placed = placed.withColumn("shard", F.least(F.lit(shards - 1), F.expr(
        f"((2 * start_byte + size) * {shards}) div (2 * total)")).cast("int"))
    placed = shared.written(placed.drop("total"), "placed")
    firsts = placed.groupBy("shard").agg(F.min("at").alias("first"))  # at most `shards` rows
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("at") - F.col("first")).alias("slot"), "start_byte")
