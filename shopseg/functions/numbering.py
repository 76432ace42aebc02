"""Global row numbers and running sums without a window over all rows.

Rows are range-partitioned by the wanted order and stored, so the deal is fixed. Each partition numbers its own
rows; the totals of the partitions before it (a row per partition, whatever the input) are added.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopseg.session import checkpoint_dir

#: Name of the column that holds a row's range partition.
PART = "__range_part"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new folder under the shared checkpoint folder, and read again."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt_by_range(df: DataFrame, order: list[str | Column], name: str = "dealt") -> DataFrame:
    """``df`` in range partitions of ``order``, stored, with each row's partition in ``PART``."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(df.repartitionByRange(parts, *order).withColumn(PART, F.spark_partition_id()), name)


def totals_before(dealt: DataFrame, by: list[str], sums: dict[str, Column]) -> DataFrame:
    """Per ``PART`` (and ``by``): the totals of ``sums`` over the partitions before it that hold the same ``by``."""
    totals = dealt.groupBy(PART, *by).agg(*[e.alias(n) for n, e in sums.items()])
    before = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(PART, *by, *[F.coalesce(F.sum(n).over(before), F.lit(0).cast("long")).alias(n) for n in sums])


def numbered(df: DataFrame, order: list[str | Column], column: str = "number", by: list[str] | None = None) -> DataFrame:
    """``df`` plus ``column``: each row's place (from 0) in ``order``, counted per ``by`` if given.

    ``by`` must lead ``order``. A group of any size spans as many range partitions as it needs. Rows
    that ``order`` does not tell apart are numbered in any order, so give a total one.
    """
    by = by or []
    dealt = dealt_by_range(df, order)
    before = totals_before(dealt, by, {"__before": F.count(F.lit(1))})
    own = F.row_number().over(Window.partitionBy(PART, *by).orderBy(*order)) - F.lit(1)
    ranked = dealt.withColumn("__own", own)
    # a null key is a group, too
    on = [F.col(f"r.{c}").eqNullSafe(F.col(f"t.{c}")) for c in (PART, *by)]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return ranked.alias("r").join(before.alias("t"), cond).select(
        *[F.col(f"r.{c}") for c in df.columns], (F.col("r.__own") + F.col("t.__before")).cast("long").alias(column))
