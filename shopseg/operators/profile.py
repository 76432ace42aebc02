"""Cluster profiles (A19) and sizes."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopseg.functions.quantiles import grouped_quantiles
from shopseg.operators.features import numeric_feature_columns


def cluster_sizes(labels: DataFrame, label_col: str = "cluster") -> DataFrame:
    """Rows per label."""
    return labels.groupBy(label_col).agg(F.count(F.lit(1)).cast("long").alias("size"))


def profile_clusters(df: DataFrame, label_col: str = "cluster", id_col: str = "User_ID",
                     columns: list[str] | None = None, quantile_method: str = "refine") -> DataFrame:
    """Per cluster, ``{feature}__count``, ``__mean`` and ``__median`` of every numeric feature.

    Counts and means are one partial aggregate; medians use the exact grouped
    quantile (no cluster is ever merged whole in one task).
    """
    cols = columns or numeric_feature_columns(df, exclude=(id_col, label_col))
    if not df.is_cached:  # read for the means and in every round of the medians
        df = df.select(label_col, *[F.col(f"`{c}`") for c in cols]).persist(StorageLevel.MEMORY_AND_DISK)
    basic = df.groupBy(label_col).agg(*[x for c in cols for x in (
        F.count(F.col(c)).cast("long").alias(f"{c}__count"), F.avg(F.col(c)).alias(f"{c}__mean"))])
    med = grouped_quantiles(df, label_col, cols, [0.5], method=quantile_method)
    groups = sorted({g for g, _ in med})
    rows = [(g, *[float(med[(g, c)][0]) for c in cols]) for g in groups]
    schema = f"{label_col} {dict(df.dtypes)[label_col]}, " + ", ".join(f"`{c}__median` double" for c in cols)
    medians = df.sparkSession.createDataFrame(rows, schema)
    ordered = [label_col] + [f"{c}__{s}" for c in cols for s in ("count", "mean", "median")]
    return basic.join(F.broadcast(medians), label_col).select(*[F.col(f"`{c}`") for c in ordered])
