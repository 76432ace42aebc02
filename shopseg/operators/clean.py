"""Row-level cleaning: P1-P8 (dedupe, coercion, fills, global-mode imputation, winsorizing)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopseg.functions.quantiles import quantile_bounds, quantile_stat_columns
from shopseg.functions.scalar import (UNKNOWN_LEVEL, category_label, clip, coerce_category,
                                      fill_purchase, strip_plus_to_int)
from shopseg.sources.transactions import TRANSACTION_COLUMNS, _typed

TEXT_LEVELS = ["Gender", "Age", "City_Category"]
MODE_IMPUTED = ["Occupation", "Marital_Status", "Stay_In_Current_City_Years"]


def typed_deduplicated(raw: DataFrame, by_user: bool = False) -> DataFrame:
    """P1 on the reader's types: exact duplicates dropped after typing and pruning.

    ``Purchase`` is already rounded through float32 and the category is
    already a float, as in the reference, so rows that differ only in ways
    the reader erases count as duplicates. The dedupe is one shuffle with a
    map-side partial aggregate, so heavily repeated rows collapse before it.
    Rows without ``User_ID`` belong to no customer and are dropped here.
    ``by_user``: that shuffle deals the rows by ``User_ID`` (duplicates share it), so they need not be dealt again.
    """
    typed = _typed(raw.select(*[c for c in TRANSACTION_COLUMNS if c in raw.columns]))
    typed = typed.withColumn(
        "Product_Category",
        F.col("Product_Category").try_cast("float"))
    known = typed.where(F.col("User_ID").isNotNull())
    return (known.repartition("User_ID") if by_user else known).dropDuplicates()


def coerced_transactions(raw: DataFrame, deduplicated: bool = False, by_user: bool = False) -> DataFrame:
    """S1 + P1-P6: the part of the cleaning that looks at a row alone, so that it commutes with a choice of users.

    ``by_user``: the rows are dealt by ``User_ID`` for those who persist them and read them per user several times.
    """
    if not deduplicated:
        d = typed_deduplicated(raw, by_user)
    else:
        d = raw.repartition("User_ID") if by_user else raw
    return d.select(
        F.col("User_ID"),
        F.col("Product_ID"),
        *[F.coalesce(F.col(c), F.lit(UNKNOWN_LEVEL)).alias(c) for c in TEXT_LEVELS],
        F.col("Occupation"),
        strip_plus_to_int(F.col("Stay_In_Current_City_Years")).alias("Stay_In_Current_City_Years"),
        F.col("Marital_Status"),
        coerce_category(F.col("Product_Category")).alias("Product_Category"),
        fill_purchase(F.col("Purchase")).alias("Purchase"),
    ).withColumn("Product_Category_str", category_label(F.col("Product_Category")))


def clean_transactions(raw: DataFrame, q_low: float = 0.01, q_high: float = 0.99,
                       quantile_method: str = "refine", persist: bool = True,
                       deduplicated: bool = False, by_user: bool = False) -> DataFrame:
    """S1 + P1-P8: the reference's read-and-clean step as one plan.

    Output columns: the ten transaction columns (Stay as tinyint, category as
    smallint) plus ``Product_Category_str``; ``Purchase`` is double, clipped to
    its ``[q_low, q_high]`` quantiles when ``0 < q_low < q_high < 1``.
    Two small driver round trips: the global modes (one aggregate row) and the
    quantile bounds; both are inlined as literals. ``deduplicated=True`` takes
    the output of ``typed_deduplicated`` (e.g. filtered to some users: dedupe
    commutes with a filter on a row column), skipping the read and the dedupe.
    ``by_user`` deals the persisted rows by ``User_ID`` (for ``user_features(by_user=True)``).
    """
    base = coerced_transactions(raw, deduplicated, by_user)
    if persist:
        base = base.persist(StorageLevel.MEMORY_AND_DISK)
    return impute_and_clip(base, q_low, q_high, quantile_method)


def impute_and_clip(base: DataFrame, q_low: float, q_high: float, quantile_method: str = "refine") -> DataFrame:
    """P7 + P8 of ``coerced_transactions``: what depends on all the rows at hand."""
    # Table-wide mode (ties -> smallest, all NULL -> 0), only used where NULLs exist.
    winsor = 0 < q_low < q_high < 1
    agg = base.selectExpr(*[f"count_if({c} IS NULL) AS {c}__nulls" for c in MODE_IMPUTED],
                          *[f"mode({c}, true) AS {c}__mode" for c in MODE_IMPUTED],
                          *(quantile_stat_columns(["Purchase"]) if winsor else [])).collect()[0]
    filled = base
    for c in MODE_IMPUTED:
        if agg[f"{c}__nulls"]:
            mode_val = agg[f"{c}__mode"]
            fill = 0 if mode_val is None else mode_val
            filled = filled.withColumn(c, F.coalesce(F.col(c), F.lit(fill).cast(base.schema[c].dataType)))

    # Row-level winsorizing of Purchase.
    if winsor:
        lo, hi = quantile_bounds(base, ["Purchase"], q_low, q_high, method=quantile_method,
                                 stats_row=agg)["Purchase"]
        filled = filled.withColumn("Purchase", clip(F.col("Purchase"), lo, hi))
    return filled.select(*TRANSACTION_COLUMNS, "Product_Category_str")


def basket_transactions(raw: DataFrame) -> DataFrame:
    """S2 + P1 + P3 + P4: the rule miner's narrow read.

    Only ``User_ID, Product_ID, Product_Category, Purchase`` are kept and exact
    duplicates are dropped *after* that projection (so rows differing in other
    columns collapse), then the category label is derived.
    """
    typed = _typed(raw.select(*[c for c in ["User_ID", "Product_ID", "Product_Category", "Purchase"]
                                if c in raw.columns]))
    narrow = typed.select("User_ID", "Product_ID", F.col("Product_Category").try_cast("float").alias("pc"),
                          "Purchase").dropDuplicates()
    code = coerce_category(F.col("pc"))
    return narrow.select("User_ID", "Product_ID", code.alias("Product_Category"), "Purchase",
                         category_label(code).alias("Product_Category_str"))
