"""User-level features (A4-A11, F1, M1) in one grouped aggregate.

The reference builds five per-user frames (basics, modes, count pivot, revenue
pivot, entropy) and merges them. Here every one of them is a column of a single
``groupBy(User_ID)``: the per-bucket counts and revenues are conditional
aggregates over the at most ``top_cat + 1`` buckets, so the whole feature row
costs one shuffle of the transactions, and all aggregates are partial
(map-side combined) so a user holding a large share of the rows does not
concentrate raw rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopseg.functions import sqltext as sq
from shopseg.functions.scalar import ENTROPY_FLOOR, OTHER_CATEGORY, UNKNOWN_LEVEL

# Column name conventions of the feature table (fixed values).
MODE_SOURCES = [("Age", "Age_mode"), ("Gender", "Gender_mode"), ("City_Category", "City_Category_mode"),
                ("Stay_In_Current_City_Years", "Stay_mode"), ("Marital_Status", "Marital_mode"),
                ("Occupation", "Occupation_mode")]
STRING_MODES = ["Age_mode", "Gender_mode", "City_Category_mode"]
INT_MODES = ["Stay_mode", "Marital_mode", "Occupation_mode"]
SHARE_PREFIX = "cat_share__"
REV_SHARE_PREFIX = "cat_rev_share__"
LOG_BASES = ["avg_purchase", "median_purchase", "std_purchase"]


def category_frequency(tx: DataFrame) -> DataFrame:
    """Rows per category label (``cat_unknown`` included)."""
    return tx.groupBy("Product_Category_str").agg(F.count(F.lit(1)).alias("n"))


def top_categories(tx: DataFrame, top_cat: int = 10) -> tuple[list[str], bool]:
    """O3: the ``top_cat`` most frequent labels (ties -> label ascending).

    Returns the labels and whether any other label exists (then the
    ``cat_other`` bucket is present). At most ``top_cat + 1`` rows reach the driver.
    """
    rows = (category_frequency(tx).orderBy(F.desc("n"), F.asc("Product_Category_str"))
            .limit(top_cat + 1).collect())
    labels = [r["Product_Category_str"] for r in rows[:top_cat]]
    return labels, len(rows) > top_cat


def bucket_list(top: list[str], has_other: bool) -> list[str]:
    """Buckets in the reference's pivot column order (sorted labels)."""
    return sorted(top + ([OTHER_CATEGORY] if has_other else []))


def bucket_column(top: list[str]) -> F.Column:
    """Label if among the top categories, else ``cat_other``."""
    return F.when(F.col("Product_Category_str").isin(top), F.col("Product_Category_str")) \
            .otherwise(F.lit(OTHER_CATEGORY))


def user_medians(tx: DataFrame) -> DataFrame:
    """``User_ID, median_purchase`` for all users in one plan.

    Equal purchases of a user are counted first (map-side, so a user with a third of all rows arrives as
    distinct prices), then running counts find the middle ranks.
    """
    counts = tx.groupBy("User_ID", "Purchase").agg(F.count(F.lit(1)).alias("n"))
    user = Window.partitionBy("User_ID")
    c = counts.withColumns({"upto": F.sum("n").over(user.orderBy("Purchase")), "all": F.sum("n").over(user)})
    middle = c.where("upto > (all - 1) div 2 AND upto - n <= all div 2")  # holds rank (all-1)/2 or all/2, from 0
    return middle.groupBy("User_ID").agg(F.min("Purchase").alias("lo"), F.max("Purchase").alias("hi")) \
        .select("User_ID", (F.col("lo") + (F.col("hi") - F.col("lo")) * 0.5).alias("median_purchase"))


def user_modes(tx: DataFrame) -> DataFrame:
    """``User_ID`` and the mode of each of ``MODE_SOURCES`` (ties: the smallest value; NULLs do not count) in one plan.

    Equal values of a user are counted in a hash table. The ``mode`` aggregate gives the same, but a task with more than
    128 users sorts all its rows for it, and spills them when they do not fit.
    """
    text = {dst: dst in STRING_MODES for _, dst in MODE_SOURCES}
    cells = ", ".join(f"named_struct('k', {k}, 's', {sq.q(src) if text[dst] else 'CAST(NULL AS STRING)'}, "
                      f"'v', CAST({'NULL' if text[dst] else sq.q(src)} AS BIGINT))" for k, (src, dst) in enumerate(MODE_SOURCES))
    counts = tx.selectExpr("User_ID", f"inline(array({cells}))").where("s IS NOT NULL OR v IS NOT NULL") \
        .groupBy("User_ID", "k", "s", "v").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("User_ID").agg(*[F.expr(f"min(CASE WHEN k = {k} THEN named_struct('less', -n, 's', s, 'v', v) END) AS _m{k}")
                                           for k in range(len(MODE_SOURCES))])
    return best.selectExpr("User_ID", *[f"_m{k}.{'s' if text[dst] else 'v'} AS {dst}" for k, (_, dst) in enumerate(MODE_SOURCES)])


def user_features(tx: DataFrame, top_cat: int = 10, buckets: list[str] | None = None,
                  by_user: bool = False) -> tuple[DataFrame, list[str]]:
    """M1: one feature row per user; returns ``(features, buckets)``.

    Columns: ``User_ID, n_transactions, total_purchase, avg_purchase,
    median_purchase, std_purchase, unique_products, <6 modes>,
    cat_share__<b>..., cat_rev_share__<b>..., cat_entropy, n_unique_categories,
    avg/median/std_purchase_log1p``.

    Skew: every aggregate is partial; medians and distinct products (and the modes, ``by_user``) have
    their own two-step aggregates, joined on the same hash partitioning.

    ``by_user``: ``tx`` is read from rows persisted in a deal by ``User_ID``, so that nothing has to be shuffled for the
    aggregates (Spark still does it where that is not so).
    """
    if buckets is None:
        top, has_other = top_categories(tx, top_cat)
        buckets = bucket_list(top, has_other)
    top = [b for b in buckets if b != OTHER_CATEGORY]
    # a user's rows come together before they are aggregated: the partial rows are wide, and there would be nearly one per
    # purchase
    t = tx.select("User_ID", "Purchase", F.col("Product_ID").isNotNull().alias("_known"), *[src for src, _ in MODE_SOURCES],
                  F.array_position(F.array(*[F.lit(b) for b in buckets]), bucket_column(top)).alias("_bucket"))
    if not by_user:
        t = t.hint("rebalance", "User_ID")
    aggs = [
        "count(1) AS n_transactions",
        "sum(Purchase) AS total_purchase",
        "avg(Purchase) AS avg_purchase",
        "coalesce(stddev_samp(Purchase), 0.0D) AS std_purchase",
    ]
    if not by_user:  # in the one shuffle of the wide aggregate; dealt rows can be read again (``user_modes``)
        aggs += [f"mode({sq.q(src)}, true) AS {dst}" for src, dst in MODE_SOURCES]
    for i in range(len(buckets)):
        aggs.append(f"count_if(_known AND _bucket = {i + 1}) AS _n{i}")
        aggs.append(f"sum(CASE WHEN _bucket = {i + 1} THEN Purchase ELSE 0.0D END) AS _r{i}")
    g = t.groupBy("User_ID").agg(*[F.expr(e) for e in aggs])
    # distinct products: its own two-step aggregate (a distinct aggregate inside the big one would
    # force the expand + sort-based path for every column); both sides come out hash-partitioned by
    # User_ID, so the join adds no shuffle.
    uniq = (tx.select("User_ID", "Product_ID").where(F.col("Product_ID").isNotNull()).distinct()
              .groupBy("User_ID").agg(F.count(F.lit(1)).alias("unique_products")))
    g = g.join(uniq, "User_ID", "left").join(user_medians(tx), "User_ID", "left")
    if by_user:
        g = g.join(user_modes(tx), "User_ID", "left")

    nb = len(buckets)
    nt = " + ".join(f"_n{i}" for i in range(nb))
    rt = " + ".join(f"_r{i}" for i in range(nb))
    g = g.selectExpr("*", f"({nt}) AS _nt", f"({rt}) AS _rt")
    # p clipped to [1e-12, 1]: empty buckets contribute -1e-12 * ln(1e-12) each
    terms = []
    for i in range(nb):
        p = f"least(greatest(_n{i} / _nt, {ENTROPY_FLOOR!r}D), 1.0D)"
        terms.append(f"(-{p} * ln({p}))")
    cols = [
        "User_ID",
        "CAST(n_transactions AS BIGINT) AS n_transactions",
        "total_purchase", "avg_purchase", "median_purchase", "std_purchase",
        "CAST(coalesce(unique_products, 0) AS BIGINT) AS unique_products",
        *[f"coalesce({c}, {sq.s(UNKNOWN_LEVEL)}) AS {c}" for c in STRING_MODES],
        *[f"coalesce(CAST({c} AS SMALLINT), CAST(-1 AS SMALLINT)) AS {c}" for c in INT_MODES],
        *[f"CAST(_n{i} AS DOUBLE) / CASE WHEN _nt = 0 THEN 1.0D ELSE _nt END AS {sq.q(SHARE_PREFIX + b)}"
          for i, b in enumerate(buckets)],
        *[f"_r{i} / CASE WHEN _rt = 0 THEN 1.0D ELSE _rt END AS {sq.q(REV_SHARE_PREFIX + b)}"
          for i, b in enumerate(buckets)],
        f"CASE WHEN _nt <= 0 THEN 0.0D ELSE {' + '.join(terms)} END AS cat_entropy",
        "CAST(" + " + ".join(f"CASE WHEN _n{i} > 0 THEN 1 ELSE 0 END" for i in range(nb)) + " AS BIGINT) AS n_unique_categories",
        *[f"log1p(CAST({c} AS DOUBLE)) AS {c}_log1p" for c in LOG_BASES],
    ]
    feats = g.selectExpr(*cols)
    # Numeric NULLs -> 0. The aggregates above cannot produce one (counts are counts, sums of a
    # non-null column, coalesced std), so this is the identity here and is kept implicit.
    return feats, buckets


def share_long(feats: DataFrame, buckets: list[str]) -> DataFrame:
    """Long form of the share columns: ``User_ID, bucket, share, rev_share``."""
    stack = ", ".join(f"'{b}', `{SHARE_PREFIX}{b}`, `{REV_SHARE_PREFIX}{b}`" for b in buckets)
    return feats.selectExpr("User_ID", f"stack({len(buckets)}, {stack}) as (bucket, share, rev_share)")


def numeric_feature_columns(df: DataFrame, exclude: tuple[str, ...] = ("User_ID", "cluster")) -> list[str]:
    """Numeric columns minus the id / label."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
