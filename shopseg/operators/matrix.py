"""Feature matrix: user-level winsorizing (P9), robust scaling (M2), one-hot
modes (M3), assembly (M4) and PCA by explained variance (M5, M6).

Everything is column arithmetic on the per-user DataFrame; the only values
brought to the driver are per-column statistics (quantiles, category levels)
and the d x d PCA basis, all bounded by the number of columns, not users.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopseg.functions.quantiles import column_quantiles, quantile_bounds
from shopseg.functions import sqltext as sq
from shopseg.operators.features import INT_MODES, REV_SHARE_PREFIX, SHARE_PREFIX, numeric_feature_columns
from shopseg.operators.principal import principal_axes

# Matrix layout of the reference (fixed values).
NUMERIC_BASE = ["n_transactions", "unique_products", "cat_entropy", "n_unique_categories"]
LOG_COLUMNS = ["avg_purchase_log1p", "median_purchase_log1p", "std_purchase_log1p"]
CATEGORICAL = ["Age_mode", "Gender_mode", "City_Category_mode", "Stay_mode", "Marital_mode", "Occupation_mode"]
MAX_LEVELS = 10_000


def winsorize_features(feats: DataFrame, q_low: float, q_high: float, include_mode_columns: bool = True,
                       quantile_method: str = "refine") -> DataFrame:
    """Clip every numeric column but ``User_ID`` to its quantiles.

    Guarded like the one-pass variant: nothing happens unless
    ``0 < q_low < q_high < 1``. With ``include_mode_columns`` the integer mode
    columns are clipped too (they may become fractional, as in the reference).
    Clipped columns come back as double.
    """
    if not (0 < q_low < q_high < 1):
        return feats
    cols = [c for c in numeric_feature_columns(feats) if include_mode_columns or c not in INT_MODES]
    bounds = quantile_bounds(feats, cols, q_low, q_high, method=quantile_method)
    return feats.selectExpr(*[f"{sq.clip(c, *bounds[c])} AS {sq.q(c)}" if c in bounds else sq.q(c)
                              for c in feats.columns])


def matrix_columns(feats: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric block (base, shares, revenue shares, log1p) and categorical block."""
    numeric = [c for c in NUMERIC_BASE if c in feats.columns]
    numeric += [c for c in feats.columns if c.startswith(SHARE_PREFIX)]
    numeric += [c for c in feats.columns if c.startswith(REV_SHARE_PREFIX)]
    numeric += [c for c in LOG_COLUMNS if c in feats.columns]
    return numeric, [c for c in CATEGORICAL if c in feats.columns]


ROBUST_PROBS = [0.25, 0.5, 0.75]


def robust_scale(df: DataFrame, cols: list[str], quantile_method: str = "refine", cached: DataFrame | None = None) -> DataFrame:
    """M2: ``(x - median) / (q75 - q25)``, a zero IQR divides by 1.

    ``cached``: a persisted frame with the same ``cols`` and rows, whose values then need not be stored once more.
    """
    q = column_quantiles(df if cached is None else cached, cols, ROBUST_PROBS, method=quantile_method)
    out = []
    for c in df.columns:
        if c in q:
            q25, med, q75 = q[c]
            iqr = q75 - q25
            scale = 1.0 if (iqr == 0 or np.isnan(iqr)) else iqr
            out.append(f"(CAST({sq.q(c)} AS DOUBLE) - {sq.d(med)}) / {sq.d(scale)} AS {sq.q(c)}")
        else:
            out.append(sq.q(c))
    return df.selectExpr(*out)


def category_levels(df: DataFrame, cols: list[str]) -> dict[str, list]:
    """Sorted distinct non-null values per column (the encoder's categories).

    Distinct values are found by a grouped count, not merged in one task; a column with more than
    ``MAX_LEVELS`` of them is an error before the rest is fetched.
    """
    levels = {}
    for c in cols:
        found = [r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().limit(MAX_LEVELS + 1).collect()]
        if len(found) > MAX_LEVELS:
            raise ValueError(f"{c} has more than {MAX_LEVELS} levels; one-hot encoding is meant for low-cardinality modes")
        levels[c] = sorted(found)
    return levels


def one_hot(df: DataFrame, cols: list[str], levels: dict[str, list] | None = None
            ) -> tuple[DataFrame, list[str]]:
    """M3: one 0/1 column per level (all levels kept; unseen values -> all zeros)."""
    levels = levels or category_levels(df, cols)
    new_cols, exprs = [], []
    for c in cols:
        for v in levels[c]:
            name = f"{c}={v}"
            new_cols.append(name)
            exprs.append(f"CASE WHEN {sq.q(c)} = {sq.lit(v)} THEN 1.0D ELSE 0.0D END AS {sq.q(name)}")
    keep = [sq.q(c) for c in df.columns if c not in cols]
    return df.selectExpr(*keep, *exprs), new_cols


def assemble(df: DataFrame, cols: list[str], id_col: str = "User_ID", out: str = "x") -> DataFrame:
    """M4: ``id, x`` with ``x`` the dense feature array in the given column order."""
    arr = ", ".join(f"CAST({sq.q(c)} AS DOUBLE)" for c in cols)
    return df.selectExpr(sq.q(id_col), f"array({arr}) AS {sq.q(out)}")


def feature_matrix(feats: DataFrame, quantile_method: str = "refine") -> tuple[DataFrame, list[str]]:
    """M2-M4: ``User_ID, x`` (robust-scaled numeric block, then one-hot block) and column names."""
    numeric, categorical = matrix_columns(feats)
    base = feats.select("User_ID", *numeric, *categorical)
    scaled = robust_scale(base, numeric, quantile_method, cached=feats)
    encoded, hot = one_hot(scaled, categorical)
    names = numeric + hot
    return assemble(encoded, names), names


def covariance_sums(x: DataFrame, d: int, col: str = "x") -> tuple[DataFrame, int, np.ndarray]:
    """``(i, j, s)`` sums of products of the deviations of columns i <= j, the number of rows and the column means.

    Each task adds up the products of its rows; only these d x d partial sums are shuffled. One more pass before it
    gives the means, so that large means do not eat the digits of small variances.
    """
    row = x.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col(col)[i]).alias(f"m{i}") for i in range(d)]).collect()[0]
    n, means = row["n"], np.array([row[f"m{i}"] or 0.0 for i in range(d)])
    ii, jj = np.triu_indices(d)

    def products(batches):
        total = np.zeros((d, d))
        for b in batches:
            v = np.stack(b[col].to_numpy()) - means if len(b) else np.zeros((0, d))
            total += v.T @ v
        yield pd.DataFrame({"i": ii.astype("int32"), "j": jj.astype("int32"), "s": total[ii, jj]})

    sums = x.select(col).mapInPandas(products, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    return sums, n, means


def feature_covariance(x: DataFrame, names: list[str], col: str = "x") -> DataFrame:
    """Sample covariance ``a, b, cov`` of every pair of columns (a at or before b in ``names``)."""
    sums, n, _ = covariance_sums(x, len(names), col)
    name = F.array(*[F.lit(c) for c in names])
    return sums.select(name[F.col("i")].alias("a"), name[F.col("j")].alias("b"), (F.col("s") / F.lit(float(max(n - 1, 1)))).alias("cov"))


@dataclass
class PCAResult:
    n_components: int
    explained: list[float]        # ratio per kept component
    components: np.ndarray        # d x m, sign-fixed
    mean_scores: np.ndarray | None


def pca_by_variance(x: DataFrame, target: float | int, id_col: str = "User_ID", col: str = "x",
                    center: bool = False, keep: list[str] | None = None,
                    d: int | None = None) -> tuple[DataFrame, PCAResult]:
    """M5: project onto the fewest components whose cumulative explained
    variance ratio exceeds ``target`` (an int ``target`` keeps that many).

    The covariance comes from per-task partial sums; of its axes only the wanted ones are worked out
    (``principal.principal_axes``), on the driver, where the d x d table has the size of the columns squared
    (at most ``MAX_LEVELS`` levels a column). Component signs are fixed so each component's largest
    absolute loading is positive. Scores are uncentered unless ``center``
    (distances do not depend on it).
    """
    if d is None:
        d = x.agg(F.max(F.size(col))).collect()[0][0]
    sums, n, means = covariance_sums(x, d, col)
    cov = np.zeros((d, d))
    for i, j, s in sums.collect():
        cov[i, j] = cov[j, i] = s / max(n - 1, 1)
    values, pc = principal_axes(cov, target)
    m, total = len(values), float(np.trace(cov))
    ratios = values / total if total > 0 else np.zeros(m)
    # scores as JVM-side dot products with the (tiny) literal basis
    scores = []
    for j in range(m):
        basis = "array(" + ", ".join(sq.d(v) for v in pc[:, j]) + ")"
        scores.append(f"aggregate(zip_with({sq.q(col)}, {basis}, (a, b) -> a * b), 0.0D, (acc, y) -> acc + y)")
    out = x.selectExpr(sq.q(id_col), *[sq.q(k) for k in (keep or [])], f"array({', '.join(scores)}) AS pca")
    mean_scores = None
    if center:
        mean_scores = means @ pc
        out = out.select(F.col(id_col), *(keep or []),
                         F.array(*[F.col("pca")[j] - F.lit(float(mean_scores[j])) for j in range(m)]).alias("pca"))
    return out, PCAResult(m, [float(r) for r in ratios], pc, mean_scores)


def pca_projection(x: DataFrame, labels: DataFrame | None = None, n: int = 3, id_col: str = "User_ID"
                   ) -> tuple[DataFrame, PCAResult]:
    """M6: centred 2-D / 3-D coordinates (``pc1..pcn``) with the optional cluster label."""
    proj, res = pca_by_variance(x, n, id_col=id_col, center=True)
    out = proj.select(F.col(id_col), *[F.col("pca")[j].alias(f"pc{j + 1}") for j in range(res.n_components)])
    if labels is not None:
        out = out.join(labels, id_col, "left")
    return out, res

