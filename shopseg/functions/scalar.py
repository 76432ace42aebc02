"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's results.
# Tokens a pandas CSV read treats as missing in text columns.
PANDAS_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                    "n/a", "nan", "null"]
CATEGORY_PREFIX = "cat_"
UNKNOWN_CATEGORY = "cat_unknown"
OTHER_CATEGORY = "cat_other"
UNKNOWN_LEVEL = "Unknown"
ENTROPY_FLOOR = 1e-12


def na_to_null(c: Column) -> Column:
    """Text cell -> NULL when pandas would read it as missing."""
    return F.when(c.isin(PANDAS_NA_TOKENS), F.lit(None)).otherwise(c)


def strip_plus_to_int(c: Column) -> Column:
    """``"4+"`` -> 4, ``"2.0"`` -> 2, junk and fractions -> NULL (tinyint)."""
    f = _try_cast(F.trim(F.replace(c.cast("string"), F.lit("+"), F.lit(""))), "double")
    return F.when(F.isnan(f) | (f != F.floor(f)), F.lit(None)).otherwise(_try_cast(f, "tinyint"))


def _try_cast(c: Column, to: str) -> Column:
    return c.try_cast(to)


def coerce_category(c: Column) -> Column:
    """Text or number -> smallint; non-numeric and non-integral -> NULL.

    NaN is treated as missing, as pandas does; a fractional value is treated as
    unknown instead of being truncated (pandas refuses the cast).
    """
    f = _try_cast(c.cast("string"), "float")
    return (F.when(f.isNull() | F.isnan(f) | (f != F.floor(f)), F.lit(None))
            .otherwise(_try_cast(f, "smallint")))


def category_label(code: Column) -> Column:
    """``cat_<n>`` or ``cat_unknown``."""
    return F.concat(F.lit(CATEGORY_PREFIX), F.coalesce(code.cast("string"), F.lit("unknown")))


def fill_purchase(c: Column) -> Column:
    """P5: rounded through float32 as the reference's read does, NULL/NaN -> 0, then double."""
    f = c.cast("float")
    return F.when(f.isNull() | F.isnan(f), F.lit(0.0)).otherwise(f.cast("double"))


def clip(c: Column, lo: float | None, hi: float | None) -> Column:
    """clip to [lo, hi]; NULL stays NULL."""
    out = c
    if lo is not None:
        out = F.when(out.isNull(), out).otherwise(F.greatest(out, F.lit(float(lo))))
    if hi is not None:
        out = F.when(out.isNull(), out).otherwise(F.least(out, F.lit(float(hi))))
    return out


def pair_key(a: Column, b: Column) -> Column:
    """F8: unordered pair key."""
    return F.struct(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))


def itemset_text(items: Column) -> Column:
    """``", "``-joined sorted items."""
    return F.array_join(F.array_sort(items), ", ")
