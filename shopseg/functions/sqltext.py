"""SQL-text helpers for wide projections and aggregates.

Building one Column object per feature costs a driver round trip per call;
for tables with dozens of feature columns the expressions are written as SQL
text and handed to ``selectExpr`` / ``F.expr`` in one call instead. The
expressions are the same built-in functions either way.
"""

from __future__ import annotations

import math


def q(name: str) -> str:
    """Quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def d(v: float) -> str:
    """Double literal (exact round trip, NaN / infinities included)."""
    v = float(v)
    if math.isnan(v):
        return "CAST('NaN' AS DOUBLE)"
    if math.isinf(v):
        return "CAST('Infinity' AS DOUBLE)" if v > 0 else "CAST('-Infinity' AS DOUBLE)"
    return f"CAST('{v!r}' AS DOUBLE)"


def s(v: str) -> str:
    """String literal."""
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def lit(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return d(v)
    return s(v)


def clip(col: str, lo: float | None, hi: float | None) -> str:
    """NULL-preserving clip of a column to ``[lo, hi]`` as double."""
    x = f"CAST({q(col)} AS DOUBLE)"
    e = x
    if lo is not None and not math.isnan(lo):
        e = f"greatest({e}, {d(lo)})"
    if hi is not None and not math.isnan(hi):
        e = f"least({e}, {d(hi)})"
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE {e} END"


def valid(col: str) -> str:
    """The column as double with NaN read as NULL."""
    x = f"CAST({q(col)} AS DOUBLE)"
    return f"CASE WHEN isnan({x}) THEN NULL ELSE {x} END"
