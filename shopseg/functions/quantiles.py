"""Exact, linearly interpolated column quantiles that scale with the data.

pandas / NumPy quantiles interpolate linearly between the order statistics at
ranks ``floor((n-1)p)`` and the next one. Spark's ``percentile`` aggregate gives
the same numbers, but its final merge keeps a value -> count map of *every*
distinct value of a column in one task, which does not hold for a column with
10^9 distinct values.

``column_quantiles`` therefore selects by histogram refinement, at every size:
each round is one grouped count over the long ``(column, value)`` table,
bucketing only the values inside each target's current bracket into ``bins``
equal-width bins and keeping the bin that holds the target rank (bin bounds are
taken from the data's own min/max per bin, so no rounding error enters). A
bracket of at most ``finish`` rows is finished by running counts over its
distinct values, filtered to the asked ranks. The driver only ever receives
``columns x targets x bins`` rows per round, and one value per target at the end.
``method="spark"`` (the built-in aggregate) and ``"approx"`` are there to compare.

Heavy duplicates are harmless: equal values always share a bin, and a bracket
whose min equals its max is resolved at once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopseg.functions import sqltext as sq


@dataclass
class _Bracket:
    ci: int
    lo: float
    hi: float
    offset: int          # number of values below ``lo`` in the column
    count: int           # number of values in [lo, hi]
    ranks: set = field(default_factory=set)


def _long_values(df: DataFrame, cols: list[str]) -> DataFrame:
    structs = ", ".join(f"named_struct('ci', CAST({i} AS BIGINT), 'v', CAST({sq.q(c)} AS DOUBLE))"
                        for i, c in enumerate(cols))
    return (df.selectExpr(f"inline(array({structs}))")
              .where("v IS NOT NULL AND NOT isnan(v)"))


def _interp(lo_v: float, hi_v: float, t: float) -> float:
    if t == 0.0 or lo_v == hi_v:
        return float(lo_v)
    return float(lo_v + (hi_v - lo_v) * t)


def quantile_stat_columns(cols: list[str]) -> list[str]:
    """Aggregate expressions (SQL text: count, min, max per column) a caller can
    fold into one of its own aggregates and pass back as ``stats_row``."""
    return [x for i, c in enumerate(cols) for x in (
        f"count({sq.valid(c)}) AS __qn{i}", f"min({sq.valid(c)}) AS __qlo{i}", f"max({sq.valid(c)}) AS __qhi{i}")]


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float], *,
                     method: str = "refine", bins: int = 1024, finish: int = 20_000,
                     accuracy: int = 1_000_000, stats_row=None) -> dict[str, list[float]]:
    """Quantiles of each column at ``probs``; NULL and NaN are ignored.

    ``method``: ``"refine"`` (exact), ``"spark"`` (the built-in exact aggregate)
    or ``"approx"`` (``percentile_approx``).
    """
    cols = list(cols)
    probs = [float(p) for p in probs]
    if not cols:
        return {}
    if method == "approx":
        row = df.agg(*[
            F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(f"q{i}")
            for i, c in enumerate(cols)]).collect()[0]
        return {c: [float("nan") if v is None else float(v) for v in (row[f"q{i}"] or [None] * len(probs))]
                for i, c in enumerate(cols)}

    if method == "spark":
        return _builtin(df, cols, probs)
    row = stats_row if stats_row is not None else df.selectExpr(*quantile_stat_columns(cols)).collect()[0]
    stats = {i: (row[f"__qn{i}"], row[f"__qlo{i}"], row[f"__qhi{i}"]) for i in range(len(cols))
             if row[f"__qn{i}"]}
    long = _long_values(df, cols)
    cached = df.is_cached                     # rounds re-scan a cheap projection of a cached input
    if not cached:
        long = long.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _refine(long, cols, probs, stats, bins, finish)
    finally:
        if not cached:
            long.unpersist()


def _builtin_columns(cols: list[str], probs: list[float]) -> list[str]:
    """``percentile`` aggregate expressions (SQL text, aliases ``q<i>``)."""
    arr = "array(" + ", ".join(sq.d(p) for p in probs) + ")"
    return [f"percentile({sq.valid(c)}, {arr}) AS q{i}" for i, c in enumerate(cols)]


def _builtin(df: DataFrame, cols, probs) -> dict[str, list[float]]:
    row = df.selectExpr(*_builtin_columns(cols, probs)).collect()[0]
    out = {}
    for i, c in enumerate(cols):
        q = row[f"q{i}"]
        out[c] = [float("nan")] * len(probs) if q is None else [float(v) for v in q]
    return out


def _refine_keys(long: DataFrame, stats: dict, probs, bins: int, finish: int) -> dict:
    """Exact quantiles of ``v`` per key ``ci`` of a long table; ``stats``: key -> (n, min, max)."""
    spark = long.sparkSession
    plan: dict = {}
    brackets: list[_Bracket] = []
    for ci, (n, lo, hi) in stats.items():
        if not n:
            continue
        wanted = []
        for p in probs:
            h = (n - 1) * p
            r0 = int(math.floor(h))
            r1 = min(r0 + 1, n - 1)
            wanted.append((r0, r1, h - r0))
        plan[ci] = wanted
        brackets.append(_Bracket(ci, lo, hi, 0, n, {r for w in wanted for r in w[:2]}))

    resolved: dict[tuple[int, int], float] = {}
    for _round in range(200):
        if not brackets:
            break
        done = [b for b in brackets if b.lo == b.hi]
        for b in done:
            for r in b.ranks:
                resolved[(b.ci, r)] = float(b.lo)
        small = [b for b in brackets if b.lo < b.hi and b.count <= finish]
        big = [b for b in brackets if b.lo < b.hi and b.count > finish]
        if small:
            # running counts over each bracket's distinct values (at most `finish` of them); only the values
            # at the asked ranks come back
            bt = spark.createDataFrame([(i, b.ci, b.lo, b.hi) for i, b in enumerate(small)],
                                       "bid int, bci bigint, blo double, bhi double")
            rt = spark.createDataFrame([(i, rank - b.offset, rank) for i, b in enumerate(small) for rank in sorted(b.ranks)],
                                       "bid int, local bigint, rank bigint")
            counts = (long.join(F.broadcast(bt), (F.col("ci") == F.col("bci"))
                                & (F.col("v") >= F.col("blo")) & (F.col("v") <= F.col("bhi")))
                          .groupBy("bid", "v").agg(F.count("*").alias("n")))
            upto = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("bid").orderBy("v")))
            for r in (upto.join(F.broadcast(rt), "bid")
                          .where((F.col("local") < F.col("upto")) & (F.col("local") >= F.col("upto") - F.col("n")))
                          .select("bid", "rank", "v").collect()):
                resolved[(small[r["bid"]].ci, r["rank"])] = float(r["v"])
        nxt: list[_Bracket] = []
        if big:
            bt = spark.createDataFrame([(i, b.ci, b.lo, b.hi) for i, b in enumerate(big)],
                                       "bid int, bci bigint, blo double, bhi double")
            binned = F.least(
                F.floor((F.col("v") - F.col("blo")) / (F.col("bhi") - F.col("blo")) * F.lit(float(bins))),
                F.lit(bins - 1)).cast("int")
            rows = (long.join(F.broadcast(bt), (F.col("ci") == F.col("bci"))
                              & (F.col("v") >= F.col("blo")) & (F.col("v") <= F.col("bhi")))
                        .groupBy("bid", binned.alias("bin"))
                        .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
                        .collect())
            per_b: dict[int, list] = {}
            for r in rows:
                per_b.setdefault(r["bid"], []).append((r["bin"], r["n"], r["lo"], r["hi"]))
            for i, b in enumerate(big):
                hist = sorted(per_b.get(i, []))
                children: dict[int, _Bracket] = {}
                for rank in b.ranks:
                    local = rank - b.offset
                    acc = 0
                    for j, cnt, lo, hi in hist:
                        if local < acc + cnt:
                            child = children.get(j)
                            if child is None:
                                child = _Bracket(b.ci, lo, hi, b.offset + acc, cnt, set())
                                children[j] = child
                            child.ranks.add(rank)
                            break
                        acc += cnt
                nxt.extend(children.values())
        brackets = nxt

    return {ci: [_interp(resolved[(ci, r0)], resolved[(ci, r1)], t) for r0, r1, t in wanted]
            for ci, wanted in plan.items()}


def _refine(long: DataFrame, cols, probs, stats, bins: int, finish: int) -> dict[str, list[float]]:
    got = _refine_keys(long, stats, probs, bins, finish)
    return {c: got.get(i, [float("nan")] * len(probs)) for i, c in enumerate(cols)}


def quantile_bounds(df: DataFrame, cols: list[str], q_low: float, q_high: float,
                    **kw) -> dict[str, tuple[float, float]]:
    """``{col: (q_low quantile, q_high quantile)}``."""
    got = column_quantiles(df, cols, [q_low, q_high], **kw)
    return {c: (v[0], v[1]) for c, v in got.items()}


def quantiles_by_key(long: DataFrame, probs: list[float], *, method: str = "refine",
                     bins: int = 1024, finish: int = 20_000, cached: bool = False) -> dict:
    """Exact quantiles of ``v`` for every key ``ci`` of a long ``(ci bigint, v double)`` table.

    The number of keys must be bounded (they come back to the driver); the
    number of values per key is not. ``cached``: ``long`` is a cheap projection of
    a persisted frame, so that it need not be stored itself.
    """
    long = long.where("v IS NOT NULL AND NOT isnan(v)")
    stats = {r["ci"]: (r["n"], r["lo"], r["hi"]) for r in
             long.groupBy("ci").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
             .collect()}
    if not stats:
        return {}
    if method == "spark":
        arr = F.array(*[F.lit(float(p)) for p in probs])
        return {r["ci"]: [float(x) for x in r["q"]]
                for r in long.groupBy("ci").agg(F.percentile("v", arr).alias("q")).collect()}
    if cached:
        return _refine_keys(long, stats, probs, bins, finish)
    persisted = long.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _refine_keys(persisted, stats, probs, bins, finish)
    finally:
        persisted.unpersist()


def grouped_quantiles(df: DataFrame, group_col: str, cols: list[str], probs: list[float],
                      **kw) -> dict[tuple, list[float]]:
    """Quantiles of each column within each group (few groups, e.g. cluster labels).

    Each (group, column) pair is one key of a long table, so a group holding
    most rows is refined like any large column instead of being merged in one task.
    """
    groups = [r[0] for r in df.select(group_col).distinct().orderBy(group_col).collect()]
    if not groups:
        return {}
    gi = {g: i for i, g in enumerate(groups)}
    idx = "element_at(map(" + ", ".join(f"{sq.lit(g)}, {i}" for g, i in gi.items()) + f"), {sq.q(group_col)})"
    nc = len(cols)
    structs = ", ".join(f"named_struct('ci', CAST({idx} AS BIGINT) * {nc} + {j}, 'v', {sq.valid(c)})"
                        for j, c in enumerate(cols))
    long = df.selectExpr(f"inline(array({structs}))")
    got = quantiles_by_key(long, probs, cached=df.is_cached, **kw)
    nan = [float("nan")] * len(probs)
    return {(g, c): got.get(i * nc + j, nan) for g, i in gi.items() for j, c in enumerate(cols)}
