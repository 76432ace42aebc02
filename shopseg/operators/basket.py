"""Baskets and item co-occurrence.

All mining levels (whole table, product level, each segment) run in one plan:
every row carries its ``level`` and every grouping includes it.

Co-occurrence (how many basket users hold both items) is the Gram matrix
``BᵀB`` of the users x kept-items 0/1 matrix. Instead of a self-join that
would emit every item pair of every basket as a row, the basket is hash
partitioned by user, sorted within partitions, and each task accumulates
``BᵀB`` over dense chunks of its users with one BLAS product per chunk. Only
the per-task partial matrices (at most ``kept items²/2`` entries per level and
task) are shuffled and summed. When a level keeps more than ``tile`` items the
item axis is cut into tiles and each row is sent to the tile pairs it belongs
to, so the accumulator of a task stays ``tile x tile`` whatever the item count.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopseg.functions.numbering import numbered

BROADCAST_ROWS = 2_000_000   # broadcast a side only below this many rows (counted first)


def checked_broadcast(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when the counted row number is under ``limit``."""
    return F.broadcast(df) if rows <= limit else df


def level_rows(df: DataFrame, level, item_col: str, user_col: str = "User_ID") -> DataFrame:
    """``(level, User_ID, item)`` rows for one level definition (level may be a column)."""
    lv = level if isinstance(level, F.Column) else F.lit(level)
    return df.select(lv.cast("string").alias("level"), F.col(user_col).alias("User_ID"),
                     F.col(item_col).cast("string").alias("item"))


@dataclass
class Basket:
    """Everything ``build_basket`` derives for a set of levels."""
    users: DataFrame        # level, n_users (non-null item holders), base_users
    item_counts: DataFrame  # level, item, user_count (all items)
    kept: DataFrame         # level, item, user_count, idx (kept items only)
    basket: DataFrame       # level, User_ID, item, idx  (distinct, kept items only)
    basket_users: DataFrame  # level, U
    thresholds: DataFrame   # level, threshold
    kept_sizes: dict        # level -> number of kept items (driver side, small)


def build_basket(rows: DataFrame, params: DataFrame, need_base_users: bool | None = None) -> Basket:
    """R1 for every level of ``rows`` at once.

    ``rows``: ``level, User_ID, item``. ``params``: one row per level with
    ``min_support`` (fraction), ``min_users_abs`` (nullable), ``top_n``
    (nullable) and ``use_base_users`` (threshold base = all users of the level
    incl. those with only NULL items -- the per-segment rule -- instead of
    item holders).

    threshold = max(1, ceil(min_support * base), min_users_abs), computed in
    double arithmetic as the reference does. The all-rows user count (one more
    pass) is only computed when some level uses it (``need_base_users``;
    looked up in the small params table when not given).
    """
    if need_base_users is None:
        need_base_users = bool(params.where(F.col("use_base_users")).limit(1).count())
    base = rows.where(F.col("User_ID").isNotNull())
    sub = (base.where(F.col("item").isNotNull()).select("level", "User_ID", "item").distinct()
           .persist(StorageLevel.MEMORY_AND_DISK))
    users = sub.groupBy("level").agg(F.count_distinct("User_ID").alias("n_users"))
    if need_base_users:
        base_users = base.groupBy("level").agg(F.count_distinct("User_ID").alias("base_users"))
        users = users.join(base_users, "level", "left")
    else:
        users = users.withColumn("base_users", F.col("n_users"))
    item_counts = sub.groupBy("level", "item").agg(F.count(F.lit(1)).alias("user_count"))

    p = params.select("level", "min_support", "min_users_abs", "top_n", "use_base_users")
    thr = users.join(F.broadcast(p), "level").select(
        "level",
        F.greatest(
            F.lit(1).cast("long"),
            F.ceil(F.coalesce(F.col("min_support"), F.lit(0.0)).cast("double")
                   * F.when(F.col("use_base_users"), F.col("base_users")).otherwise(F.col("n_users"))
                   .cast("double")).cast("long"),
            F.coalesce(F.col("min_users_abs"), F.lit(0)).cast("long"),
        ).alias("threshold"),
        "top_n")
    # Top-N by user count, ties by item; the threshold bounds the group first. Places are counted over
    # range partitions, so a level with most of the items is no task of its own.
    enough = item_counts.join(F.broadcast(thr), "level").where(F.col("user_count") >= F.col("threshold"))
    if params.where(F.col("top_n").isNotNull()).limit(1).count():  # a row per level
        ranked = numbered(enough, ["level", F.desc("user_count"), "item"], "_rank", by=["level"])
        enough = ranked.where(F.col("top_n").isNull() | (F.col("_rank") < F.col("top_n")))
    kept = numbered(enough.select("level", "item", "user_count"), ["level", "item"], "idx", by=["level"]) \
        .withColumn("idx", F.col("idx").cast("int")).persist(StorageLevel.MEMORY_AND_DISK)
    kept_sizes = {r["level"]: r["n"] for r in kept.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}
    total_kept = sum(kept_sizes.values())
    small = checked_broadcast(kept.select("level", "item", "idx"), total_kept)
    basket = sub.join(small, ["level", "item"]).select("level", "User_ID", "item", "idx")
    basket_users = basket.groupBy("level").agg(F.count_distinct("User_ID").alias("U"))
    return Basket(users, item_counts, kept, basket, basket_users, thr.select("level", "threshold"),
                  kept_sizes)


# ---------------------------------------------------------------------------
# Co-occurrence by per-task Gram matrices
# ---------------------------------------------------------------------------

COOC_SCHEMA = "level string, a int, b int, co long"


def _gram_partition(tile: int, chunk_users: int):
    """mapInPandas body: rows sorted by (level, ta, tb, User_ID) -> partial BᵀB entries."""

    def flush(key, acc):
        if acc is None:
            return
        level, ta, tb = key
        if ta == tb:
            ii, jj = np.triu_indices(acc.shape[0], k=1)
        else:
            ii, jj = np.indices(acc.shape).reshape(2, -1)
        vals = acc[ii, jj]
        nz = vals > 0
        if nz.any():
            yield pd.DataFrame({
                "level": level,
                "a": (ii[nz] + ta * tile).astype("int32"),
                "b": (jj[nz] + tb * tile).astype("int32"),
                "co": vals[nz].astype("int64"),
            })

    def add_chunk(pdf, acc, ta, tb):
        users, ucode = np.unique(pdf["User_ID"].to_numpy(), return_inverse=True)
        for start in range(0, len(users), chunk_users):
            sel = (ucode >= start) & (ucode < start + chunk_users)
            part = pdf[sel]
            codes = ucode[sel] - start
            rows = min(chunk_users, len(users) - start)
            local = part["idx"].to_numpy()
            in_a = (local // tile) == ta
            in_b = (local // tile) == tb
            ba = np.zeros((rows, tile), dtype=np.float32)
            ba[codes[in_a], local[in_a] - ta * tile] = 1.0
            if ta == tb:
                bb = ba
            else:
                bb = np.zeros((rows, tile), dtype=np.float32)
                bb[codes[in_b], local[in_b] - tb * tile] = 1.0
            acc += (ba.T @ bb).astype(np.int64)

    def run(batches):
        key, acc = None, None
        carry = None
        for pdf in batches:
            if carry is not None and len(carry):
                pdf = pd.concat([carry, pdf], ignore_index=True)
            if not len(pdf):
                continue
            # keep the last user's rows for the next batch: a user must be whole in a chunk
            last = pdf.iloc[-1]
            tail = ((pdf["level"] == last["level"]) & (pdf["ta"] == last["ta"])
                    & (pdf["tb"] == last["tb"]) & (pdf["User_ID"] == last["User_ID"]))
            carry, work = pdf[tail], pdf[~tail]
            for gkey, g in work.groupby(["level", "ta", "tb"], sort=False):
                if gkey != key:
                    yield from flush(key, acc)
                    key, acc = gkey, np.zeros((tile, tile), dtype=np.int64)
                add_chunk(g, acc, int(gkey[1]), int(gkey[2]))
        if carry is not None and len(carry):
            for gkey, g in carry.groupby(["level", "ta", "tb"], sort=False):
                if gkey != key:
                    yield from flush(key, acc)
                    key, acc = gkey, np.zeros((tile, tile), dtype=np.int64)
                add_chunk(g, acc, int(gkey[1]), int(gkey[2]))
        yield from flush(key, acc)

    return run


def cooccurrence(basket: DataFrame, kept_sizes: dict, tile: int = 2048,
                 chunk_users: int = 4096) -> DataFrame:
    """``level, a, b, co`` for item indices ``a < b`` held together by ``co > 0`` users."""
    max_items = max(kept_sizes.values(), default=0)
    if max_items < 2:
        return basket.sparkSession.createDataFrame([], COOC_SCHEMA)
    tile = min(tile, max(max_items, 1))
    n_tiles = math.ceil(max_items / tile)
    b = basket.select("level", "User_ID", "idx", (F.col("idx") / F.lit(tile)).cast("int").alias("t"))
    if n_tiles == 1:
        b = b.withColumn("ta", F.lit(0)).withColumn("tb", F.lit(0))
    else:
        # each row joins the tile pairs (t, u) for u >= t and (u, t) for u < t
        others = F.sequence(F.lit(0), F.lit(n_tiles - 1))
        b = (b.withColumn("u", F.explode(others))
              .withColumn("ta", F.least("t", "u")).withColumn("tb", F.greatest("t", "u")))
    parts = b.select("level", "ta", "tb", "User_ID", "idx")
    # hash by (level, user): a user's basket is whole in one task; the partition count is left to
    # spark.sql.shuffle.partitions and AQE coalescing
    ordered = parts.repartition("level", "User_ID").sortWithinPartitions("level", "ta", "tb", "User_ID")
    partial = ordered.mapInPandas(_gram_partition(tile, chunk_users), COOC_SCHEMA)
    return partial.groupBy("level", "a", "b").agg(F.sum("co").cast("long").alias("co"))
