"""Rule-mining levels (R6-R9, U3, S5, J2): every level in one plan.

The reference loops over levels (whole-table categories, products, then each
segment) and reruns the basket and rule code per level. Here the levels are
rows: each transaction row is tagged with its level(s), parameters are a small
per-level table, and the basket / co-occurrence / rules plans group by
``level``. Segment levels come from joining the assignments (J2) and use the
segment's user count as the support base, with an absolute floor.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopseg.operators.basket import Basket, build_basket, level_rows
from shopseg.operators.rules import directed_rules, pair_rules, run_summary


@dataclass(frozen=True)
class LevelSpec:
    """One mining level family; ``segment=True`` expands to one level per segment."""
    name: str
    item_col: str
    min_support: float
    min_conf: float
    min_lift: float
    top_n: int | None = None
    min_users_abs: int | None = None
    segment: bool = False
    mode: str = "PAIR"          # "PAIR" (1 -> 1 rules) or "ITEMSETS" (frequent itemsets -> rules)
    max_len: int = 3


# Reference production profile (fixed values).
CATEGORY = LevelSpec("category", "Product_Category_str", 0.04, 0.35, 1.25)
PRODUCT = LevelSpec("product", "Product_ID", 0.02, 0.35, 1.30, top_n=40)
SEGMENT_CATEGORY = LevelSpec("category", "Product_Category_str", 0.05, 0.35, 1.25,
                             min_users_abs=40, segment=True)
SAVE_TOP_N = 200

PARAM_SCHEMA = ("level string, min_support double, min_conf double, min_lift double, "
                "top_n int, min_users_abs int, use_base_users boolean, mode string, max_len int")


def segment_level(cluster_col: str, name: str) -> F.Column:
    return F.concat(F.lit("cluster_"), F.col(cluster_col).cast("string"), F.lit(f"_{name}"))


def level_inputs(tx: DataFrame, specs: list[LevelSpec], assignments: DataFrame | None = None,
                 user_col: str = "User_ID") -> tuple[DataFrame, DataFrame]:
    """``(rows, params)`` for the given level families.

    Segment families are skipped (S5) when ``assignments`` is None.
    """
    spark = tx.sparkSession
    rows, params = [], []
    for s in specs:
        if s.segment:
            if assignments is None:
                continue
            a = assignments.select(F.col(user_col), F.col("cluster"))
            joined = tx.join(a, user_col, "inner")               # J2
            lv = segment_level("cluster", s.name)
            rows.append(level_rows(joined, lv, s.item_col, user_col))
            # the levels there are: of segments with transactions
            params.append(joined.select(lv.alias("level")).distinct().select(
                "level", F.lit(s.min_support).alias("min_support"), F.lit(s.min_conf).alias("min_conf"),
                F.lit(s.min_lift).alias("min_lift"), F.lit(s.top_n).cast("int").alias("top_n"),
                F.lit(s.min_users_abs).cast("int").alias("min_users_abs"),
                F.lit(True).alias("use_base_users"), F.lit(s.mode).alias("mode"),
                F.lit(s.max_len).alias("max_len")))
        else:
            rows.append(level_rows(tx, s.name, s.item_col, user_col))
            params.append(spark.createDataFrame(
                [(s.name, s.min_support, s.min_conf, s.min_lift, s.top_n, s.min_users_abs, False, s.mode,
                  s.max_len)],
                PARAM_SCHEMA))
    all_rows = rows[0]
    for r in rows[1:]:
        all_rows = all_rows.unionByName(r)
    all_params = params[0]
    for p in params[1:]:
        all_params = all_params.unionByName(p)
    return all_rows, all_params


@dataclass
class Mined:
    basket: Basket
    params: DataFrame
    rules: DataFrame          # pair mode: one direction per pair
    directed: DataFrame       # pair mode: every passing direction
    summary: DataFrame
    itemset_rules: DataFrame | None = None   # itemset mode levels


def mine_levels(tx: DataFrame, specs: list[LevelSpec], assignments: DataFrame | None = None,
                user_col: str = "User_ID") -> Mined:
    """Mining of every level family, plus the run summary (K3).

    Pair-mode levels share one plan, and so do itemset-mode levels (each with
    its own ``min_support`` and ``max_len``); the summary counts the rules of
    the mode each level ran in.
    """
    # every level reads the rows, and the users and segments are counted from them, too: they are worked out once, a user's
    # rows together, so that little is left of them in each of those aggregates
    items = list(dict.fromkeys(s.item_col for s in specs))
    tx = tx.select(user_col, *items).hint("rebalance", user_col).persist(StorageLevel.MEMORY_AND_DISK)
    rows, params = level_inputs(tx, specs, assignments, user_col)
    params = params.cache()
    bk = build_basket(rows, params, need_base_users=assignments is not None and any(s.segment for s in specs))
    pair_params = params.where(F.col("mode") == "PAIR")
    rules = pair_rules(bk, pair_params)
    directed = directed_rules(bk, pair_params)
    counted = rules.select("level")
    item_rules = None
    if any(s.mode == "ITEMSETS" for s in specs):
        from shopseg.operators.rules import frequent_itemsets_by_level, itemset_rules
        sets = frequent_itemsets_by_level(bk, params.where(F.col("mode") == "ITEMSETS"))
        item_rules = itemset_rules(sets, bk.basket_users, params)
        counted = counted.unionByName(item_rules.select("level"))
    summary = run_summary(params, bk, counted)
    return Mined(bk, params, rules, directed, summary, item_rules)


def production_levels(tx: DataFrame, assignments: DataFrame | None = None) -> Mined:
    """The reference's production run: categories, top-40 products, categories per segment."""
    return mine_levels(tx, [CATEGORY, PRODUCT, SEGMENT_CATEGORY], assignments)
