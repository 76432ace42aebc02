import pytest
from pyspark.sql import functions as F

from shopseg.operators.basket import build_basket, cooccurrence
from shopseg.operators.rules import (directed_rules, frequent_itemsets, frequent_itemsets_apriori,
                                     itemset_rules, pair_rules, top_rules)
from shopseg.plans.levels import LevelSpec, level_inputs, mine_levels

BASKETS = {1: ["A", "B"], 2: ["A", "B"], 3: ["A"], 4: ["B", "C"], 5: ["A", "B", "C"], 6: ["D"], 7: [None]}


def _lines(spark):
    rows = [(u, i) for u, items in BASKETS.items() for i in items]
    rows += [(1, "A")]  # a repeated line must not count twice
    return spark.createDataFrame(rows, "User_ID int, item string")


def _mine(spark, conf, lift):
    return mine_levels(_lines(spark), [LevelSpec("t", "item", 0.3, conf, lift)])


def test_fixture_counts_and_metrics(spark):
    m = _mine(spark, 0.5, 0.9)
    thr = m.basket.thresholds.collect()[0].threshold
    assert thr == 2
    kept = {r.item: r.user_count for r in m.basket.kept.collect()}
    assert kept == {"A": 4, "B": 4, "C": 2}
    assert m.basket.basket_users.collect()[0].U == 5
    d = {(r.antecedent, r.consequent): r for r in m.directed.collect()}
    assert set(d) == {("A", "B"), ("B", "A"), ("B", "C"), ("C", "B")}
    ab = d[("A", "B")]
    assert (ab.support, ab.confidence, ab.lift) == pytest.approx((0.6, 0.75, 0.9375))
    assert (d[("C", "B")].confidence, d[("C", "B")].lift) == pytest.approx((1.0, 1.25))
    rules = {(r.antecedent, r.consequent) for r in m.rules.collect()}
    assert rules == {("A", "B"), ("C", "B")}
    s = m.summary.collect()[0]
    assert (s.n_users, s.n_items, s.n_rules, s["mode"]) == (6, 3, 2, "PAIR")


def test_empty_rules_keep_summary_row(spark):
    m = _mine(spark, 0.5, 2.0)
    assert m.rules.count() == 0
    s = m.summary.collect()[0]
    assert s.n_rules == 0 and s.n_items == 3


def test_filter_precedes_dedupe(spark):
    # conf >= 0.8: only C->B passes; B->C fails but the pair survives through C->B
    m = _mine(spark, 0.8, 0.0)
    assert {(r.antecedent, r.consequent) for r in m.rules.collect()} == {("C", "B")}


def test_cooccurrence_tiles_agree(spark):
    from tests.conftest import SF001
    from shopseg.sources.transactions import basket_lines
    rows, params = level_inputs(basket_lines(spark, SF001), [LevelSpec("c", "category_item", 0.0, 0.0, 0.0)])
    bk = build_basket(rows, params)
    one = {(r.a, r.b): r.co for r in cooccurrence(bk.basket, bk.kept_sizes).collect()}
    tiled = {(r.a, r.b): r.co for r in cooccurrence(bk.basket, bk.kept_sizes, tile=16, chunk_users=7).collect()}
    assert one == tiled and len(one) > 1000
    # brute force on the driver (small fixture only)
    b = {}
    for r in bk.basket.collect():
        b.setdefault(r.User_ID, set()).add(r.idx)
    brute = {}
    for items in b.values():
        s = sorted(items)
        for i, x in enumerate(s):
            for y in s[i + 1:]:
                brute[(x, y)] = brute.get((x, y), 0) + 1
    assert brute == one


def test_rule_invariants_and_top(spark):
    from tests.conftest import SF001
    from shopseg.sources.transactions import basket_lines
    m = mine_levels(basket_lines(spark, SF001), [LevelSpec("category", "category_item", 0.04, 0.35, 1.25)])
    rules = m.rules.collect()
    assert len(rules) == 883
    assert m.directed.count() == 1090
    assert all(r.confidence <= 1 + 1e-12 for r in rules)
    keys = [tuple(sorted((r.antecedent, r.consequent))) for r in rules]
    assert len(keys) == len(set(keys))
    top = top_rules(m.rules, 200).collect()
    assert len(top) == 200
    lifts = [r.lift for r in sorted(top, key=lambda r: r["rank"])]
    assert lifts == sorted(lifts, reverse=True)


def test_itemsets_fpgrowth_equals_apriori_and_rules(spark):
    from tests.conftest import SF001
    from shopseg.sources.transactions import basket_lines
    rows, params = level_inputs(basket_lines(spark, SF001), [LevelSpec("category", "category_item", 0.04, 0.35, 1.25)])
    bk = build_basket(rows, params)
    fp = {(tuple(r["items"]), r.freq) for r in frequent_itemsets(bk, "category", 0.1, 3).collect()}
    ap = {(tuple(r["items"]), r.freq) for r in frequent_itemsets_apriori(bk, "category", 0.1, 3).collect()}
    assert fp == ap and any(len(i) == 3 for i, _ in fp)
    # max_len 2 itemset rules == directed pair rules restricted to frequent pairs
    pairs2 = frequent_itemsets(bk, "category", 0.1, 2)
    ir = {(r.antecedent, r.consequent) for r in itemset_rules(pairs2, bk.basket_users, params).collect()}
    d = directed_rules(bk, params).where(F.col("support") >= 0.1)
    assert ir == {(r.antecedent, r.consequent) for r in d.collect()}


def test_itemset_rule_metrics_by_hand(spark):
    from shopseg.operators.rules import itemset_rules
    sets = spark.createDataFrame([("t", ["A"], 4), ("t", ["B"], 4), ("t", ["C"], 2), ("t", ["A", "B"], 3),
                                  ("t", ["B", "C"], 2)], "level string, items array<string>, freq long")
    users = spark.createDataFrame([("t", 5)], "level string, U long")
    params = spark.createDataFrame([("t", 0.0, 0.0)], "level string, min_conf double, min_lift double")
    r = {(x.antecedent, x.consequent): x for x in itemset_rules(sets, users, params).collect()}
    assert set(r) == {("A", "B"), ("B", "A"), ("B", "C"), ("C", "B")}
    cb = r[("C", "B")]
    assert (cb.support, cb.confidence, cb.lift) == pytest.approx((0.4, 1.0, 1.25))
    assert cb.leverage == pytest.approx(0.4 - 0.4 * 0.8) and cb.conviction == float("inf")
    ab = r[("A", "B")]
    assert ab.conviction == pytest.approx((1 - 0.8) / (1 - 0.75))
    assert list(ab.antecedents) == ["A"] and ab.consequent == "B"


def test_itemset_mode_level(spark):
    from tests.conftest import SF001
    from shopseg.sources.transactions import basket_lines
    specs = [LevelSpec("category", "category_item", 0.1, 0.35, 1.25, mode="ITEMSETS"),
             LevelSpec("product", "product_item", 0.02, 0.03, 1.30, top_n=40)]
    m = mine_levels(basket_lines(spark, SF001), specs)
    s = {r.level: r for r in m.summary.collect()}
    assert s["category"]["mode"] == "ITEMSETS" and s["product"]["mode"] == "PAIR"
    assert s["category"].n_rules == m.itemset_rules.count() > 0
    assert m.rules.where(F.col("level") == "category").count() == 0
    assert s["product"].n_rules == m.rules.count()


def test_itemsets_of_any_length_per_level(spark):
    """Lengths 1 to 5 at once for two levels with their own bounds, against counting every subset."""
    from itertools import combinations
    import random
    from shopseg.operators.basket import build_basket
    from shopseg.operators.rules import frequent_itemsets_by_level
    rng = random.Random(4)
    baskets = [sorted(rng.sample("abcdefg", rng.randint(1, 7))) for _ in range(60)]
    rows = [(lv, u, i) for lv in ("one", "two") for u, b in enumerate(baskets) for i in b]
    tx = spark.createDataFrame(rows, "level string, User_ID int, item string")
    params = spark.createDataFrame(
        [("one", 0.2, 0.1, 0.0, None, None, False, "ITEMSETS", 5), ("two", 0.3, 0.1, 0.0, None, None, False, "ITEMSETS", 2)],
        "level string, min_support double, min_conf double, min_lift double, top_n int, min_users_abs int, "
        "use_base_users boolean, mode string, max_len int")
    bk = build_basket(tx, params)
    got = {(r["level"], tuple(r["items"])): r.freq for r in frequent_itemsets_by_level(bk, params).collect()}
    want = {}
    for lv, support, longest in (("one", 0.2, 5), ("two", 0.3, 2)):
        for n in range(1, longest + 1):
            for c in combinations("abcdefg", n):
                f = sum(set(c) <= set(b) for b in baskets)
                if f / len(baskets) >= support:
                    want[(lv, c)] = f
    assert got == want and max(len(c) for _, c in want) >= 4
    fp = {tuple(r["items"]): r.freq for r in frequent_itemsets(bk, "one", 0.2, 5, method="fpgrowth").collect()}
    assert fp == {c: f for (lv, c), f in want.items() if lv == "one"}


def test_max_len_is_the_levels_own(spark):
    from dataclasses import replace
    from shopseg.plans.levels import CATEGORY, SEGMENT_CATEGORY, level_inputs
    tx = spark.createDataFrame([(1, "a"), (2, "b")], "User_ID int, Product_Category_str string")
    asg = spark.createDataFrame([(1, 0), (9, 7)], "User_ID int, cluster int")
    specs = [replace(CATEGORY, mode="ITEMSETS", max_len=2), replace(SEGMENT_CATEGORY, mode="ITEMSETS", max_len=3)]
    got = {r["level"]: r.max_len for r in level_inputs(tx, specs, asg)[1].collect()}
    assert got == {"category": 2, "cluster_0_category": 3}          # segment 7 has no transactions: no level


def test_apriori_counts_by_scanning_stored_baskets(spark, monkeypatch):
    """Sets of five and several passes; nothing per set and user is checkpointed."""
    import random
    from itertools import combinations
    from shopseg.operators import rules as R
    rng = random.Random(8)
    baskets = [rng.sample("abcdefgh", rng.randint(3, 8)) for _ in range(150)]
    params = spark.createDataFrame([("one", 0.1, 0.1, 0.0, None, None, False, "ITEMSETS", 5)],
                                   "level string, min_support double, min_conf double, min_lift double, top_n int, min_users_abs int, "
                                   "use_base_users boolean, mode string, max_len int")
    bk = build_basket(spark.createDataFrame([("one", u, i) for u, b in enumerate(baskets) for i in b], "level string, User_ID int, item string"), params)
    monkeypatch.setattr(R, "SCAN", 7)
    monkeypatch.setattr(R, "HELD", 8)
    kept_rows, cut = [], R.cut_lineage
    monkeypatch.setattr(R, "cut_lineage", lambda df: kept_rows.append("User_ID" in df.columns) or cut(df))
    got = {tuple(r["items"]): r.freq for r in R.frequent_itemsets_by_level(bk, params).collect()}
    want = {c: f for n in range(1, 6) for c in combinations("abcdefgh", n) if (f := sum(set(c) <= set(b) for b in baskets)) >= 15}
    assert got == want and not any(kept_rows)
