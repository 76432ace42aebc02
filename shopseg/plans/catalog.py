"""Named queries over the test tables: every registered query reads the whole
star-schema tables (or data Spark derives from them) and returns a DataFrame.

Each query is ``(spark, sf_dir) -> DataFrame``. Doubles are rounded to
6 places (money sums to 4) so results can be compared with an independent SQL
implementation by value hash.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopseg.operators.basket import build_basket
from shopseg.operators.clean import clean_transactions
from shopseg.operators.features import share_long, top_categories, user_features
from shopseg.operators.rules import (frequent_itemsets, frequent_itemsets_apriori, itemset_rules,
                                     top_rules)
from shopseg.plans.levels import LevelSpec, level_inputs, mine_levels
from shopseg.sources.transactions import basket_lines, region_assignments, transactions_from_tables

# Test-table mining levels (thresholds chosen so every level returns rules; FIXTURES.md §2).
T_CATEGORY = LevelSpec("category", "category_item", 0.04, 0.35, 1.25)
T_CATEGORY_LOOSE = LevelSpec("category", "category_item", 0.04, 0.30, 1.05)
T_PRODUCT = LevelSpec("product", "product_item", 0.02, 0.03, 1.30, top_n=40)
T_SEGMENT = LevelSpec("category", "category_item", 0.05, 0.35, 1.25, min_users_abs=40, segment=True)
ITEMSET_SUPPORT = 0.04


# Money-scale columns: per-user averages keep 4 places, sums of a user's purchases 2, so that
# summation-order differences (~1e-15 relative) cannot cross a rounding boundary.
MONEY_AVG = ("avg_purchase", "median_purchase", "std_purchase")
MONEY_SUM = ("total_purchase",)


def rounded(df: DataFrame, places: int = 6, money: tuple[str, ...] = ()) -> DataFrame:
    """Round every double column (``money`` and per-user money averages to 4 places, sums to 2)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            p = 2 if f.name in MONEY_SUM else 4 if (f.name in money or f.name in MONEY_AVG) else places
            cols.append(F.round(F.col(f.name).cast("double"), p).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------------------
# Cleaning
# ---------------------------------------------------------------------------

def q_clean_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(clean_transactions(transactions_from_tables(spark, sf)), money=("Purchase",))


def q_clean_transactions_dirty(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(clean_transactions(transactions_from_tables(spark, sf, "dirty")), money=("Purchase",))


def q_dedupe_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """P1 on a table holding every line twice: the cleaned table comes back once."""
    return rounded(clean_transactions(transactions_from_tables(spark, sf, "dup"), q_low=0.0, q_high=1.0),
                   money=("Purchase",))


# ---------------------------------------------------------------------------
# Baskets and rules
# ---------------------------------------------------------------------------

def _mine(spark, sf, specs, assignments=None):
    return mine_levels(basket_lines(spark, sf), specs, assignments)


def q_item_support(spark: SparkSession, sf: str) -> DataFrame:
    """A2 + O1: users per item at the category level, every item."""
    rows, params = level_inputs(basket_lines(spark, sf), [T_CATEGORY])
    return build_basket(rows, params).item_counts.select("level", "item", F.col("user_count").cast("long"))


def q_adaptive_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """A1 + A3: users and support floor per level (category, product, each region)."""
    rows, params = level_inputs(basket_lines(spark, sf), [T_CATEGORY, T_PRODUCT, T_SEGMENT],
                                region_assignments(spark, sf))
    bk = build_basket(rows, params)
    return (bk.users.join(bk.thresholds, "level")
            .select("level", F.col("n_users").cast("long"), F.col("base_users").cast("long"),
                    F.col("threshold").cast("long")))


def q_basket_kept(spark: SparkSession, sf: str) -> DataFrame:
    """The distinct (level, user, kept item) basket of the product level."""
    rows, params = level_inputs(basket_lines(spark, sf), [T_PRODUCT])
    return build_basket(rows, params).basket.select("level", "User_ID", "item")


def q_pair_rules_category(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_mine(spark, sf, [T_CATEGORY]).rules)


def q_pair_rules_product(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_mine(spark, sf, [T_PRODUCT]).rules)


def q_pair_rules_segment(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_mine(spark, sf, [T_SEGMENT], region_assignments(spark, sf)).rules)


def q_pair_rules_both_directions(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_mine(spark, sf, [T_CATEGORY_LOOSE]).directed)


def q_pair_rules_deduped(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_mine(spark, sf, [T_CATEGORY_LOOSE]).rules)


def q_top_rules(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(top_rules(_mine(spark, sf, [T_CATEGORY_LOOSE]).rules, 200))


def q_run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _mine(spark, sf, [T_CATEGORY, T_PRODUCT, T_SEGMENT], region_assignments(spark, sf)).summary


def _category_basket(spark, sf):
    rows, params = level_inputs(basket_lines(spark, sf), [T_CATEGORY])
    return build_basket(rows, params), params


def _itemsets_out(df: DataFrame) -> DataFrame:
    return df.select("level", F.array_join("items", ", ").alias("itemset"), F.size("items").alias("n_items"),
                     F.col("freq").cast("long").alias("freq"))


def q_frequent_itemsets(spark: SparkSession, sf: str) -> DataFrame:
    bk, _ = _category_basket(spark, sf)
    return _itemsets_out(frequent_itemsets(bk, "category", ITEMSET_SUPPORT, 3))


def q_frequent_itemsets_apriori(spark: SparkSession, sf: str) -> DataFrame:
    bk, _ = _category_basket(spark, sf)
    return _itemsets_out(frequent_itemsets_apriori(bk, "category", ITEMSET_SUPPORT, 4))


def q_itemset_rules(spark: SparkSession, sf: str) -> DataFrame:
    bk, params = _category_basket(spark, sf)
    sets = frequent_itemsets(bk, "category", ITEMSET_SUPPORT, 3)
    r = itemset_rules(sets, bk.basket_users, params)
    return rounded(r.select("level", "antecedent", "consequent", "antecedent_support", "consequent_support",
                            "support", "confidence", "lift"))


def q_itemset_rules_by_level(spark: SparkSession, sf: str) -> DataFrame:
    """R9 in itemset mode: sets of two for all customers, of three per region, each with its own support."""
    r = _mine(spark, sf, [replace(T_CATEGORY, mode="ITEMSETS", max_len=2), replace(T_SEGMENT, mode="ITEMSETS", max_len=3)],
              region_assignments(spark, sf)).itemset_rules
    return rounded(r.select("level", "antecedent", "consequent", "antecedent_support", "consequent_support",
                            "support", "confidence", "lift"))


# ---------------------------------------------------------------------------
# Features
# ---------------------------------------------------------------------------

def _clean(spark, sf):
    return clean_transactions(transactions_from_tables(spark, sf))


def q_top_categories(spark: SparkSession, sf: str) -> DataFrame:
    tx = _clean(spark, sf)
    top, _ = top_categories(tx, 10)
    freq = tx.groupBy("Product_Category_str").agg(F.count(F.lit(1)).alias("n"))
    return freq.where(F.col("Product_Category_str").isin(top)).select(
        F.col("Product_Category_str").alias("label"), F.col("n").cast("long"))


def q_user_basics(spark: SparkSession, sf: str) -> DataFrame:
    f, _ = user_features(_clean(spark, sf))
    return rounded(f.select("User_ID", "n_transactions", "total_purchase", "avg_purchase", "median_purchase",
                            "std_purchase", "unique_products"), money=("total_purchase",))


def q_user_modes(spark: SparkSession, sf: str) -> DataFrame:
    f, _ = user_features(_clean(spark, sf))
    return f.select("User_ID", "Age_mode", "Gender_mode", "City_Category_mode", "Stay_mode", "Marital_mode",
                    "Occupation_mode")


def q_category_shares(spark: SparkSession, sf: str) -> DataFrame:
    f, buckets = user_features(_clean(spark, sf))
    return rounded(share_long(f, buckets).select("User_ID", "bucket", "share"))


def q_revenue_shares(spark: SparkSession, sf: str) -> DataFrame:
    f, buckets = user_features(_clean(spark, sf))
    return rounded(share_long(f, buckets).select("User_ID", "bucket", F.col("rev_share")))


def q_category_entropy(spark: SparkSession, sf: str) -> DataFrame:
    f, _ = user_features(_clean(spark, sf))
    return rounded(f.select("User_ID", "cat_entropy", "n_unique_categories"))


def q_user_features_dirty(spark: SparkSession, sf: str) -> DataFrame:
    """M1 on the dirty mapping: NULL products, junk categories, missing ages / stays / purchases."""
    f, _ = user_features(clean_transactions(transactions_from_tables(spark, sf, "dirty")))
    return rounded(f.select("User_ID", "n_transactions", "total_purchase", "avg_purchase", "median_purchase",
                            "std_purchase", "unique_products", "Age_mode", "Gender_mode", "City_Category_mode",
                            "Stay_mode", "Marital_mode", "Occupation_mode", "cat_entropy", "n_unique_categories"),
                   money=("total_purchase",))


def q_category_shares_dirty(spark: SparkSession, sf: str) -> DataFrame:
    f, buckets = user_features(clean_transactions(transactions_from_tables(spark, sf, "dirty")))
    return rounded(share_long(f, buckets).select("User_ID", "bucket", "share", "rev_share"))


def q_user_features(spark: SparkSession, sf: str) -> DataFrame:
    f, _ = user_features(_clean(spark, sf))
    keep = [c for c in f.columns if not c.startswith("cat_share__") and not c.startswith("cat_rev_share__")]
    return rounded(f.select(*keep), money=("total_purchase",))



# ---------------------------------------------------------------------------
# Matrix, clustering, segmentation
# ---------------------------------------------------------------------------

def _numeric_long(df: DataFrame, cols: list[str], id_col: str = "User_ID") -> DataFrame:
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return df.selectExpr(id_col, f"stack({len(cols)}, {stack}) as (feature, value)")


def _winsorized(spark, sf):
    from shopseg.operators.matrix import winsorize_features
    from shopseg.plans.segmentation import TX_Q, USER_Q_DETECT
    tx = clean_transactions(transactions_from_tables(spark, sf), *TX_Q, by_user=True)
    feats, buckets = user_features(tx, by_user=True)
    feats = feats.persist(StorageLevel.MEMORY_AND_DISK)
    return feats, winsorize_features(feats, *USER_Q_DETECT).persist(StorageLevel.MEMORY_AND_DISK), buckets


MONEY_FEATURES = ["total_purchase", "avg_purchase", "median_purchase", "std_purchase"]


def q_winsorized_features(spark: SparkSession, sf: str) -> DataFrame:
    from shopseg.operators.features import numeric_feature_columns
    _, w, _ = _winsorized(spark, sf)
    long = _numeric_long(w, numeric_feature_columns(w))
    return long.select("User_ID", "feature",
                       F.when(F.col("feature").isin(list(MONEY_SUM)), F.round("value", 2))
                        .when(F.col("feature").isin(MONEY_FEATURES), F.round("value", 4))
                        .otherwise(F.round("value", 6)).alias("value"))


def _scaled(spark, sf):
    from shopseg.operators.matrix import matrix_columns, robust_scale
    _, w, _ = _winsorized(spark, sf)
    numeric, _ = matrix_columns(w)
    return robust_scale(w.select("User_ID", *numeric), numeric, cached=w), numeric


def q_robust_scaled(spark: SparkSession, sf: str) -> DataFrame:
    sc, numeric = _scaled(spark, sf)
    return rounded(_numeric_long(sc, numeric))


def q_one_hot_modes(spark: SparkSession, sf: str) -> DataFrame:
    from shopseg.operators.matrix import CATEGORICAL, one_hot
    from shopseg.plans.segmentation import TX_Q
    feats, _ = user_features(clean_transactions(transactions_from_tables(spark, sf), *TX_Q, by_user=True), by_user=True)
    enc, names = one_hot(feats.select("User_ID", *CATEGORICAL), CATEGORICAL)
    return _numeric_long(enc, names)


def _scaled_points(spark, sf):
    sc, numeric = _scaled(spark, sf)
    return sc.select("User_ID", F.array(*[F.col(f"`{c}`") for c in numeric]).alias("pca"))


#: Radius (robust-scaled units) of the registered range join.
NEAR = 11.0


def q_pairwise_manhattan_within(spark: SparkSession, sf: str) -> DataFrame:
    """All pairs of customers whose scaled blocks lie within the radius."""
    from shopseg.operators.neighbours import pairs_within
    from shopseg.session import cut_lineage
    return rounded(pairs_within(cut_lineage(_scaled_points(spark, sf)), NEAR))


def _matrix(spark, sf):
    from shopseg.operators.matrix import feature_matrix
    _, w, _ = _winsorized(spark, sf)
    return feature_matrix(w)


def q_feature_matrix_long(spark: SparkSession, sf: str) -> DataFrame:
    """M4: every cell of the assembled matrix (scaled block, then one-hot block)."""
    x, names = _matrix(spark, sf)
    name = F.array(*[F.lit(c) for c in names])
    return rounded(x.select("User_ID", F.posexplode("x").alias("i", "value")).select("User_ID", name[F.col("i")].alias("feature"), "value"))


def q_feature_covariance(spark: SparkSession, sf: str) -> DataFrame:
    """M5: sample covariance of the assembled matrix (each unordered pair of columns once, by name)."""
    from shopseg.operators.matrix import feature_covariance
    c = feature_covariance(*_matrix(spark, sf))
    return rounded(c.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "cov"), places=4)


def q_pca_total_variance(spark: SparkSession, sf: str) -> DataFrame:
    """M5: the variance that the explained ratios are shares of (trace of the covariance)."""
    from shopseg.operators.matrix import feature_covariance
    c = feature_covariance(*_matrix(spark, sf))
    return rounded(c.where("a = b").agg(F.count(F.lit(1)).alias("n_columns"), F.sum("cov").alias("total_variance")), places=4)


def q_cluster_profile_final(spark: SparkSession, sf: str) -> DataFrame:
    """A19 + J3 + P16: profile of given final labels over un-winsorized features, every share column included;
    labelled users without a feature row count with zeros."""
    from shopseg.operators.profile import profile_clusters
    from shopseg.plans.segmentation import TX_Q
    feats, _ = user_features(clean_transactions(transactions_from_tables(spark, sf), *TX_Q, by_user=True), by_user=True)
    cols = [c for c, t in feats.dtypes if c != "User_ID" and t != "string"]
    joined = feats.join(region_assignments(spark, sf), "User_ID", "right").na.fill(0, subset=cols)
    prof = profile_clusters(joined, columns=cols)
    stack = ", ".join(f"'{c}', CAST(`{c}__count` AS BIGINT), `{c}__mean`, `{c}__median`" for c in cols)
    return rounded(prof.selectExpr("cluster", f"stack({len(cols)}, {stack}) as (feature, count, mean, median)"), places=4)


def q_l1_silhouette(spark: SparkSession, sf: str) -> DataFrame:
    """Per-user Manhattan silhouette of the scaled numeric block, labels = region."""
    from shopseg.operators.silhouette import l1_silhouette_samples
    return rounded(l1_silhouette_samples(_scaled_points(spark, sf), region_assignments(spark, sf)))


def q_euclidean_silhouette(spark: SparkSession, sf: str) -> DataFrame:
    from shopseg.operators.silhouette import euclidean_silhouette_samples
    return rounded(euclidean_silhouette_samples(_scaled_points(spark, sf), region_assignments(spark, sf)))


def _detect_points(spark, sf, variant="planted"):
    from shopseg.plans.segmentation import PCA_DETECT, TX_Q, USER_Q_DETECT, prepare
    tx = clean_transactions(transactions_from_tables(spark, sf, variant), *TX_Q, by_user=True)
    return prepare(tx, USER_Q_DETECT, PCA_DETECT, by_user=True)


def q_pca_variance(spark: SparkSession, sf: str) -> DataFrame:
    """M5: explained variance ratio of the components kept for the 80 % target."""
    prep = _detect_points(spark, sf)
    r = prep.pca
    rows, cum = [], 0.0
    for i, v in enumerate(r.explained):
        cum += v
        rows.append((i + 1, float(v), float(cum)))
    return rounded(spark.createDataFrame(rows, "component int, explained_ratio double, cumulative double"))


def q_pca_components(spark: SparkSession, sf: str) -> DataFrame:
    """M5: every loading of the components kept for the 80 % target."""
    prep = _detect_points(spark, sf)
    rows = [(j + 1, c, float(v)) for j, axis in enumerate(prep.pca.components.T) for c, v in zip(prep.columns, axis)]
    return rounded(spark.createDataFrame(rows, "component int, feature string, loading double"))


def q_pca_projection(spark: SparkSession, sf: str) -> DataFrame:
    """M6: centred 3-D coordinates of the scaled matrix with the region label."""
    from shopseg.operators.matrix import pca_projection
    prep = _detect_points(spark, sf)
    out, _ = pca_projection(prep.x, region_assignments(spark, sf), 3)
    return rounded(out, places=4)


def q_merge_tree(spark: SparkSession, sf: str) -> DataFrame:
    """M8: average + Manhattan merge tree of the detection space."""
    from shopseg.operators.hierarchy import agglomerate
    return rounded(agglomerate(_detect_points(spark, sf).points, "average", "manhattan", [4]).merges)


def q_merge_tail(spark: SparkSession, sf: str) -> DataFrame:
    """Last 49 merges (lastp dendrogram data) of the complete + Manhattan tree."""
    from shopseg.operators.hierarchy import agglomerate
    return rounded(agglomerate(_detect_points(spark, sf).points, "complete", "manhattan", [4]).tail(50))


def _given_members(spark, sf):
    """Every customer's scaled block with the nation as leaf."""
    nations = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").cast("int").alias("User_ID"),
                                                                 F.col("c_nationkey").cast("long").alias("leaf"))
    return _scaled_points(spark, sf).join(nations, "User_ID")


def _given_leaves(members):
    """A leaf table without a cover: each nation's mean vector."""
    d = len(members.first()["pca"])
    return members.groupBy("leaf").agg(
        F.count(F.lit(1)).cast("long").alias("size"), F.min("leaf").alias("min_id"),
        F.array(*[F.avg(F.col("pca")[i]) for i in range(d)]).alias("x"))


def _given_trees(spark, sf):
    from shopseg.operators.hierarchy import tree_of_leaves
    from shopseg.session import cut_lineage
    leaves = cut_lineage(_given_leaves(_given_members(spark, sf)))
    return {lk: tree_of_leaves(leaves.select("leaf"), leaves, lk, "manhattan", [2, 4, 10]) for lk in ("average", "complete")}


def q_merge_heights_given_leaves(spark: SparkSession, sf: str) -> DataFrame:
    """M8: heights of the Manhattan trees of given leaves, average and complete."""
    a, c = (t.merges.select(F.lit(lk).alias("linkage"), "step", "height") for lk, t in _given_trees(spark, sf).items())
    return rounded(a.unionByName(c))


def q_merge_heights_true_average(spark: SparkSession, sf: str) -> DataFrame:
    """M8: heights of the average tree of given leaves by the distances of all member pairs."""
    from shopseg.operators.cover import distance_sums
    from shopseg.operators.hierarchy import tree_of_leaves
    from shopseg.session import cut_lineage
    members = cut_lineage(_given_members(spark, sf))
    leaves = cut_lineage(_given_leaves(members))
    sums = distance_sums(members, [r.leaf for r in leaves.select("leaf").collect()])
    t = tree_of_leaves(members, leaves, "average", "manhattan", [2], sums)
    return rounded(t.merges.select("step", "height", "lower", "upper"))


def q_labels_given_leaves(spark: SparkSession, sf: str) -> DataFrame:
    """M8 / M10 cuts of the same trees at k = 2, 4, 10, numbered by size, then smallest leaf."""
    a, c = (t.leaf_labels.select(F.lit(lk).alias("linkage"), "k", "leaf", "label") for lk, t in _given_trees(spark, sf).items())
    return a.unionByName(c)


def _variant(name):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        """The one-pass pipeline with the given preset (row winsor 0.01/0.995, PCA 80 %)."""
        from shopseg.plans.segmentation import one_pass
        return one_pass(transactions_from_tables(spark, sf), name)[0].labels
    q.__name__ = f"q_segments_{name}"
    return q


def q_one_pass_profile(spark: SparkSession, sf: str) -> DataFrame:
    """A19 of the one-pass pipeline: winsorized features per cluster of the ``test2`` preset."""
    from shopseg.plans.segmentation import one_pass
    return rounded(one_pass(transactions_from_tables(spark, sf), "test2")[2], places=4)


def q_choose_k(spark: SparkSession, sf: str) -> DataFrame:
    """Silhouette per k (2..10) of the Ward tree; ``best`` marks the chosen k."""
    from shopseg.plans.segmentation import choose_k
    best, scores, _ = choose_k(_detect_points(spark, sf, "clean").points, "ward", "euclidean")
    return rounded(spark.createDataFrame([(k, s, k == best) for k, s in scores],
                                         "k int, silhouette double, best boolean"))


def q_best_k_given_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Silhouettes of given labelings (nation modulo k, k = 2..10), all in one pass, and the best k."""
    from shopseg.operators.silhouette import silhouette_scores
    from shopseg.plans.segmentation import best_k
    nations = spark.read.parquet(f"{sf}/customer.parquet").selectExpr("CAST(c_custkey AS INT) AS User_ID", "c_nationkey")
    labels = nations.selectExpr("User_ID", "explode(sequence(2, 10)) AS k", "c_nationkey") \
        .selectExpr("User_ID", "k", "CAST(c_nationkey % k AS INT) AS cluster")
    scores = sorted(silhouette_scores(_scaled_points(spark, sf), labels, "manhattan").items())
    best = best_k(scores)
    return rounded(spark.createDataFrame([(k, s, k == best) for k, s in scores], "k int, silhouette double, best boolean"))


def _hybrid(spark, sf):
    from shopseg.plans.segmentation import hybrid_segments
    return hybrid_segments(transactions_from_tables(spark, sf, "planted"), silhouettes=False)


def q_niche_users(spark: SparkSession, sf: str) -> DataFrame:
    return _hybrid(spark, sf).niche_users


def q_core_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return _hybrid(spark, sf).core_transactions


def q_hybrid_segments(spark: SparkSession, sf: str) -> DataFrame:
    return _hybrid(spark, sf).final


def q_hybrid_silhouettes(spark: SparkSession, sf: str) -> DataFrame:
    from shopseg.plans.segmentation import hybrid_segments
    h = hybrid_segments(transactions_from_tables(spark, sf, "planted"))
    return rounded(spark.createDataFrame([("detect", 4, h.silhouette_detect), ("core", 4, h.silhouette_core)],
                                         "pass string, k int, silhouette double"))


def q_pair_rules_hybrid_segments(spark: SparkSession, sf: str) -> DataFrame:
    """R8 + J2 on real segments: category pair rules per final hybrid segment (planted data)."""
    return rounded(_mine(spark, sf, [T_SEGMENT], _hybrid(spark, sf).final).rules)


def _nation_labels(spark, sf):
    users = basket_lines(spark, sf).select("User_ID").distinct()
    c = spark.read.parquet(f"{sf}/customer.parquet").select(
        F.col("c_custkey").cast("int").alias("User_ID"), F.col("c_nationkey").cast("int").alias("cluster"))
    return c.join(users, "User_ID", "left_semi")


def q_niche_split_given_labels(spark: SparkSession, sf: str) -> DataFrame:
    """P14, J4, J5, W2, U1 with given labels: detection = nation, core recluster = region."""
    from shopseg.operators.profile import cluster_sizes
    from shopseg.plans.segmentation import niche_clusters, reattach, split_users
    det = _nation_labels(spark, sf)
    core, niche = split_users(det, niche_clusters(cluster_sizes(det)))
    core_labels = region_assignments(spark, sf).join(core, "User_ID", "left_semi")
    return reattach(core_labels, niche)


def q_core_rows_given_labels(spark: SparkSession, sf: str) -> DataFrame:
    """J4 / J5 / K2 routing with given labels: raw rows of every user tagged core or niche."""
    from shopseg.operators.profile import cluster_sizes
    from shopseg.plans.segmentation import niche_clusters, split_users
    det = _nation_labels(spark, sf)
    core, niche = split_users(det, niche_clusters(cluster_sizes(det)))
    seg = (core.select("User_ID", F.lit("core").alias("segment"))
           .unionByName(niche.select("User_ID", F.lit("niche").alias("segment"))))
    raw = transactions_from_tables(spark, sf)
    return rounded(raw.join(seg, "User_ID"), money=("Purchase",))


def q_cluster_profile(spark: SparkSession, sf: str) -> DataFrame:
    """A19 with given labels (region), every share column included, long form ``cluster, feature, count, mean, median``."""
    from shopseg.operators.profile import profile_clusters
    from shopseg.plans.segmentation import TX_Q
    feats, _ = user_features(clean_transactions(transactions_from_tables(spark, sf), *TX_Q, by_user=True), by_user=True)
    cols = [c for c, t in feats.dtypes if c != "User_ID" and t != "string"]
    prof = profile_clusters(feats.join(region_assignments(spark, sf), "User_ID"), columns=cols)
    stack = ", ".join(f"'{c}', CAST(`{c}__count` AS BIGINT), `{c}__mean`, `{c}__median`" for c in cols)
    long = prof.selectExpr("cluster", f"stack({len(cols)}, {stack}) as (feature, count, mean, median)")
    return rounded(long, places=4)



# ---------------------------------------------------------------------------
# The reference's production rule profile on the mapped transactions
# ---------------------------------------------------------------------------

def _production(spark, sf):
    from shopseg.operators.clean import basket_transactions
    from shopseg.plans.levels import production_levels
    return production_levels(basket_transactions(transactions_from_tables(spark, sf)),
                             region_assignments(spark, sf))


def q_production_rules(spark: SparkSession, sf: str) -> DataFrame:
    """R6 + R7 + R8: categories, top-40 products and categories per segment, reference thresholds."""
    return rounded(_production(spark, sf).rules)


def q_production_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _production(spark, sf).summary


def q_production_item_support(spark: SparkSession, sf: str) -> DataFrame:
    """Kept items with their user counts per level (the reference's item-support files)."""
    k = _production(spark, sf).basket.kept
    return k.select("level", "item", F.col("user_count").cast("long"))


def q_top_rules_pair_order(spark: SparkSession, sf: str) -> DataFrame:
    """O6 literal: the first 200 deduplicated rules in unordered-pair order."""
    return rounded(top_rules(_mine(spark, sf, [T_CATEGORY_LOOSE]).rules, 200, order="pair"))


def q_category_frequency(spark: SparkSession, sf: str) -> DataFrame:
    from shopseg.operators.features import category_frequency
    return category_frequency(_clean(spark, sf)).select(F.col("Product_Category_str").alias("label"),
                                                        F.col("n").cast("long"))


def q_first_assignments(spark: SparkSession, sf: str) -> DataFrame:
    """O7 with a limit that bites at every size: the first 100 of the same order."""
    from shopseg.plans.segmentation import sample_assignments
    return sample_assignments(q_niche_split_given_labels(spark, sf), 100)


def q_production_rules_loose(spark: SparkSession, sf: str) -> DataFrame:
    """R6-R8 over the reference's own columns with thresholds that rules of this data pass."""
    from shopseg.operators.clean import basket_transactions
    from shopseg.plans.levels import CATEGORY, PRODUCT, SEGMENT_CATEGORY
    specs = [replace(s, min_conf=0.02, min_lift=1.0) for s in (CATEGORY, PRODUCT, SEGMENT_CATEGORY)]
    return rounded(mine_levels(basket_transactions(transactions_from_tables(spark, sf)), specs, region_assignments(spark, sf)).rules)


def q_sample_assignments(spark: SparkSession, sf: str) -> DataFrame:
    """First 5,000 final assignments (core labels first, then user id)."""
    from shopseg.plans.segmentation import sample_assignments
    return sample_assignments(q_niche_split_given_labels(spark, sf), 5000)


QUERIES = {
    "clean_transactions": q_clean_transactions,
    "clean_transactions_dirty": q_clean_transactions_dirty,
    "dedupe_transactions": q_dedupe_transactions,
    "item_support": q_item_support,
    "adaptive_threshold": q_adaptive_threshold,
    "basket_kept": q_basket_kept,
    "pair_rules_category": q_pair_rules_category,
    "pair_rules_product": q_pair_rules_product,
    "pair_rules_segment": q_pair_rules_segment,
    "pair_rules_both_directions": q_pair_rules_both_directions,
    "pair_rules_deduped": q_pair_rules_deduped,
    "top_rules": q_top_rules,
    "run_summary": q_run_summary,
    "frequent_itemsets": q_frequent_itemsets,
    "frequent_itemsets_apriori": q_frequent_itemsets_apriori,
    "itemset_rules": q_itemset_rules,
    "itemset_rules_by_level": q_itemset_rules_by_level,
    "top_categories": q_top_categories,
    "user_basics": q_user_basics,
    "user_modes": q_user_modes,
    "category_shares": q_category_shares,
    "revenue_shares": q_revenue_shares,
    "category_entropy": q_category_entropy,
    "user_features": q_user_features,
    "user_features_dirty": q_user_features_dirty,
    "category_shares_dirty": q_category_shares_dirty,
    "winsorized_features": q_winsorized_features,
    "robust_scaled": q_robust_scaled,
    "one_hot_modes": q_one_hot_modes,
    "feature_matrix_long": q_feature_matrix_long,
    "feature_covariance": q_feature_covariance,
    "pca_total_variance": q_pca_total_variance,
    "cluster_profile_final": q_cluster_profile_final,
    "l1_silhouette": q_l1_silhouette,
    "euclidean_silhouette": q_euclidean_silhouette,
    "pca_variance": q_pca_variance,
    "pca_components": q_pca_components,
    "pca_projection": q_pca_projection,
    "pairwise_manhattan_within": q_pairwise_manhattan_within,
    "merge_tree": q_merge_tree,
    "merge_tail": q_merge_tail,
    "merge_heights_given_leaves": q_merge_heights_given_leaves,
    "merge_heights_true_average": q_merge_heights_true_average,
    "labels_given_leaves": q_labels_given_leaves,
    "segments_original": _variant("original"),
    "segments_test1": _variant("test1"),
    "segments_test2": _variant("test2"),
    "segments_test3": _variant("test3"),
    "one_pass_profile": q_one_pass_profile,
    "choose_k": q_choose_k,
    "best_k_given_labels": q_best_k_given_labels,
    "niche_users": q_niche_users,
    "core_transactions": q_core_transactions,
    "hybrid_segments": q_hybrid_segments,
    "hybrid_silhouettes": q_hybrid_silhouettes,
    "pair_rules_hybrid_segments": q_pair_rules_hybrid_segments,
    "niche_split_given_labels": q_niche_split_given_labels,
    "cluster_profile": q_cluster_profile,
    "core_rows_given_labels": q_core_rows_given_labels,
    "production_rules": q_production_rules,
    "production_rules_loose": q_production_rules_loose,
    "first_assignments": q_first_assignments,
    "production_summary": q_production_summary,
    "production_item_support": q_production_item_support,
    "top_rules_pair_order": q_top_rules_pair_order,
    "category_frequency": q_category_frequency,
    "sample_assignments": q_sample_assignments,
}
