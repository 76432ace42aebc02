"""Segmentation plans: one-pass variants (M10, M11) and the hybrid
niche / core pipeline (M12-M16, J3-J6, W2, U1, K2).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopseg.operators.basket import checked_broadcast
from shopseg.operators.clean import clean_transactions, coerced_transactions, impute_and_clip
from shopseg.operators.features import user_features
from shopseg.operators.hierarchy import LEAVES, Tree, agglomerate
from shopseg.operators.matrix import PCAResult, feature_matrix, pca_by_variance, winsorize_features
from shopseg.operators.profile import cluster_sizes, profile_clusters
from shopseg.operators.silhouette import silhouette_score, silhouette_scores
from shopseg.session import cut_lineage
from shopseg.sources.transactions import write_split

# Reference parameters (fixed values).
TX_Q = (0.01, 0.99)              # row-level winsorizing, hybrid pipeline
TX_Q_ONE_PASS = (0.01, 0.995)    # row-level winsorizing, one-pass variants
USER_Q_DETECT = (0.005, 0.995)
USER_Q_CORE = (0.01, 0.99)
PCA_DETECT = 0.80
PCA_CORE = 0.90
MIN_CLUSTER_PCT = 0.01
MIN_CLUSTER_SIZE = 50
DETECT_K = 4
CORE_LINKAGE, CORE_METRIC, CORE_K = "complete", "manhattan", 4
K_MIN, K_MAX = 2, 10
VARIANTS = {
    "original": ("ward", "euclidean", None),
    "test1": ("average", "manhattan", [4, 5]),
    "test2": ("complete", "manhattan", [4]),
    "test3": ("ward", "euclidean", [3]),
}


@dataclass
class Prepared:
    feats: DataFrame          # user features, not winsorized
    winsorized: DataFrame     # after P9
    x: DataFrame              # User_ID, x (scaled + one-hot)
    columns: list[str]
    points: DataFrame         # User_ID, pca
    pca: PCAResult | None
    buckets: list[str]


def prepare(tx: DataFrame, user_q: tuple[float, float], pca_target: float | None,
            top_cat: int = 10, quantile_method: str = "refine", by_user: bool = False) -> Prepared:
    """Features -> user winsorizing -> scale / encode -> optional PCA (``by_user``: see ``user_features``)."""
    feats, buckets = user_features(tx, top_cat, by_user=by_user)
    feats = feats.persist(StorageLevel.MEMORY_AND_DISK)
    wins = winsorize_features(feats, *user_q, quantile_method=quantile_method)
    wins = wins.persist(StorageLevel.MEMORY_AND_DISK)
    x, names = feature_matrix(wins, quantile_method)
    x = x.persist(StorageLevel.MEMORY_AND_DISK)
    if pca_target:
        points, res = pca_by_variance(x, pca_target, d=len(names))
    else:
        points, res = x.select("User_ID", F.col("x").alias("pca")), None
    points = cut_lineage(points)
    return Prepared(feats, wins, x, names, points, res, buckets)


@dataclass
class VariantResult:
    variant: str
    linkage: str
    metric: str
    k: int
    labels: DataFrame          # User_ID, cluster
    scores: list[tuple[int, float]]
    tree: Tree
    certain: bool              # whether the cut is the points' own, whatever the leaves hide


def best_k(scores: list[tuple[int, float]]) -> int:
    """The k of the highest score, of equal ones the smallest."""
    return min(scores, key=lambda t: (-t[1], t[0]))[0]


def choose_k(points: DataFrame, linkage: str, metric: str, k_min: int = K_MIN, k_max: int = K_MAX,
             leaves: int = LEAVES) -> tuple[int, list[tuple[int, float]], Tree]:
    """Silhouette for each k, best k (ties -> smaller k); one tree, many cuts."""
    n = points.count()
    ks = [k for k in range(k_min, k_max + 1) if 2 <= k <= n - 1]
    tree = agglomerate(points, linkage, metric, ks or [max(2, k_min)], leaves=leaves)
    sil_metric = "euclidean" if linkage == "ward" else metric
    # every cut has exactly k clusters (k <= n - 1), so all are valid; one pass scores them all
    by_k = silhouette_scores(points, tree.labels_all(), sil_metric) if ks else {}
    scores = sorted(by_k.items())
    if not scores:
        return max(2, k_min), scores, tree
    return best_k(scores), scores, tree


def segment_variant(points: DataFrame, variant: str, k_min: int = K_MIN, k_max: int = K_MAX,
                    leaves: int = LEAVES) -> VariantResult:
    """The four presets of the one-pass pipeline."""
    if variant not in VARIANTS:
        raise ValueError(f"unknown variant {variant!r}")
    linkage, metric, ks = VARIANTS[variant]
    if ks is None:
        k, scores, tree = choose_k(points, linkage, metric, k_min, k_max, leaves)
    else:
        tree = agglomerate(points, linkage, metric, ks, leaves=leaves)
        sil_metric = "euclidean" if linkage == "ward" else metric
        scores = sorted(silhouette_scores(points, tree.labels_all(), sil_metric).items())
        k = sorted(scores, key=lambda t: (-t[1], t[0]))[0][0]
    return VariantResult(variant, linkage, metric, k, tree.labels(k), scores, tree, tree.certain.get(k, False))


def one_pass(raw: DataFrame, variant: str = "original", use_pca: bool = True, pca_target: float = 0.80,
             top_cat: int = 10, tx_q=TX_Q_ONE_PASS, user_q=USER_Q_DETECT, leaves: int = LEAVES) -> tuple[VariantResult, Prepared, DataFrame]:
    """The one-pass pipeline: clean -> features -> variant; profile of winsorized features."""
    tx = clean_transactions(raw, *tx_q, by_user=True)
    prep = prepare(tx, user_q, pca_target if use_pca else None, top_cat, by_user=True)
    res = segment_variant(prep.points, variant, leaves=leaves)
    profile = profile_clusters(prep.winsorized.join(res.labels, "User_ID"))
    return res, prep, profile


# ---------------------------------------------------------------------------
# Hybrid: detect niches, recluster the core, reattach
# ---------------------------------------------------------------------------

def niche_clusters(sizes: DataFrame, min_size: int = MIN_CLUSTER_SIZE, min_pct: float = MIN_CLUSTER_PCT,
                   label_col: str = "cluster") -> DataFrame:
    """Labels whose size is < ``min_size`` or whose share is < ``min_pct``."""
    total = sizes.agg(F.sum("size")).collect()[0][0] or 0
    return (sizes.where((F.col("size") < F.lit(min_size))
                        | (F.col("size") / F.lit(float(max(total, 1))) < F.lit(min_pct)))
            .select(label_col))


def split_users(labels: DataFrame, niches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(core users, niche users with their detection label)."""
    nb = F.broadcast(niches)   # at most k rows
    core = labels.join(nb, "cluster", "left_anti").select("User_ID")
    niche = labels.join(nb, "cluster", "left_semi").select("User_ID", F.col("cluster").alias("detect_cluster"))
    return core, niche


def _dense_map(values: list) -> F.Column:
    return F.create_map(*[x for i, v in enumerate(sorted(values)) for x in (F.lit(v), F.lit(i))])


def reattach(core_labels: DataFrame, niche: DataFrame) -> DataFrame:
    """M15 (W2 + U1): core labels -> 0..k-1; each niche detection label -> next free label.

    The label lists are at most k values each, so the dense ranks are built on
    the driver as literal maps.
    """
    core_ids = [r[0] for r in core_labels.select("cluster").distinct().collect()]
    niche_ids = [r[0] for r in niche.select("detect_cluster").distinct().collect()]
    next_label = len(core_ids)  # max(dense core label) + 1, 0 when there is no core
    core = core_labels.select("User_ID", F.element_at(_dense_map(core_ids), F.col("cluster")).cast("int")
                              .alias("cluster"))
    if not niche_ids:
        return core
    niche_final = niche.select("User_ID", (F.element_at(_dense_map(niche_ids), F.col("detect_cluster"))
                                           + F.lit(next_label)).cast("int").alias("cluster"))
    return core.unionByName(niche_final)


@dataclass
class HybridResult:
    final: DataFrame                  # User_ID, cluster
    detect_labels: DataFrame          # User_ID, cluster (detection pass)
    detect_sizes: DataFrame
    niche_users: DataFrame            # User_ID, detect_cluster
    core_users: DataFrame             # User_ID
    core_labels: DataFrame            # User_ID, cluster (core pass)
    core_transactions: DataFrame      # raw rows of core users
    profile: DataFrame
    silhouette_detect: float | None
    silhouette_core: float | None
    core_tree: Tree
    detect_tree: Tree
    core_points: DataFrame
    detect_certain: bool              # whether each cut is the points' own, whatever the leaves hide
    core_certain: bool
    core_prepared: Prepared = field(repr=False, default=None)


def hybrid_segments(raw: DataFrame, leaves: int = LEAVES, top_cat: int = 10,
                    split_path: str | None = None, silhouettes: bool = True) -> HybridResult:
    """The reference's hybrid pipeline end to end.

    Deviations (documented): no niche -> core only; all users niche -> error;
    the core / niche split is always recomputed (``split_path`` optional);
    labels are canonical (size desc, then smallest user id).
    """
    # both passes read these rows: deduplicated, coerced and dealt by user once
    base = coerced_transactions(raw, by_user=True).persist(StorageLevel.MEMORY_AND_DISK)
    tx = impute_and_clip(base, *TX_Q)
    det = prepare(tx, USER_Q_DETECT, PCA_DETECT, top_cat, by_user=True)
    det_tree = agglomerate(det.points, "average", "manhattan", [DETECT_K], leaves=leaves)
    # labels are a cheap join of persisted leaf assignments with the checkpointed tree: persisting is
    # enough (a lost block is recomputed from that short lineage)
    det_labels = det_tree.labels(DETECT_K).persist(StorageLevel.MEMORY_AND_DISK)
    sizes = cluster_sizes(det_labels)
    niches = niche_clusters(sizes)
    core_users, niche_users = split_users(det_labels, niches)
    core_users = core_users.persist(StorageLevel.MEMORY_AND_DISK)
    niche_users = niche_users.persist(StorageLevel.MEMORY_AND_DISK)
    if core_users.isEmpty():
        raise ValueError("every detection cluster is a niche; there is no core to recluster")
    # J4 via J5: every user with rows has a detection label, so core rows are the rows of users that
    # are not niche -- an anti join against the small niche side (broadcast only if its count allows)
    n_niche = niche_users.count()
    niche_ids = checked_broadcast(niche_users.select("User_ID"), n_niche)
    core_raw = raw.where(F.col("User_ID").isNotNull()).join(niche_ids, "User_ID", "left_anti")
    if split_path:
        seg = (core_users.select("User_ID", F.lit("core").alias("segment"))
               .unionByName(niche_users.select("User_ID", F.lit("niche").alias("segment"))))
        write_split(raw, seg, split_path)                             # K2
    # the core pass re-cleans core rows only (own modes, bounds, top categories); the stored rows are
    # reused instead of reading, deduplicating and coercing the raw rows again
    core_base = base.join(niche_ids, "User_ID", "left_anti")
    core_tx = impute_and_clip(core_base, *TX_Q)
    core = prepare(core_tx, USER_Q_CORE, PCA_CORE, top_cat, by_user=True)
    core_tree = agglomerate(core.points, CORE_LINKAGE, CORE_METRIC, [CORE_K], leaves=leaves)
    core_labels = core_tree.labels(CORE_K).persist(StorageLevel.MEMORY_AND_DISK)
    final = cut_lineage(reattach(core_labels, niche_users))        # the pipeline's result: written out
    # Un-winsorized first-pass features of every finally labelled user; numeric NULL -> 0
    prof_in = det.feats.join(final, "User_ID", "right")
    num = [f for f, t in prof_in.dtypes if f not in ("User_ID", "cluster") and t in
           ("int", "bigint", "double", "smallint", "tinyint", "float")]
    prof_in = prof_in.na.fill(0, subset=num)
    profile = profile_clusters(prof_in)
    s_core = s_det = None
    if silhouettes:
        s_core = silhouette_score(core.points, core_labels, CORE_METRIC)
        s_det = silhouette_score(det.points, det_labels, "manhattan")
    return HybridResult(final, det_labels, sizes, niche_users, core_users, core_labels, core_raw, profile,
                        s_det, s_core, core_tree, det_tree, core.points, det_tree.certain[DETECT_K],
                        core_tree.certain[CORE_K], core)


def sample_assignments(final: DataFrame, n: int = 5000) -> DataFrame:
    """The first ``n`` assignments (core labels first, then by user id)."""
    return final.orderBy("cluster", "User_ID").limit(n)
