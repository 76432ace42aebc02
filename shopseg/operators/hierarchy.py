"""Agglomerative (hierarchical) clustering on Spark: M8, M10 cuts, M17.

Ward merges the points themselves, all of them (``ward.py``): every different point is a leaf. For average and complete linkage exact
agglomeration of n points needs all O(n^2) distances in every merge. Here the same two steps run at every size, with an
explicit bound that always applies:

1. **Leaves.** The points are summarized by at most ``leaves`` leaves and never meet in pairs. The leaves are a farthest-point
   cover (``cover.py``) with a radius each.
2. **Merge tree.** The distances between leaves are a table of at most ``leaves * (leaves - 1) / 2`` rows, written once.
   Average linkage with Manhattan distance has the true average over all member pairs there. Each round is one job: the table
   is aggregated by the current leaf-to-cluster map (Ward over given leaves recomputes from merged means), every
   cluster's nearest neighbour found, and all pairs that are each other's nearest merge. For these
   linkages that gives the same tree as merging the closest pair each time. Only nearest neighbours, a row per cluster, reach
   the driver, which numbers the merges like a linkage matrix and cuts the tree.

What the leaves hide is stated: each merge has a ``lower`` and ``upper`` bound of its height between the very points on
both sides, and is ``certain`` if the cluster it makes is one of the points' own tree, too: because its members lie closer
together than anything else does, or because both sides are certain and no height within the bounds would merge either with another
cluster first. A cut is certain if its clusters are and all of them were made before any two of them could merge. Labels are
canonical: clusters are numbered by size descending, then smallest member id. Ward's merges have no bounds and are never marked certain.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopseg.functions.numbering import numbered, stored
from shopseg.operators.cover import cover, distance_sums
from shopseg.operators.ward import MERGE, ward_merges
from shopseg.session import cut_lineage

LINKAGES = ("average", "complete", "ward")
# Names under which each metric is known (fixed values).
METRICS = {"manhattan": "manhattan", "l1": "manhattan", "cityblock": "manhattan",
           "euclidean": "euclidean", "l2": "euclidean"}
LEAVES = 256


def check_linkage(linkage: str, metric: str) -> str:
    """The metric's own name; unknown or impossible combinations are errors."""
    if linkage not in LINKAGES:
        raise ValueError(f"linkage must be one of {LINKAGES}, not {linkage!r}")
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {tuple(METRICS)}, not {metric!r}")
    if linkage == "ward" and METRICS[metric] != "euclidean":
        raise ValueError(f"ward merges by squared Euclidean distance to means; {metric!r} has no means")
    return METRICS[metric]


# ---------------------------------------------------------------------------
# Merge tree of the leaves
# ---------------------------------------------------------------------------

def _distance(metric: str) -> str:
    """SQL: distance of the arrays ``x`` and ``y``."""
    if metric == "manhattan":
        return "aggregate(zip_with(x, y, (a, b) -> abs(a - b)), 0D, (s, v) -> s + v)"
    return "sqrt(aggregate(zip_with(x, y, (a, b) -> (a - b) * (a - b)), 0D, (s, v) -> s + v))"


def _pairs(clusters: DataFrame, linkage: str, metric: str) -> DataFrame:
    """``a, b, d, w, lo, hi, gap, far`` for clusters a < b (columns leaf, size, x, and centre and radius of a cover).

    ``d``: distance (of the means; middle of its bounds for complete linkage over a cover), ``w``: product of the sizes,
    ``lo`` and ``hi``: bounds of the linkage distance of the members, ``gap`` and ``far``: least and greatest distance any two members can have. The
    table of clusters is bounded by the leaf count.
    """
    known = "radius" in clusters.columns
    extra = ["centre", "radius"] if known else []
    left = clusters.select(F.col("leaf").alias("a"), F.col("size").alias("na"), "x", *[F.col(c).alias(f"{c}_a") for c in extra])
    right = clusters.select(F.col("leaf").alias("b"), F.col("size").alias("nb"), F.col("x").alias("y"), *[F.col(c).alias(f"{c}_b") for c in extra])
    d = _distance("euclidean" if linkage == "ward" else metric)
    if linkage == "ward":
        d = f"sqrt(2D * na * nb / (na + nb)) * {d}"
    met = left.join(F.broadcast(right), F.col("a") < F.col("b")).withColumn("w", F.expr("CAST(na AS DOUBLE) * nb")).withColumn("d", F.expr(d))
    if not known:
        return met.selectExpr("a", "b", "d", "w", "d AS lo", "d AS hi", "d AS gap", "d AS far")
    between = _distance(metric).replace("zip_with(x, y,", "zip_with(centre_a, centre_b,")
    met = met.withColumn("between", F.expr(between)).withColumn("reach", F.expr("radius_a + radius_b"))
    if linkage == "complete":  # both centres are members
        return met.selectExpr("a", "b", "between + reach / 2 AS d", "w", "between AS lo", "between + reach AS hi",
                              "greatest(between - reach, 0D) AS gap", "between + reach AS far")
    return met.selectExpr("a", "b", "d", "w", "greatest(between - reach, 0D) AS lo", "between + reach AS hi",
                          "greatest(between - reach, 0D) AS gap", "between + reach AS far")


def true_average(pairs: DataFrame, sums: DataFrame) -> DataFrame:
    """``pairs`` with the average distance of all member pairs instead (``sums``: ``a, b, total``), which is no estimate."""
    met = pairs.drop("d", "lo", "hi").join(F.broadcast(sums), ["a", "b"]).withColumn("d", F.col("total") / F.col("w"))
    return met.select("a", "b", "d", "w", F.col("d").alias("lo"), F.col("d").alias("hi"), "gap", "far")


@dataclass
class Merge:
    kept: int        # smallest leaf of the one side
    gone: int        # and of the other
    height: float
    lower: float
    upper: float
    sure: bool       # both sides are certain and would merge first in any case
    certain: bool


def merge_rounds(pairs: DataFrame, radii: dict[int, float], linkage: str, leaves: DataFrame | None = None) -> list[Merge]:
    """Merges of the leaves in ``radii`` (leaf -> radius), children before parents.

    ``pairs`` is read in every round: pass a stored table, in one partition. Ward needs the table of ``leaves``, too.
    """
    spark = pairs.sparkSession
    if linkage == "ward":
        leaves = cut_lineage(leaves.select("leaf", F.col("size").cast("double").alias("size"), "x").repartition(1))
        dims = len(leaves.first()["x"]) if radii else 0
    certain = dict.fromkeys(radii, False)
    width = {leaf: 2 * radius for leaf, radius in radii.items()}  # greatest distance within each cluster
    cluster, made = {leaf: leaf for leaf in radii}, {}
    merges: list[Merge] = []
    while len(set(cluster.values())) > 1:
        moved = spark.createDataFrame(list(cluster.items()), "leaf long, cluster long")
        if linkage == "ward":
            merged = leaves.join(F.broadcast(moved), "leaf").groupBy(F.col("cluster").alias("leaf")).agg(F.sum("size").alias("size"), F.array(
                *[F.sum(F.col("size") * F.col("x")[i]) / F.sum("size") for i in range(dims)]).alias("x"))
            now = _pairs(merged, linkage, "euclidean")
        else:
            now = pairs.join(F.broadcast(moved.toDF("a", "ca")), "a").join(F.broadcast(moved.toDF("b", "cb")), "b").where("ca <> cb")
            height = [F.min("gap").alias("gap"), F.max("far").alias("far")] + [F.max(c).alias(c) if linkage == "complete" else (F.sum(F.col(c) * F.col("w")) / F.sum("w")).alias(c) for c in ("d", "lo", "hi")]
            now = now.groupBy(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).agg(*height)
        rest = ["d", "lo", "hi", "gap", "far"]
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v"), *rest).unionByName(
            now.select(F.col("b").alias("u"), F.col("a").alias("v"), *rest))
        # the same order of pairs from either end, so that the closest pair of all is always mutual
        nearest = both.groupBy("u").agg(
            F.min(F.struct("d", F.least("u", "v").alias("x"), F.greatest("u", "v").alias("y"), "lo", "hi", "far")).alias("p"),
            F.min("gap").alias("gap"), F.slice(F.array_sort(F.collect_list(F.struct("lo", "v"))), 1, 2).alias("lowest"))
        found = {r.u: r for r in nearest.collect()}  # a row per cluster
        for u, r in found.items():
            if width[u] <= r.gap:  # nothing lies closer to a member than the members do
                certain[u] = True
                if u in made:
                    made[u].certain = True
        for u in sorted(found, key=lambda u: (found[u].p.d, u)):
            p = found[u].p
            if u != p.x or found[p.y].p.x != p.x or found[p.y].p.y != p.y:
                continue
            others = [low.lo for r in (found[p.x], found[p.y]) for low in r.lowest if low.v not in (p.x, p.y)]
            sure = certain[p.x] and certain[p.y] and all(p.hi <= low for low in others)
            made[p.x] = Merge(p.x, p.y, p.d, p.lo, p.hi, sure, sure)
            merges.append(made[p.x])
            certain[p.x] = sure
            width[p.x] = max(width[p.x], width[p.y], p.far)
            cluster = {leaf: p.x if c == p.y else c for leaf, c in cluster.items()}
    if merges:
        merges[-1].certain = True  # all points together
    return merges


def merge_leaves(leaves: DataFrame, linkage: str, metric: str) -> list[tuple[int, int, float]]:
    """Merges ``(kept leaf, absorbed leaf, height)`` of the leaves (leaf, size, x), children before parents."""
    radii = {r.leaf: 0.0 for r in leaves.select("leaf").collect()}
    pairs = cut_lineage(_pairs(leaves, linkage, metric).repartition(1))
    return [(m.kept, m.gone, m.height) for m in merge_rounds(pairs, radii, linkage, leaves)]


def linkage_matrix(merges: list[tuple[int, int, float]], sizes: dict[int, int]) -> np.ndarray:
    """Rows ``(a, b, height, size)`` by height, clusters numbered as in a linkage matrix (leaf i: i-th smallest id)."""
    place = {leaf: i for i, leaf in enumerate(sorted(sizes))}
    number, size, out = dict(place), dict(sizes), []
    for step, (kept, gone, height) in enumerate(sorted(merges, key=lambda m: m[2])):  # stable: children stay first
        size[kept] += size[gone]
        out.append((*sorted((number[kept], number[gone])), height, size[kept]))
        number[kept] = len(place) + step
    return np.array(out, dtype=np.float64).reshape(-1, 4)


def cut(z: np.ndarray, m: int, k: int) -> np.ndarray:
    """Leaf -> cluster index (0..k-1, unordered) after the first ``m - k`` merges."""
    parent = list(range(2 * m))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for s in range(m - k):
        a, b = int(z[s, 0]), int(z[s, 1])
        parent[find(a)] = m + s
        parent[find(b)] = m + s
    roots = np.array([find(i) for i in range(m)])
    _, lab = np.unique(roots, return_inverse=True)
    return lab


def canonical(lab: np.ndarray, sizes: np.ndarray, min_ids: np.ndarray) -> np.ndarray:
    """Renumber clusters by total size descending, then smallest member id."""
    k = lab.max() + 1 if len(lab) else 0
    tot = np.bincount(lab, weights=sizes, minlength=k)
    first = np.full(k, np.iinfo(np.int64).max, dtype=np.int64)
    np.minimum.at(first, lab, min_ids.astype(np.int64))
    order = sorted(range(k), key=lambda c: (-tot[c], first[c]))
    remap = np.empty(k, dtype=np.int64)
    remap[order] = np.arange(k)
    return remap[lab]


def certain_cuts(pairs: DataFrame, radii: dict[int, float], merges: list[Merge], labels: DataFrame, ks: list[int], linkage: str) -> dict[int, bool]:
    """Per cut (``labels``: k, leaf, label) whether it is the points' own, for any heights within the bounds."""
    lab = F.broadcast(labels)  # leaves x cuts rows
    met = pairs.join(lab.select("k", F.col("leaf").alias("a"), F.col("label").alias("ca")), "a") \
        .join(lab.select("k", F.col("leaf").alias("b"), F.col("label").alias("cb")), ["k", "b"])
    low = F.max("lo") if linkage == "complete" else F.sum(F.col("lo") * F.col("w")) / F.sum("w")
    rows = met.groupBy("k", F.least("ca", "cb").alias("x"), F.greatest("ca", "cb").alias("y")) \
        .agg(low.alias("lo"), F.min("gap").alias("gap"), F.max("far").alias("far")).collect()  # clusters squared per cut
    member = {(r.k, r.leaf): r.label for r in labels.collect()}
    order, out = sorted(merges, key=lambda m: m.height), {}
    for k in ks:
        own = [r for r in rows if r.k == k]
        width, gap, made = {}, {}, {}
        for leaf, radius in radii.items():
            c = member[k, leaf]
            width[c] = max(width.get(c, 0.0), 2 * radius)
        for r in own:
            if r.x == r.y:
                width[r.x] = max(width[r.x], r.far)
            else:
                gap |= {c: min(gap.get(c, np.inf), r.gap) for c in (r.x, r.y)}
        for m in order[:len(radii) - k]:
            made[member[k, m.kept]] = m
        top = {c: made[c].upper if c in made and made[c].sure else width[c] for c in width}
        known = all(width[c] <= gap.get(c, np.inf) or (c in made and made[c].sure) for c in width)
        out[k] = known and max(top.values()) <= min((r.lo for r in own if r.x != r.y), default=np.inf)
    return out


@dataclass
class Tree:
    leaves: DataFrame       # id, leaf (and part, with part_labels)
    listed: Callable[[], DataFrame]
    leaf_labels: DataFrame  # k, leaf, label
    n_leaves: int
    certain: dict[int, bool]  # per cut: whether it is the points' own
    part_labels: DataFrame | None = None  # k, part, label, where leaves are many: no cut parts the leaves of a part

    @cached_property
    def merges(self) -> DataFrame:
        """``step, left, right, height, size, lower, upper, certain`` (leaf i = i-th smallest leaf id)."""
        return self.listed()

    def _labels(self) -> tuple[str, DataFrame]:
        return ("leaf", self.leaf_labels) if self.part_labels is None else ("part", self.part_labels)

    def labels(self, k: int, id_col: str = "User_ID") -> DataFrame:
        """``id, cluster`` at cut ``k``."""
        by, ll = self._labels()
        ll = ll.where(F.col("k") == k).select(by, F.col("label").alias("cluster"))
        return self.leaves.join(F.broadcast(ll), by).select(id_col, "cluster")

    def labels_all(self, id_col: str = "User_ID") -> DataFrame:
        """``id, k, cluster`` for every cut the tree was built with."""
        by, ll = self._labels()
        ll = ll.select("k", by, F.col("label").alias("cluster"))
        return self.leaves.join(F.broadcast(ll), by).select(id_col, "k", "cluster")

    def tail(self, p: int = 50) -> DataFrame:
        """The last ``p - 1`` merges (the ones a ``lastp`` dendrogram draws)."""
        return self.merges.orderBy(F.desc("step")).limit(max(p - 1, 0))


def build_leaves(points: DataFrame, id_col: str = "User_ID", col: str = "pca") -> tuple[DataFrame, DataFrame]:
    """Stage 1 for Ward: ``(id -> leaf, leaf table (leaf, size, min_id, x))``, a leaf for every different point.

    Leaves are numbered from 0 by smallest id.
    """
    own = points.select(F.col(id_col), F.col(col).alias("x"))
    different = own.groupBy("x").agg(F.count(F.lit(1)).cast("long").alias("size"), F.min(F.col(id_col)).cast("long").alias("min_id"))
    table = cut_lineage(numbered(different, ["min_id", "x"], "leaf").select("leaf", "size", "min_id", "x"))
    return own.join(table.select("leaf", "x"), "x").select(id_col, "leaf"), table


def _listed(merges: DataFrame, n: int) -> DataFrame:
    """Rows of a linkage matrix (``Tree.merges``) of ``MERGE`` rows over ``n`` leaves."""
    steps = numbered(merges, ["height", "node"], "step")
    made = steps.select("node", (F.col("step") + n).alias("place"))
    for side in ("left", "right"):
        steps = steps.join(made.withColumnsRenamed({"node": side, "place": f"{side}_place"}), side, "left")
    left, right = (F.coalesce(f"{side}_place", side) for side in ("left", "right"))
    none = F.lit(None).cast("double")
    return steps.select(F.col("step").cast("int").alias("step"), F.least(left, right).alias("left"), F.greatest(left, right).alias("right"),
                        "height", "size", none.alias("lower"), none.alias("upper"), F.lit(False).alias("certain"))


def ward_tree(points: DataFrame, ks: list[int], id_col: str = "User_ID", col: str = "pca") -> Tree:
    """The tree of all points by Ward's linkage, and its cuts.

    The highest ``max(ks) - 1`` merges tell all cuts apart. Without them the tree falls into parts, and a cut labels parts.
    """
    spark = points.sparkSession
    leaf_of, table = build_leaves(points, id_col, col)
    n = table.count()
    for k in ks:
        if not 1 <= k <= n:
            raise ValueError(f"cannot cut {n} leaves into k={k} clusters")
    rounds, last = ward_merges(table, n)
    late = spark.createDataFrame(last, MERGE)
    merges = reduce(DataFrame.unionByName, rounds, late)
    top = merges.orderBy(F.desc("height"), F.desc("node")).limit(max(ks, default=1) - 1).collect()[::-1]
    off = {m.gone for m in top}
    # every leaf's next leaf up, as far as the stored rounds go: a way is no longer than there are rounds
    up = table.select("leaf", F.col("leaf").alias("root"))
    if rounds:
        early = reduce(DataFrame.unionByName, rounds).where(~F.col("gone").isin(list(off))).select(F.col("gone").alias("leaf"), "kept")
        up = stored(table.select("leaf").join(early, "leaf", "left").select("leaf", F.coalesce("kept", "leaf").alias("root")), "ward-roots")
        for _ in range((len(rounds) - 1).bit_length()):
            further = up.select(F.col("leaf").alias("root"), F.col("root").alias("next"))
            up = stored(up.join(further, "root").select("leaf", F.col("next").alias("root")), "ward-roots")
    # and through the last merges, the latest first: what became of a kept leaf is known by then
    part: dict[int, int] = {}
    for _, kept, gone, *_ in reversed(last):
        if gone not in off:
            part[gone] = part.get(kept, kept)
    ends = F.broadcast(spark.createDataFrame(list(part.items()), "root long, part long"))  # at most a row per cluster of the last merges
    placed = cut_lineage(up.join(ends, "root", "left").select("leaf", F.coalesce("part", "root").alias("part")))
    sizes = sorted(tuple(r) for r in table.join(placed, "leaf").groupBy("part").agg(F.sum("size"), F.min("min_id")).collect())  # max(ks) rows
    rows = []
    for k in ks:
        root = {p: p for p, *_ in sizes}
        for m in top[:len(sizes) - k]:
            root = {p: m.kept if r == m.gone else r for p, r in root.items()}
        lab = np.unique([root[p] for p, *_ in sizes], return_inverse=True)[1]
        lab = canonical(lab, np.array([s for _, s, _ in sizes], float), np.array([i for *_, i in sizes]))
        rows += [(k, p, int(c)) for (p, *_), c in zip(sizes, lab)]
    part_labels = spark.createDataFrame(rows, "k int, part long, label int")
    leaf_labels = placed.join(F.broadcast(part_labels), "part").select("k", "leaf", "label")
    return Tree(cut_lineage(leaf_of.join(placed, "leaf")), lambda: _listed(merges, n), leaf_labels, n, dict.fromkeys(ks, False), part_labels)


def tree_of_leaves(leaf_of: DataFrame, leaves: DataFrame, linkage: str, metric: str, ks: list[int], sums: DataFrame | None = None) -> Tree:
    """Merge tree and cuts of a given leaf table (leaf, size, min_id, x; centre and radius of a cover).

    ``sums`` (``a, b, total``: distance sums of the members) make average linkage that of the members, not of the means.
    """
    metric = check_linkage(linkage, metric)
    spark = leaves.sparkSession
    known = "radius" in leaves.columns
    table = sorted((r.leaf, r["size"], r.min_id, r.radius if known else 0.0) for r in leaves.select(
        "leaf", "size", "min_id", *(["radius"] if known else [])).collect())
    pairs = _pairs(leaves, linkage, metric)
    if sums is not None:
        pairs = true_average(pairs, sums)
    pairs = cut_lineage(pairs.repartition(1))  # at most leaves * (leaves - 1) / 2 rows
    radii = {leaf: radius for leaf, _, _, radius in table}
    found = merge_rounds(pairs, radii, linkage, leaves)
    z = linkage_matrix([(m.kept, m.gone, m.height) for m in found], {leaf: n for leaf, n, *_ in table})
    bounds = sorted(found, key=lambda m: m.height)  # the same order: both sorts are stable
    hidden = linkage == "ward"  # means have no bounds
    merges = spark.createDataFrame(
        [(i, int(a), int(b), float(h), int(n), None if hidden else m.lower, None if hidden else m.upper, m.certain and not hidden)
         for i, ((a, b, h, n), m) in enumerate(zip(z, bounds))],
        "step int, left long, right long, height double, size long, lower double, upper double, certain boolean")
    labels = []
    for k in ks:
        if not 1 <= k <= len(table):
            raise ValueError(f"cannot cut {len(table)} leaves into k={k} clusters")
        lab = canonical(cut(z, len(table), k), np.array([n for _, n, *_ in table], float), np.array([m for _, _, m, _ in table]))
        labels += [(k, leaf, int(c)) for (leaf, *_), c in zip(table, lab)]
    cuts = spark.createDataFrame(labels, "k int, leaf long, label int")
    certain = dict.fromkeys(ks, False) if linkage == "ward" else certain_cuts(pairs, radii, found, cuts, ks, linkage)
    return Tree(leaf_of, lambda: merges, cuts, len(table), certain)


def agglomerate(points: DataFrame, linkage: str, metric: str, ks: list[int], id_col: str = "User_ID",
                col: str = "pca", leaves: int = LEAVES) -> Tree:
    """M8 (+ M10 cuts): merge tree of ``points`` and labels at each k in ``ks``.

    ``leaves`` bounds the leaves of average and complete linkage; Ward merges all points.
    """
    metric = check_linkage(linkage, metric)
    if linkage == "ward":
        return ward_tree(points, ks, id_col, col)
    members, table = cover(points, leaves, metric, id_col, col)
    sums = None
    if linkage == "average" and metric == "manhattan":
        sums = cut_lineage(distance_sums(members, [r.leaf for r in table.select("leaf").collect()], col))
    return tree_of_leaves(members.select(id_col, "leaf"), table, linkage, metric, ks, sums)
