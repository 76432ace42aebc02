import numpy as np
import pytest

from shopseg.operators import hierarchy, ward
from shopseg.operators.hierarchy import agglomerate, canonical, cut, linkage_matrix, merge_leaves


def _brute(x, linkage, metric):
    """Plain sequential agglomeration (reference implementation for tests)."""
    n = len(x)
    clusters = {i: [i] for i in range(n)}
    if metric == "manhattan":
        d = np.abs(x[:, None, :] - x[None, :, :]).sum(2)
    else:
        d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))
    heights = []
    labels_at = {}
    while len(clusters) > 1:
        keys = sorted(clusters)
        best = None
        for i, a in enumerate(keys):
            for b in keys[i + 1:]:
                A, B = clusters[a], clusters[b]
                if linkage == "average":
                    v = d[np.ix_(A, B)].mean()
                elif linkage == "complete":
                    v = d[np.ix_(A, B)].max()
                else:
                    ca, cb = x[A].mean(0), x[B].mean(0)
                    v = np.sqrt(2 * len(A) * len(B) / (len(A) + len(B))) * np.linalg.norm(ca - cb)
                if best is None or v < best[0]:
                    best = (v, a, b)
        v, a, b = best
        clusters[a] = clusters[a] + clusters.pop(b)
        heights.append(v)
        labels_at[len(clusters)] = sorted(sorted(c) for c in clusters.values())
    return np.array(heights), labels_at


def _tree(spark, x, linkage, metric):
    """Linkage matrix with every point a leaf of its own."""
    leaves = spark.createDataFrame([(i, 1, [float(v) for v in row]) for i, row in enumerate(x)], "leaf long, size long, x array<double>")
    return linkage_matrix(merge_leaves(leaves, linkage, metric), {i: 1 for i in range(len(x))})


@pytest.mark.parametrize("linkage,metric", [("average", "manhattan"), ("complete", "manhattan"),
                                            ("ward", "euclidean"), ("average", "euclidean")])
def test_rounds_match_sequential(spark, linkage, metric):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (25, 3)), rng.normal(5, 1, (20, 3)), rng.normal(-4, 0.5, (15, 3))])
    z = _tree(spark, x, linkage, metric)
    heights, labels_at = _brute(x, linkage, metric)
    assert np.allclose(np.sort(z[:, 2]), np.sort(heights))
    assert np.all(np.diff(z[:, 2]) >= -1e-12)
    for k in (2, 3, 4, 7):
        lab = cut(z, len(x), k)
        groups = sorted(sorted(np.flatnonzero(lab == c).tolist()) for c in range(k))
        assert groups == labels_at[k]


def test_fixture_points_heights_and_cut(spark):
    x = np.array([[0.0], [1.0], [5.0], [6.0], [20.0]])
    exp = {"average": [1, 1, 5, 17], "complete": [1, 1, 6, 20], "ward": [1, 1, 7.071068, 21.503488]}
    for lk, h in exp.items():
        z = _tree(spark, x, lk, "euclidean" if lk == "ward" else "manhattan")
        assert z[:, 2] == pytest.approx(h, abs=1e-6)
        assert z[:, 3].tolist() == [2, 2, 4, 5]
        lab = canonical(cut(z, 5, 3), np.ones(5), np.arange(5))
        assert lab.tolist() == [0, 0, 1, 1, 2]


def _points(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "User_ID int, pca array<double>")


def test_agglomerate_separated_groups(spark):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(0, 0.3, (40, 2)), rng.normal(6, 0.3, (30, 2)), rng.normal([0, 8], 0.3, (10, 2))])
    pts = _points(spark, x)
    t = agglomerate(pts, "average", "manhattan", [3], leaves=30)
    assert t.n_leaves <= 30 and t.merges.count() == t.n_leaves - 1
    lab = {r.User_ID: r.cluster for r in t.labels(3).collect()}
    assert [sum(1 for v in lab.values() if v == c) for c in range(3)] == [40, 30, 10]
    assert lab[0] == 0 and lab[40] == 1 and lab[70] == 2
    m = agglomerate(pts, "complete", "manhattan", [3], leaves=20)
    assert {r.User_ID: r.cluster for r in m.labels(3).collect()} == lab
    assert m.tail(5).count() == 4
    with pytest.raises(ValueError):
        agglomerate(pts, "ward", "manhattan", [3])


@pytest.mark.parametrize("few", [8192, 20])
def test_ward_merges_all_points_whatever_the_leaves(spark, monkeypatch, few):
    monkeypatch.setattr(hierarchy, "ward_merges", lambda leaves, n: ward.ward_merges(leaves, n, few))
    monkeypatch.setattr(ward, "BLOCK_MIN", 7)
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (20, 3)), rng.normal(5, 1, (15, 3)), rng.normal(-4, 0.5, (10, 3)), [[90, 90, 90], [91, 90, 90]]])
    heights, labels_at = _brute(x, "ward", "euclidean")
    t = agglomerate(_points(spark, x), "ward", "euclidean", [2, 3, 4, 9], leaves=5)
    rows = t.merges.orderBy("step").collect()
    assert t.n_leaves == len(x) and [r.height for r in rows] == pytest.approx(np.sort(heights))
    sides = {i: {i} for i in range(len(x))}
    for r in rows:
        sides[len(x) + r.step] = sides[r.left] | sides[r.right]
        assert len(sides[len(x) + r.step]) == r["size"]
    got = {}
    for r in t.labels_all().collect():
        got.setdefault(r.k, {}).setdefault(r.cluster, []).append(r.User_ID)
    assert {k: sorted(sorted(v) for v in c.values()) for k, c in got.items()} == {k: labels_at[k] for k in (2, 3, 4, 9)}
    assert all([len(c[i]) for i in range(k)] == sorted(map(len, c.values()), reverse=True) for k, c in got.items())
    assert t.leaf_labels.where("k = 9").select("leaf").distinct().count() == len(x)


def test_ward_of_equal_points_and_equal_distances(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "ward_merges", lambda leaves, n: ward.ward_merges(leaves, n, 4))
    x = np.array([[i, j] for i in range(3) for j in range(4)] * 3, float)
    t = agglomerate(_points(spark, x), "ward", "euclidean", [2, 5])
    merges = t.merges.collect()
    assert t.n_leaves == 12 and len(merges) == 11
    # whatever pairs ties choose, the squared heights add up to twice the squared distances to the mean
    assert sum(r.height ** 2 for r in merges) == pytest.approx(2 * ((x - x.mean(0)) ** 2).sum())
    lab = {r.User_ID: r.cluster for r in t.labels(5).collect()}
    assert len(lab) == 36 and len(set(lab.values())) == 5
    assert all(lab[i] == lab[i + 12] == lab[i + 24] for i in range(12))
    with pytest.raises(ValueError):
        agglomerate(_points(spark, x), "ward", "euclidean", [13])


def test_nearest_clusters_as_by_all_pairs():
    rng = np.random.default_rng(8)
    x, size = 1e4 + rng.normal(0, 1, (150, 4)), rng.integers(1, 9, 150).astype(float)
    x[40:60] = x[0] + 1e-7 * rng.integers(0, 3, (20, 4))  # closer than a matrix product can tell
    d = ((x[:, None] - x[None]) ** 2).sum(2) / (1 / size[:, None] + 1 / size[None])
    np.fill_diagonal(d, np.inf)
    a, b = (ward._Clusters(np.arange(150)[at], size[at], x[at], np.zeros(4)) for at in (slice(0, 100), slice(100, 150)))
    ward._meet(a, a, True)
    ward._meet(b, b, True)
    ward._meet(a, b, True)
    for side in (a, b):
        assert side.v == pytest.approx(d[side.leaf].min(1), rel=1e-9, abs=0)
        assert d[side.leaf, side.nn] == pytest.approx(d[side.leaf].min(1), rel=1e-9, abs=0)
