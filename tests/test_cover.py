import numpy as np
import pytest
from pyspark.sql import functions as F

from shopseg.operators import cover as C
from shopseg.operators.hierarchy import agglomerate, tree_of_leaves


def _points(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "User_ID int, pca array<double>")


def _made():
    rng = np.random.default_rng(5)
    return np.concatenate([rng.normal(0, 1, (150, 3)), rng.normal(6, 0.5, (60, 3)), rng.normal([0, 150, 0], 0.2, (4, 3))])


def test_cover_radius_and_niche(spark):
    x = _made()
    members, table = C.cover(_points(spark, x), 20, "manhattan")
    leaf = {r.User_ID: r.leaf for r in members.collect()}
    rows = {r.leaf: r for r in table.collect()}
    assert len(leaf) == len(x) and len(rows) <= 20 and sum(r["size"] for r in rows.values()) == len(x)
    for i, own in leaf.items():
        d = {k: np.abs(x[i] - np.array(r.centre)).sum() for k, r in rows.items()}
        assert d[own] == pytest.approx(min(d.values())) and d[own] <= rows[own].radius + 1e-9
    for k, r in rows.items():
        mine = [i for i in leaf if leaf[i] == k]
        assert r.min_id == min(mine) and np.allclose(r.x, x[mine].mean(0)) and any(np.allclose(x[i], r.centre) for i in mine)
    assert not {leaf[i] for i in range(210, 214)} & {leaf[i] for i in range(210)}  # the niche has leaves of its own
    # farthest-point centres: at most a small factor from any other choice, here from plain selection over all points
    plain = C.furthest_first(np.arange(len(x)), x, 20, "manhattan")
    best = C.distances(x, x[plain], "manhattan").min(1).max()
    assert max(r.radius for r in rows.values()) <= 4 * best


def test_cover_of_equal_and_few_points(spark):
    members, table = C.cover(_points(spark, np.ones((30, 2))), 8, "euclidean")
    assert [(r["size"], r.radius) for r in table.collect()] == [(30, 0.0)]
    members, table = C.cover(_points(spark, np.arange(6.0).reshape(3, 2)), 8, "manhattan")
    assert sorted(r["size"] for r in table.collect()) == [1, 1, 1]


def test_distance_sums_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(C, "ROWS", 16)
    x, rng = np.round(_made(), 1), np.random.default_rng(1)  # with equal values
    leaf = rng.choice([2, 3, 5, 9], len(x), p=[0.7, 0.1, 0.1, 0.1])
    df = spark.createDataFrame([(int(k), [float(v) for v in row]) for k, row in zip(leaf, x)], "leaf long, pca array<double>")
    got = {(r.a, r.b): r.total for r in C.distance_sums(df, [2, 3, 5, 9]).collect()}
    d = np.abs(x[:, None] - x[None]).sum(2)
    assert got.keys() == {(a, b) for a in (2, 3, 5, 9) for b in (2, 3, 5, 9) if a < b}
    for (a, b), total in got.items():
        assert total == pytest.approx(d[np.ix_(leaf == a, leaf == b)].sum())


def _sides(merges, n_leaves):
    """Leaf numbers on both sides of each merge."""
    sets = {i: [i] for i in range(n_leaves)}
    for m in sorted(merges, key=lambda m: m.step):
        yield m, sets[m.left], sets[m.right]
        sets[n_leaves + m.step] = sets[m.left] + sets[m.right]


@pytest.mark.parametrize("linkage", ["average", "complete"])
def test_heights_of_the_points_lie_within_the_bounds(spark, linkage):
    x = _made()
    t = agglomerate(_points(spark, x), linkage, "manhattan", [2, 3], leaves=25)
    leaf = {r.User_ID: r.leaf for r in t.leaves.collect()}
    names = sorted(set(leaf.values()))
    member = {i: [u for u in leaf if leaf[u] == k] for i, k in enumerate(names)}
    d = np.abs(x[:, None] - x[None]).sum(2)
    for m, left, right in _sides(t.merges.collect(), len(names)):
        block = d[np.ix_([u for k in left for u in member[k]], [u for k in right for u in member[k]])]
        height = block.mean() if linkage == "average" else block.max()
        assert m.lower - 1e-9 <= height <= m.upper + 1e-9
        if linkage == "average":
            assert m.height == pytest.approx(height)
    assert t.certain[2]  # the niche is far off: any heights within the bounds cut it off
    lab = {r.User_ID: r.cluster for r in t.labels(2).collect()}
    assert sorted(u for u, c in lab.items() if c == 1) == [210, 211, 212, 213]


def test_uncertain_merges_are_said_to_be(spark):
    x = np.random.default_rng(2).normal(0, 1, (300, 2))
    t = agglomerate(_points(spark, x), "complete", "manhattan", [4], leaves=12)
    assert not t.certain[4] and not all(r.certain for r in t.merges.collect())


def test_singletons_are_certain(spark):
    x = np.array([[0.0], [1.0], [5.0], [6.5], [20.0]])
    for linkage, heights in (("average", [1, 1.5, 5.25, 16.875]), ("complete", [1, 1.5, 6.5, 20])):
        t = agglomerate(_points(spark, x), linkage, "manhattan", [2, 3], leaves=16)
        rows = sorted(t.merges.collect(), key=lambda r: r.step)
        assert [r.height for r in rows] == pytest.approx(heights) and all(r.certain for r in rows)
        assert t.certain == {2: True, 3: True}
        assert [r.lower for r in rows] == [r.upper for r in rows] == [r.height for r in rows]
    t = agglomerate(_points(spark, np.repeat(x, 3, 0)), "ward", "euclidean", [2], leaves=5)
    assert t.certain == {2: False} and all(r.lower is None for r in t.merges.collect())


def test_true_average_of_given_leaves(spark):
    x = _made()
    leaf = np.arange(len(x)) % 5 * 2
    df = spark.createDataFrame([(i, int(k), [float(v) for v in row]) for i, (k, row) in enumerate(zip(leaf, x))], "User_ID int, leaf long, pca array<double>")
    table = df.groupBy("leaf").agg(F.count(F.lit(1)).alias("size"), F.min("User_ID").cast("long").alias("min_id"),
                                   F.array(*[F.avg(F.col("pca")[i]) for i in range(3)]).alias("x"))
    t = tree_of_leaves(df, table, "average", "manhattan", [2], C.distance_sums(df, [0, 2, 4, 6, 8]))
    d = np.abs(x[:, None] - x[None]).sum(2)
    first = min(d[np.ix_(leaf == a, leaf == b)].mean() for a in (0, 2, 4, 6, 8) for b in (0, 2, 4, 6, 8) if a < b)
    assert t.merges.orderBy("step").first().height == pytest.approx(first)


def test_rows_are_summed_per_group():
    from shopseg.operators.cover import rows_summed
    rng = np.random.default_rng(4)
    rows, group = rng.normal(size=(500, 7)), rng.integers(0, 9, 500) * 2
    got = rows_summed(rows, group, 18)
    assert got == pytest.approx(np.stack([rows[group == g].sum(0) for g in range(18)]))
    assert not got[1::2].any()  # groups without rows
    assert not rows_summed(rows[:0], group[:0], 3).any()
