import numpy as np
import pytest

from shopseg.operators.matrix import one_hot, pca_by_variance, robust_scale, winsorize_features
from shopseg.operators.principal import principal_axes


def test_robust_scale_zero_iqr(spark):
    df = spark.createDataFrame([(i, float(v), float(i)) for i, v in enumerate([0, 0, 0, 0, 0, 5])],
                               "User_ID int, a double, b double")
    out = robust_scale(df, ["a", "b"]).orderBy("User_ID").collect()
    assert [r.a for r in out] == [0, 0, 0, 0, 0, 5]            # IQR 0 -> divide by 1
    assert [r.b for r in out] == pytest.approx([(i - 2.5) / 2.5 for i in range(6)])


def test_winsorize_guard_and_modes(spark):
    df = spark.createDataFrame([(i, float(i), i % 3) for i in range(101)], "User_ID int, v double, Stay_mode smallint")
    same = winsorize_features(df, 0.0, 1.0)
    assert same is df
    w = winsorize_features(df, 0.05, 0.95).orderBy("User_ID").collect()
    assert w[0].v == 5.0 and w[-1].v == 95.0 and w[50].v == 50.0
    assert w[0].User_ID == 0                                    # id untouched
    w2 = winsorize_features(df, 0.05, 0.95, include_mode_columns=False)
    assert dict(w2.dtypes)["Stay_mode"] == "smallint"


def test_one_hot_keeps_all_levels(spark):
    df = spark.createDataFrame([(1, "b", 2), (2, "a", 10), (3, "b", 2)], "User_ID int, g string, s int")
    enc, names = one_hot(df, ["g", "s"])
    assert names == ["g=a", "g=b", "s=2", "s=10"]
    rows = {r.User_ID: r for r in enc.collect()}
    assert (rows[2]["g=a"], rows[2]["g=b"], rows[2]["s=10"]) == (1.0, 0.0, 1.0)
    unseen = spark.createDataFrame([(4, "c", 3)], "User_ID int, g string, s int")
    enc2, _ = one_hot(unseen, ["g", "s"], {"g": ["a", "b"], "s": [2, 10]})
    r = enc2.collect()[0]
    assert [r["g=a"], r["g=b"], r["s=2"], r["s=10"]] == [0.0, 0.0, 0.0, 0.0]


def test_pca_variance_rule_and_distances(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 2)) @ np.array([[3.0, 0.0, 1.0, 0.5], [0.0, 1.0, 0.2, 0.1]])
    x = base + rng.normal(scale=0.05, size=base.shape)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "User_ID int, x array<double>")
    proj, res = pca_by_variance(df, 0.8, center=True)
    xc = x - x.mean(0)
    ev = np.sort(np.linalg.eigvalsh(np.cov(xc.T)))[::-1]
    ratios = ev / ev.sum()
    m = int(np.searchsorted(np.cumsum(ratios), 0.8, side="right") + 1)
    assert res.n_components == m
    assert res.explained == pytest.approx(list(ratios[:m]), abs=1e-9)
    p = np.array([r.pca for r in proj.orderBy("User_ID").collect()])
    assert np.allclose(p.mean(0), 0, atol=1e-9)
    full, _ = pca_by_variance(df, 4)
    f = np.array([r.pca for r in full.orderBy("User_ID").collect()])
    d1 = np.linalg.norm(f[:, None] - f[None], axis=2)
    d0 = np.linalg.norm(x[:, None] - x[None], axis=2)
    assert np.allclose(d0, d1, atol=1e-8)                       # full rotation keeps distances


@pytest.mark.parametrize("d, target", [(1, 0.8), (3, 2), (12, 0.95), (40, 0.5), (40, 0.999), (40, 7)])
def test_principal_axes_solve_the_eigenproblem(d, target):
    rng = np.random.default_rng(d)
    cov = np.cov((rng.normal(size=(500, d)) * 0.8 ** np.arange(d)).T).reshape(d, d)
    values, axes = principal_axes(cov, target)
    want = np.linalg.eigvalsh(cov)[::-1]
    m = target if isinstance(target, int) else int((np.cumsum(want) / want.sum() <= target).sum()) + 1
    assert len(values) == m
    assert np.allclose(values, want[:m], rtol=1e-10)
    assert np.linalg.norm(cov @ axes - axes * values, axis=0).max() <= 1e-10 * want[0]
    assert np.allclose(axes.T @ axes, np.eye(m), atol=1e-10)
    assert all(v[np.abs(v).argmax()] > 0 for v in axes.T)


def test_principal_axes_of_equal_and_zero_variances():
    values, axes = principal_axes(np.eye(6), 0.6)
    assert np.allclose(values, 1) and axes.shape == (6, 4)
    values, axes = principal_axes(np.zeros((3, 3)), 0.8)
    assert list(values) == [0] and axes.shape == (3, 1)
    low = np.outer([1.0, 2.0, 2.0], [1.0, 2.0, 2.0])              # rank one, more axes asked than it has
    values, axes = principal_axes(low, 3)
    assert np.allclose(values, [9, 0, 0]) and np.allclose(axes[:, 0], [1 / 3, 2 / 3, 2 / 3])


def test_pca_keeps_digits_under_large_means(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3)) * [1.0, 0.5, 0.1] + 1e7
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "User_ID int, x array<double>")
    _, res = pca_by_variance(df, 3)
    want = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert res.explained == pytest.approx(list(want / want.sum()), abs=1e-6)
