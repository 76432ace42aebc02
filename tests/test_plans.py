import tempfile

import numpy as np
import pytest

from shopseg.plans.segmentation import choose_k, segment_variant


def _points(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "User_ID int, pca array<double>")


def test_variants_and_choose_k(spark):
    rng = np.random.default_rng(4)
    centers = np.array([[0, 0], [8, 0], [0, 8]])
    x = np.concatenate([rng.normal(c, 0.4, (30, 2)) for c in centers])
    pts = _points(spark, x)
    best, scores, _ = choose_k(pts, "ward", "euclidean", 2, 6)
    assert best == 3 and [k for k, _ in scores] == [2, 3, 4, 5, 6]
    assert max(scores, key=lambda t: t[1])[0] == 3
    r = segment_variant(pts, "test3")
    assert r.k == 3 and (r.linkage, r.metric) == ("ward", "euclidean")
    sizes = sorted(row["count"] for row in r.labels.groupBy("cluster").count().collect())
    assert sizes == [30, 30, 30]
    r1 = segment_variant(pts, "test1")
    assert r1.k in (4, 5) and len(r1.scores) == 2
    with pytest.raises(ValueError):
        segment_variant(pts, "nope")


def test_assignment_roundtrip_and_optional_levels(spark):
    from tests.conftest import SF001
    from shopseg.operators.clean import basket_transactions
    from shopseg.plans.levels import production_levels
    from shopseg.sources.transactions import (optional_assignments, read_assignments, region_assignments,
                                              transactions_from_tables, write_table)
    out = tempfile.mkdtemp(prefix="shopseg-asg-") + "/final_user_clusters.csv"
    asg = region_assignments(spark, SF001)
    write_table(asg, out, "csv")
    back = read_assignments(spark, out)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, asg.collect()))
    assert optional_assignments(spark, out + ".missing") is None
    bt = basket_transactions(transactions_from_tables(spark, SF001))
    without = {r.level for r in production_levels(bt, None).summary.collect()}
    assert without == {"category", "product"}
    with_seg = {r.level for r in production_levels(bt, back).summary.collect()}
    assert with_seg == without | {f"cluster_{i}_category" for i in range(5)}
