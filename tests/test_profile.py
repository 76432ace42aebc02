import numpy as np
import pytest

from shopseg.plans import catalog


def test_cluster_profile_has_every_numeric_feature(spark, monkeypatch):
    schema = ("User_ID int, Product_ID string, Gender string, Age string, Occupation smallint, City_Category string, "
              "Stay_In_Current_City_Years string, Marital_Status tinyint, Product_Category float, Purchase float")
    bought = {1: [(1, 10.0), (1, 10.0), (2, 20.0)], 2: [(1, 10.0)], 3: [(2, 20.0), (2, 20.0)], 4: [(2, 20.0), (1, 10.0)]}
    rows = [(u, f"P{u}{i}", "M", "26-35", 1, "A", "1", 0, float(c), p) for u, b in bought.items() for i, (c, p) in enumerate(b)]
    monkeypatch.setattr(catalog, "transactions_from_tables", lambda *a: spark.createDataFrame(rows, schema))
    labels = {1: 0, 2: 0, 3: 1, 4: 1, 9: 1}  # the last bought nothing and has no features
    monkeypatch.setattr(catalog, "region_assignments", lambda *a: spark.createDataFrame(list(labels.items()), "User_ID int, cluster int"))
    got = {(r.cluster, r.feature): (r["count"], r["mean"], r["median"]) for r in catalog.q_cluster_profile(spark, "").collect()}
    features = {f for _, f in got}
    assert {f"{kind}__cat_{c}" for kind in ("cat_share", "cat_rev_share") for c in (1, 2)} <= features
    assert {"n_transactions", "total_purchase", "cat_entropy", "n_unique_categories", "avg_purchase_log1p", "Occupation_mode"} <= features
    assert len(got) == 2 * len(features)
    for cluster, users in ((0, (1, 2)), (1, (3, 4))):
        for c in (1, 2):
            share = [np.mean([k == c for k, _ in bought[u]]) for u in users]
            spent = [sum(p for k, p in bought[u] if k == c) / sum(p for _, p in bought[u]) for u in users]
            assert got[cluster, f"cat_share__cat_{c}"] == pytest.approx((2, np.mean(share), np.median(share)), abs=1e-4)
            assert got[cluster, f"cat_rev_share__cat_{c}"] == pytest.approx((2, np.mean(spent), np.median(spent)), abs=1e-4)
