import math

import pytest
from pyspark.sql import functions as F

from shopseg.operators.features import share_long, user_features


def _tx(spark, rows):
    schema = ("User_ID int, Product_ID string, Gender string, Age string, Occupation smallint, "
              "City_Category string, Stay_In_Current_City_Years tinyint, Marital_Status tinyint, "
              "Product_Category smallint, Purchase double, Product_Category_str string")
    return spark.createDataFrame(rows, schema)


def _r(u, p, cat, purchase, gender="M", age="26-35", occ=1, city="A", stay=1, mar=0):
    label = f"cat_{cat}" if cat is not None else "cat_unknown"
    return (u, p, gender, age, occ, city, stay, mar, cat, purchase, label)


def test_feature_fixture(spark):
    rows = [_r(1, "P1", 1, 10.0), _r(1, "P2", 1, 20.0), _r(1, "P2", 2, 60.0), _r(2, "P3", None, 40.0)]
    f, buckets = user_features(_tx(spark, rows), top_cat=10)
    assert buckets == ["cat_1", "cat_2", "cat_unknown"]
    u = {r.User_ID: r for r in f.collect()}
    a = u[1]
    assert (a.n_transactions, a.total_purchase, a.avg_purchase, a.median_purchase) == (3, 90.0, 30.0, 20.0)
    assert a.std_purchase == pytest.approx(26.457513, abs=1e-6)
    assert a.unique_products == 2
    assert a.avg_purchase_log1p == pytest.approx(3.433987, abs=1e-6)
    assert a.median_purchase_log1p == pytest.approx(3.044522, abs=1e-6)
    assert a.std_purchase_log1p == pytest.approx(3.312640, abs=1e-6)
    assert a["cat_share__cat_1"] == pytest.approx(2 / 3) and a["cat_share__cat_2"] == pytest.approx(1 / 3)
    assert a["cat_share__cat_unknown"] == 0.0
    assert a["cat_rev_share__cat_1"] == pytest.approx(1 / 3) and a["cat_rev_share__cat_2"] == pytest.approx(2 / 3)
    assert a.n_unique_categories == 2
    assert a.cat_entropy == pytest.approx(0.636514, abs=1e-6)
    b = u[2]
    assert b.std_purchase == 0.0 and b["cat_share__cat_unknown"] == 1.0 and b.n_unique_categories == 1
    assert b.cat_entropy == pytest.approx(5.526e-11, rel=1e-3)


def test_modes_ties_and_nulls(spark):
    rows = [_r(1, "P1", 1, 1.0, gender="b"), _r(1, "P2", 1, 1.0, gender="a"), _r(1, "P3", 1, 1.0, gender="a"),
            _r(1, "P4", 1, 1.0, gender="b"), _r(1, "P5", 1, 1.0, gender=None),
            _r(2, "P1", 1, 1.0, gender="M"), _r(2, "P2", 1, 1.0, gender="F"), _r(2, "P3", 1, 1.0, gender="M"),
            _r(2, "P4", 1, 1.0, gender="F"),
            _r(3, "P1", 1, 1.0, gender=None, stay=None)]
    f, _ = user_features(_tx(spark, rows))
    u = {r.User_ID: r for r in f.collect()}
    assert u[1].Gender_mode == "a" and u[2].Gender_mode == "F"
    assert u[3].Gender_mode == "Unknown" and u[3].Stay_mode == -1


def test_other_bucket_and_invariants(spark):
    from tests.conftest import SF001
    from shopseg.operators.clean import clean_transactions
    from shopseg.sources.transactions import transactions_from_tables
    tx = clean_transactions(transactions_from_tables(spark, SF001))
    f, buckets = user_features(tx, top_cat=10)
    assert len(buckets) == 11 and "cat_other" in buckets
    long = share_long(f, buckets)
    sums = long.groupBy("User_ID").agg(F.sum("share").alias("s"), F.sum("rev_share").alias("r")).collect()
    assert all(abs(r.s - 1) < 1e-9 or r.s == 0 for r in sums)
    assert all(abs(r.r - 1) < 1e-9 or r.r == 0 for r in sums)
    ent = f.select("cat_entropy", "n_unique_categories").collect()
    assert all(0 <= r.cat_entropy <= math.log(len(buckets)) + 1e-9 for r in ent)
    assert f.count() == 150


def test_medians_of_heavy_and_light_users(spark):
    import numpy as np
    rng = np.random.default_rng(2)
    vals = np.round(rng.exponential(50, size=400), 2)
    rows = [_r(1, f"P{i}", i % 3, float(v)) for i, v in enumerate(vals)]
    rows += [_r(2, "P1", 1, 5.0), _r(2, "P2", 2, 7.0), _r(3, "P1", 1, 3.0)]
    tx = _tx(spark, rows)
    a = {r.User_ID: r.median_purchase for r in user_features(tx)[0].collect()}
    b = {r.User_ID: r.m for r in tx.groupBy("User_ID").agg(F.median("Purchase").alias("m")).collect()}
    assert a == pytest.approx(b)
    assert a[1] == pytest.approx(float(np.median(vals)))
    assert a[2] == 6.0 and a[3] == 3.0
