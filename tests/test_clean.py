import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopseg.functions.quantiles import column_quantiles, quantile_bounds
from shopseg.operators.clean import clean_transactions
from shopseg.sources.transactions import RAW_SCHEMA, TRANSACTION_COLUMNS


def _raw(spark, rows):
    cols = TRANSACTION_COLUMNS
    data = [tuple(r.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(data, RAW_SCHEMA)


def _row(**kw):
    base = dict(User_ID=1, Product_ID="P1", Gender="F", Age="26-35", Occupation=3, City_Category="A",
                Stay_In_Current_City_Years="2", Marital_Status=0, Product_Category="1", Purchase=10.0)
    base.update(kw)
    return base


@pytest.mark.parametrize("method", ["spark", "refine"])
def test_quantiles_fixture(spark, method):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "v double")
    q = column_quantiles(df, ["v"], [0.01, 0.25, 0.5, 0.75, 0.99], method=method, finish=1, bins=2)["v"]
    assert q == pytest.approx([1.03, 1.75, 3.0, 5.5, 9.82])


def test_refine_matches_numpy_with_heavy_duplicates(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=3000), np.zeros(2500), rng.exponential(size=500) * 100])
    rng.shuffle(vals)
    df = spark.createDataFrame([(float(v), float(v) * 3 - 1) for v in vals], "a double, b double")
    probs = [0.0, 0.005, 0.25, 0.5, 0.75, 0.995, 1.0]
    got = column_quantiles(df, ["a", "b"], probs, method="refine", finish=50, bins=16)
    assert got["a"] == pytest.approx(list(np.quantile(vals, probs)), rel=1e-12, abs=1e-12)
    assert got["b"] == pytest.approx(list(np.quantile(vals * 3 - 1, probs)), rel=1e-12, abs=1e-12)
    assert column_quantiles(df, ["a"], probs, method="spark")["a"] == pytest.approx(got["a"])


def test_quantiles_ignore_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    assert column_quantiles(df, ["v"], [0.5], method="refine", finish=1, bins=2)["v"] == [2.0]
    assert column_quantiles(df, ["v"], [0.5])["v"] == [2.0]


def test_clip_fixture(spark):
    rows = [_row(Product_ID=f"P{i}", Purchase=p) for i, p in enumerate([1.0, 2.0, 4.0, 10.0])]
    out = clean_transactions(_raw(spark, rows), 0.01, 0.99).orderBy("Product_ID").collect()
    assert [r.Purchase for r in out] == pytest.approx([1.03, 2.0, 4.0, 9.82])
    same = clean_transactions(_raw(spark, rows), 0.0, 1.0).orderBy("Product_ID").collect()
    assert [r.Purchase for r in same] == [1.0, 2.0, 4.0, 10.0]


def test_coercion_and_fills(spark):
    rows = [
        _row(Product_ID="A", Stay_In_Current_City_Years="4+", Product_Category="3", Purchase=None),
        _row(Product_ID="B", Stay_In_Current_City_Years=None, Product_Category="3.7", Gender=None),
        _row(Product_ID="C", Stay_In_Current_City_Years="junk", Product_Category="abc", Age="NA"),
        _row(Product_ID="D", Stay_In_Current_City_Years="1", Product_Category=None),
        _row(Product_ID="E", Stay_In_Current_City_Years="1", Product_Category="NaN"),
    ]
    out = {r.Product_ID: r for r in clean_transactions(_raw(spark, rows), 0.0, 1.0).collect()}
    assert out["A"].Stay_In_Current_City_Years == 4
    assert out["A"].Product_Category_str == "cat_3"
    assert out["A"].Purchase == 0.0
    # Stay NULL / junk -> table-wide mode (1 appears twice, 4 once)
    assert out["B"].Stay_In_Current_City_Years == 1 and out["C"].Stay_In_Current_City_Years == 1
    assert out["B"].Product_Category_str == "cat_unknown"      # fractional -> unknown (not 3)
    assert out["C"].Product_Category_str == "cat_unknown"
    assert out["D"].Product_Category_str == "cat_unknown"
    assert out["E"].Product_Category_str == "cat_unknown"
    assert out["B"].Gender == "Unknown" and out["C"].Age == "Unknown"


def test_exact_duplicates_dropped_after_float_rounding(spark):
    rows = [_row(Purchase=10.000000001), _row(Purchase=10.0), _row(Purchase=11.0)]
    assert clean_transactions(_raw(spark, rows), 0.0, 1.0).count() == 2


def test_global_mode_tie_and_all_null(spark):
    rows = [_row(Product_ID="A", Stay_In_Current_City_Years="3"), _row(Product_ID="B", Stay_In_Current_City_Years="2"),
            _row(Product_ID="C", Stay_In_Current_City_Years=None)]
    out = {r.Product_ID: r for r in clean_transactions(_raw(spark, rows), 0.0, 1.0).collect()}
    assert out["C"].Stay_In_Current_City_Years == 2          # tie -> smallest
    rows = [_row(Product_ID="A", Stay_In_Current_City_Years=None)]
    out = clean_transactions(_raw(spark, rows), 0.0, 1.0).collect()
    assert out[0].Stay_In_Current_City_Years == 0            # all NULL -> 0


def test_quantile_bounds_mapping(spark):
    from tests.conftest import SF01
    from shopseg.sources.transactions import transactions_from_tables
    from shopseg.operators.clean import typed_deduplicated
    d = typed_deduplicated(transactions_from_tables(spark, SF01))
    lo, hi = quantile_bounds(d.select(F.col("Purchase").cast("double").alias("p")), ["p"], 0.01, 0.99)["p"]
    assert math.isclose(lo, 1909.713, abs_tol=1e-3) and math.isclose(hi, 103940.157, abs_tol=1e-3)


def test_csv_read_path_matches_table_path(spark):
    import tempfile
    from tests.conftest import SF001
    from shopseg.sources.transactions import read_transactions, transactions_from_tables
    raw = transactions_from_tables(spark, SF001, "dirty")
    path = tempfile.mkdtemp(prefix="shopseg-csv-") + "/tx.csv"
    # write text the way a pandas-produced CSV looks: missing values as empty or NA tokens
    text = raw.select(*[F.coalesce(F.col(c).cast("string"), F.lit("NA" if c == "Age" else "")).alias(c)
                        for c in raw.columns])
    text.coalesce(1).write.option("header", True).csv(path)
    from_csv = clean_transactions(read_transactions(spark, path), 0.01, 0.99)
    direct = clean_transactions(raw, 0.01, 0.99)
    assert from_csv.count() == direct.count()
    assert from_csv.exceptAll(direct).count() == 0


def test_keyed_and_grouped_quantiles_match_pandas(spark):
    import pandas as pd
    from shopseg.functions.quantiles import grouped_quantiles, quantiles_by_key
    rng = np.random.default_rng(12)
    keys = np.concatenate([np.zeros(3000, dtype=int), rng.integers(1, 40, size=1000)])   # one dominant key
    vals = np.round(rng.gamma(2.0, 10.0, size=len(keys)), 1)                           # many ties
    pdf = pd.DataFrame({"g": keys, "v": vals, "w": vals * -2})
    df = spark.createDataFrame(pdf)
    long = df.selectExpr("CAST(g AS BIGINT) AS ci", "CAST(v AS DOUBLE) AS v")
    probs = [0.01, 0.5, 0.99]
    got = quantiles_by_key(long, probs, method="refine", bins=8, finish=50)
    exp = pdf.groupby("g")["v"].quantile(probs).unstack()
    for k, row in exp.iterrows():
        assert got[k] == pytest.approx(list(row.values), abs=1e-9)
    builtin = quantiles_by_key(long, probs, method="spark")
    assert set(builtin) == set(got)
    for k in got:
        assert builtin[k] == pytest.approx(got[k], abs=1e-9)
    gq = grouped_quantiles(df, "g", ["v", "w"], [0.5], method="refine", bins=8, finish=50)
    for k in exp.index:
        assert gq[(k, "v")][0] == pytest.approx(exp.loc[k, 0.5])
        assert gq[(k, "w")][0] == pytest.approx(pdf[pdf.g == k]["w"].median())


def test_default_quantiles_of_many_rows(spark):
    from pyspark import StorageLevel
    n = 150_000
    df = spark.range(n).selectExpr("CAST((id * 7919) % 100003 AS DOUBLE) / 7.0D AS v",
                                   "CAST(id % 17 AS DOUBLE) AS w")
    ids = np.arange(n)
    v = ((ids * 7919) % 100003) / 7.0
    w = (ids % 17).astype(float)
    probs = [0.005, 0.25, 0.5, 0.75, 0.995]
    for frame in (df, df.persist(StorageLevel.MEMORY_AND_DISK)):   # uncached and cached inputs
        got = column_quantiles(frame, ["v", "w"], probs)
        assert got["v"] == pytest.approx(list(np.quantile(v, probs)), abs=1e-9)
        assert got["w"] == pytest.approx(list(np.quantile(w, probs)), abs=1e-9)


def test_stay_text_and_null_users(spark):
    from shopseg.functions.scalar import strip_plus_to_int
    from shopseg.operators.features import user_features
    from pyspark.sql import functions as F
    cells = [("2.0", 2), ("4+", 4), (" 3 ", 3), ("2.5", None), ("x", None), (None, None), ("400", None), ("NaN", None)]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cells)], "i int, s string")
    got = {r.i: r.v for r in df.select("i", strip_plus_to_int(F.col("s")).alias("v")).collect()}
    assert got == {i: c[1] for i, c in enumerate(cells)}
    from tests.conftest import SF001
    from shopseg.sources.transactions import transactions_from_tables
    raw = transactions_from_tables(spark, SF001, "dirty")
    assert raw.where("User_ID IS NULL").count() > 0
    tx = clean_transactions(raw)
    assert tx.where("User_ID IS NULL").count() == 0
    assert user_features(tx)[0].where("User_ID IS NULL").count() == 0


def test_optional_assignments_paths(spark, tmp_path):
    from shopseg.sources.transactions import optional_assignments
    path = f"file://{tmp_path}/labels"
    assert optional_assignments(spark, None) is None and optional_assignments(spark, path) is None
    df = spark.createDataFrame([(1, 2)], "User_ID int, cluster int")
    df.write.parquet(path)
    assert [tuple(r) for r in optional_assignments(spark, path).collect()] == [(1, 2)]
    assert [tuple(r) for r in optional_assignments(spark, df).collect()] == [(1, 2)]


def test_checkpoint_folder_must_be_shared_off_local(monkeypatch):
    import pytest as pt
    from types import SimpleNamespace as N
    from shopseg.session import checkpoint_dir
    sc = N(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pt.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(N(sparkContext=sc, conf=N(get=lambda *a: None)))
