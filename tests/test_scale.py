"""Work that is done once, however many steps read its result."""
import numpy as np
import pytest

from pyspark.sql.functions import broadcast

from shopseg.operators.clean import clean_transactions, coerced_transactions, impute_and_clip
from shopseg.operators.features import user_features
from shopseg.operators.profile import profile_clusters
from shopseg.plans.levels import LevelSpec, mine_levels
from shopseg.plans.segmentation import hybrid_segments
from shopseg.sources.transactions import star_lines


def _counted(spark, df):
    """``df`` through a step that counts the rows it passes."""
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    return df.mapInArrow(passed, df.schema), seen


def test_profile_reads_its_input_once(spark):
    rows = [(i, i % 3, float(i * i % 17)) for i in range(60)]
    df, seen = _counted(spark, spark.createDataFrame(rows, "User_ID int, cluster int, v double"))
    got = {r.cluster: (r.v__count, r.v__mean, r.v__median) for r in profile_clusters(df).collect()}
    for c in range(3):
        v = [r[2] for r in rows if r[1] == c]
        assert got[c] == (20, pytest.approx(np.mean(v)), np.median(v))
    assert seen.value == 60


def test_mining_reads_its_input_once(spark):
    tx, seen = _counted(spark, spark.createDataFrame([(u, f"i{u * k % 5}") for u in range(40) for k in (1, 2)], "User_ID int, item string"))
    segments = spark.createDataFrame([(u, u % 2) for u in range(40)], "User_ID int, cluster int")
    mined = mine_levels(tx, [LevelSpec("all", "item", 0.01, 0.0, 0.0), LevelSpec("all", "item", 0.01, 0.0, 0.0, segment=True)], segments)
    assert mined.rules.count() and mined.summary.count() == 3 and seen.value == 80


def test_a_users_rows_meet_before_the_wide_aggregate(spark):
    tx = spark.createDataFrame([(1, "P", "M", "26-35", 1, "A", 2, 0, 5.0, "3")], "User_ID int, Product_ID string, Gender string, Age string, "
                               "Occupation int, City_Category string, Stay_In_Current_City_Years int, Marital_Status int, Purchase double, Product_Category_str string")
    feats, _ = user_features(tx)
    assert "RebalancePartitions [User_ID" in feats._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_joined_to_customers_with_their_orders(spark, tmp_path):
    for name, schema, row in (
            ("lineitem", "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                         "l_returnflag string, l_linestatus string", (1, 3, 1, 1.0, 2.0, 0.0, 0.0, "A", "F")),
            ("orders", "o_orderkey long, o_custkey long, o_orderpriority string", (1, 2, "1-URGENT")),
            ("customer", "c_custkey long, c_nationkey int", (2, 4)),
            ("part", "p_partkey long, p_brand string, p_type string, p_size int", (3, "Brand#1", "T", 5))):
        spark.createDataFrame([row], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = star_lines(spark, str(tmp_path))
    assert [(r.l_orderkey, r.c_custkey, r.p_partkey, r.c_nationkey) for r in lines.collect()] == [(1, 2, 3, 4)]
    joins = [line for line in lines._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert len(joins) == 3 and "o_custkey" in joins[-1]  # the deepest


TX = ("User_ID int, Product_ID string, Gender string, Age string, Occupation smallint, City_Category string, Stay_In_Current_City_Years string, "
      "Marital_Status tinyint, Product_Category string, Purchase float")


def _shuffles(df):
    """Exchanges of the plan above what is persisted."""
    found, hidden = 0, None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        deep = len(line) - len(line.lstrip(" :+-"))
        if hidden is not None and deep > hidden:
            continue
        hidden = deep if "InMemoryRelation" in line else None
        found += "Exchange hashpartitioning" in line
    return found


def test_features_of_rows_dealt_by_user_shuffle_nothing(spark):
    rows = [(u, None if k == 4 else f"P{u * k % 7}", "FM"[k % 2], f"a{k % 3}", u % 4, "AB"[u % 2], f"{k % 5}+", k % 2, str(1 + u * k % 13), float(u + k * k))
            for u in range(30) for k in range(1, 7)]
    raw = spark.createDataFrame(rows + rows[:40], TX)
    dealt, _ = user_features(clean_transactions(raw, by_user=True), by_user=True)
    assert _shuffles(dealt) == 0
    # a choice of users stays dealt
    some = coerced_transactions(raw, by_user=True).persist()
    some.count()
    few = spark.createDataFrame([(3,), (5,)], "User_ID int")
    kept, _ = user_features(impute_and_clip(some.join(broadcast(few), "User_ID", "left_anti"), 0.01, 0.99), by_user=True)
    assert _shuffles(kept) == 0 and kept.count() == 28
    apart, _ = user_features(clean_transactions(raw))
    assert _shuffles(apart) >= 4
    got, want = ({r.User_ID: r.asDict() for r in f.collect()} for f in (dealt, apart))
    assert got.keys() == want.keys() and len(got) == 30
    for u in got:
        assert got[u] == {c: v if isinstance(v, str) else pytest.approx(v) for c, v in want[u].items()}


def test_rows_are_deduplicated_in_the_shuffle_that_deals_them_by_user(spark):
    rows = [(u, f"P{k}", "F", "a", 1, "A", "2+", 0, "3", float(k)) for u in range(9) for k in range(4)]
    raw = spark.createDataFrame(rows + rows[:11] + [(None, *rows[0][1:])], TX)
    for deduplicated in (False, True):
        dealt = coerced_transactions(raw.where("User_ID IS NOT NULL").distinct() if deduplicated else raw, deduplicated, by_user=True)
        assert _shuffles(dealt) == 1 + deduplicated
        assert sorted(r.User_ID for r in dealt.collect()) == sorted(r[0] for r in rows)
        again = dealt.groupBy("User_ID").count()
        assert _shuffles(again) == 1 + deduplicated and {r["count"] for r in again.collect()} == {4}


def test_hybrid_passes_read_their_rows_once(spark):
    rows = [(u, f"P{u * k % 7}", "FM"[k % 2], f"a{k % 3}", u % 4, "AB"[u % 2], f"{k % 5}", k % 2, str(1 + u * k % 5), float(u + k * k))
            for u in range(400) for k in range(1, 5)]
    raw, seen = _counted(spark, spark.createDataFrame(rows, TX))
    res = hybrid_segments(raw, leaves=8, silhouettes=False)
    assert res.final.count() == 400 and seen.value == 1600
    scans = spark._jsparkSession.sharedState().cacheManager()
    assert scans.lookupCachedData(coerced_transactions(raw, by_user=True)._jdf).isDefined()


def test_modes_of_rows_dealt_by_user_are_counted_not_sorted(spark):
    rows = [(u, f"P{k}", None if u == 3 else "FM"[(u + k) % 2], "bca"[k % 3], 9 if k % 2 else 10, "A", None if u == 4 else str(k % 2), None if k else 1, "3", float(k))
            for u in range(200) for k in range(6)]
    raw = spark.createDataFrame(rows, TX)
    dealt, _ = user_features(clean_transactions(raw, by_user=True), by_user=True)
    assert "mode(" not in dealt._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0]
    modes = ["Age_mode", "Gender_mode", "City_Category_mode", "Stay_mode", "Marital_mode", "Occupation_mode"]
    assert dict(dealt.dtypes)["Stay_mode"] == "smallint"
    got = {r.User_ID: tuple(r)[1:] for r in dealt.select("User_ID", *modes).collect()}
    assert got[3] == ("a", "Unknown", "A", 0, 1, 9) and got[4] == ("a", "F", "A", 0, 1, 9)  # ties: the smallest value
    apart, _ = user_features(clean_transactions(raw))
    assert got == {r.User_ID: tuple(r)[1:] for r in apart.select("User_ID", *modes).collect()} and len(got) == 200
