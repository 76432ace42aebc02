import random
from itertools import combinations

import numpy as np
import pytest

from shopseg.operators import vertical as V
from shopseg.operators.basket import build_basket
from shopseg.operators.rules import frequent_itemsets, frequent_itemsets_apriori


@pytest.mark.parametrize("na,nb", [(0, 5), (10, 3000), (5000, 20), (30_000, 40_000), (5000, 4500), (65_536, 7)])
def test_intersections_of_all_kinds_of_containers(na, nb):
    rng = np.random.default_rng(na + nb)
    a, b = (np.sort(rng.choice(V.RANGE, n, replace=False)) for n in (na, nb))
    both = V.intersection(V.container(a), V.container(b))
    want = np.intersect1d(a, b)
    assert V.size(both) == len(want) and V.size(V.container(a)) == na
    assert (both.dtype == np.uint8) == (len(want) >= V.DENSE)
    if both.dtype != np.uint8:
        assert both.tolist() == want.tolist()


def _basket(spark, baskets):
    rows = [(lv, u, i) for lv in ("one", "two") for u, b in enumerate(baskets) for i in b]
    params = spark.createDataFrame([("one", 0.2, 0.1, 0.0, None, None, False, "ITEMSETS", 5), ("two", 0.3, 0.1, 0.0, None, None, False, "ITEMSETS", 2)],
                                   "level string, min_support double, min_conf double, min_lift double, top_n int, min_users_abs int, "
                                   "use_base_users boolean, mode string, max_len int")
    return build_basket(spark.createDataFrame(rows, "level string, User_ID int, item string"), params), params


def _brute(baskets):
    want = {}
    for lv, support, longest in (("one", 0.2, 5), ("two", 0.3, 2)):
        for n in range(1, longest + 1):
            for c in combinations("abcdefg", n):
                f = sum(set(c) <= set(b) for b in baskets)
                if f / len(baskets) >= support:
                    want[lv, c] = f
    return want


@pytest.mark.parametrize("small", [False, True])
def test_all_lengths_and_levels(spark, monkeypatch, small):
    rng = random.Random(4)
    baskets = [sorted(rng.sample("abcdefg", rng.randint(1, 7))) for _ in range(60)]
    if small:  # several rounds of candidates and several ranges of users
        monkeypatch.setattr(V, "ROUND", 4)
        monkeypatch.setattr(V, "RANGE", 16)
    bk, params = _basket(spark, baskets)
    got = V.frequent_itemsets_vertical(bk, params).collect()
    assert {(r["level"], tuple(r["items"])): r.freq for r in got} == _brute(baskets) and len(got) == len(_brute(baskets))


def test_equals_the_joins_at_every_length(spark):
    rng = random.Random(9)
    baskets = [sorted(rng.sample("abcdefg", rng.randint(2, 7))) for _ in range(40)]
    bk, _ = _basket(spark, baskets)
    for longest in range(1, 6):
        by_joins = {(tuple(r["items"]), r.freq) for r in frequent_itemsets_apriori(bk, "one", 0.3, longest).collect()}
        assert {(tuple(r["items"]), r.freq) for r in frequent_itemsets(bk, "one", 0.3, longest).collect()} == by_joins
