from pyspark.sql import functions as F

import pytest

from shopseg.plans.segmentation import niche_clusters, reattach, split_users


def test_niche_predicate(spark):
    sizes = spark.createDataFrame([(0, 4000), (1, 75), (2, 47), (3, 60)], "cluster int, size long")
    assert [r.cluster for r in niche_clusters(sizes).collect()] == [2]
    sizes = spark.createDataFrame([(0, 9920), (1, 80)], "cluster int, size long")
    assert [r.cluster for r in niche_clusters(sizes).collect()] == [1]


def test_reattach_labels(spark):
    core = spark.createDataFrame([(1, 0), (2, 1), (3, 2), (4, 3)], "User_ID int, cluster int")
    niche = spark.createDataFrame([(5, 3), (6, 1), (7, 3)], "User_ID int, detect_cluster int")
    got = {r.User_ID: r.cluster for r in reattach(core, niche).collect()}
    assert got == {1: 0, 2: 1, 3: 2, 4: 3, 5: 5, 6: 4, 7: 5}
    empty = spark.createDataFrame([], "User_ID int, detect_cluster int")
    assert reattach(core, empty).count() == 4


def test_split_disjoint(spark):
    labels = spark.createDataFrame([(i, i % 4) for i in range(20)], "User_ID int, cluster int")
    niches = spark.createDataFrame([(1,), (3,)], "cluster int")
    core, niche = split_users(labels, niches)
    c = {r.User_ID for r in core.collect()}
    n = {r.User_ID for r in niche.collect()}
    assert not c & n and c | n == set(range(20))


def test_hybrid_finds_planted_niche(spark):
    from tests.conftest import SF01
    from shopseg.plans.segmentation import hybrid_segments
    from shopseg.sources.transactions import transactions_from_tables
    h = hybrid_segments(transactions_from_tables(spark, SF01, "planted"), silhouettes=False)
    sizes = sorted(r["size"] for r in h.detect_sizes.collect())
    assert sum(sizes) == 1500 and len(sizes) == 4 and 30 in sizes and max(sizes) > 1400
    planted = {r.User_ID for r in h.niche_users.where(F.col("detect_cluster") == 1).collect()}
    assert planted == {u for u in range(0, 1500, 50)}
    final = h.final.collect()
    assert len(final) == 1500 and len({r.User_ID for r in final}) == 1500
    assert max(r.cluster for r in final) == 4 + 3 - 1       # 4 core clusters + 3 niche clusters
    prof = h.profile.collect()
    assert sum(r.n_transactions__count for r in prof) == 1500


def test_all_niche_raises(spark, monkeypatch):
    from tests.conftest import SF001
    from shopseg.plans import segmentation
    from shopseg.sources.transactions import transactions_from_tables
    monkeypatch.setattr(segmentation, "niche_clusters", lambda sizes: sizes.select("cluster"))
    with pytest.raises(ValueError, match="no core"):
        segmentation.hybrid_segments(transactions_from_tables(spark, SF001), leaves=20, silhouettes=False)


def test_hybrid_split_files_and_small_data(spark):
    import tempfile
    from tests.conftest import SF001
    from shopseg.plans.segmentation import hybrid_segments
    from shopseg.sources.transactions import transactions_from_tables
    raw = transactions_from_tables(spark, SF001)
    out = tempfile.mkdtemp(prefix="shopseg-split-")
    h = hybrid_segments(raw, split_path=out)
    split = spark.read.option("header", True).csv(out)
    assert split.count() == raw.count()
    niche_users = {r.User_ID for r in h.niche_users.collect()}
    niche_rows = {int(r.User_ID) for r in split.where(F.col("segment") == "niche").select("User_ID").collect()}
    assert niche_rows == niche_users
    final = {r.User_ID: r.cluster for r in h.final.collect()}
    assert len(final) == 150
    assert all(final[u] >= 4 for u in niche_users)          # niches come after the 4 core labels
    assert -1 <= h.silhouette_core <= 1 and -1 <= h.silhouette_detect <= 1
