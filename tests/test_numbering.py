from pyspark.sql import functions as F

from shopseg.functions.numbering import numbered


def test_numbered_whole_table(spark):
    rows = [(None if i % 7 == 0 else i * 37 % 101, i) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, i int")
    got = numbered(df, ["k", "i"], "at").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [(r.k, r.i) for r in sorted(got, key=lambda r: r["at"])] == want
    assert sorted(r["at"] for r in got) == list(range(300))


def test_numbered_per_group_with_a_hot_and_a_null_group(spark):
    rows = [("hot" if i % 3 else None if i % 2 else f"g{i % 4}", i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, i int")
    got = numbered(df, ["g", F.desc("i")], "at", by=["g"]).collect()
    for g in {r[0] for r in rows}:
        own = sorted((r for r in got if r.g == g), key=lambda r: r["at"])
        assert [r["at"] for r in own] == list(range(len(own)))
        assert [r.i for r in own] == sorted((i for h, i in rows if h == g), reverse=True)


def test_numbered_empty(spark):
    assert numbered(spark.createDataFrame([], "k int"), ["k"]).collect() == []
