import tempfile

from pyspark.sql import functions as F

from shopseg.sources.transactions import TRANSACTION_COLUMNS, transactions_from_tables, write_split
from shopseg.streaming.split import split_stream


def test_stream_split_matches_batch(spark):
    from tests.conftest import SF001
    src = tempfile.mkdtemp(prefix="shopseg-src-")
    raw = transactions_from_tables(spark, SF001).select(*TRANSACTION_COLUMNS)
    raw.repartition(3).write.mode("overwrite").option("header", True).csv(src)
    users = raw.select("User_ID").distinct()
    seg = users.select("User_ID", F.when(F.col("User_ID") % 7 == 0, "niche").otherwise("core").alias("segment"))
    out_s = tempfile.mkdtemp(prefix="shopseg-stream-")
    split_stream(spark, src, seg, out_s, max_files_per_trigger=1)
    out_b = tempfile.mkdtemp(prefix="shopseg-batch-")
    write_split(spark.read.option("header", True).csv(src), seg, out_b)
    s = spark.read.option("header", True).csv(out_s)
    b = spark.read.option("header", True).csv(out_b)
    assert s.count() == b.count() == raw.count()
    assert s.exceptAll(b).count() == 0
    counts = {r.segment: r["count"] for r in s.groupBy("segment").count().collect()}
    assert set(counts) == {"core", "niche"}


def test_stream_split_reruns_are_incremental(spark):
    from tests.conftest import SF001
    src = tempfile.mkdtemp(prefix="shopseg-src2-")
    raw = transactions_from_tables(spark, SF001).select(*TRANSACTION_COLUMNS)
    first, second = raw.randomSplit([0.5, 0.5], seed=3)
    first.coalesce(1).write.mode("overwrite").option("header", True).csv(src + "/part1")
    seg = raw.select("User_ID").distinct().select("User_ID", F.lit("core").alias("segment"))
    out = tempfile.mkdtemp(prefix="shopseg-out2-")
    ckpt = tempfile.mkdtemp(prefix="shopseg-ck2-")
    # the stream watches one folder; the second part arrives later as a new file in it
    split_stream(spark, src + "/part1", seg, out, checkpoint=ckpt)
    n1 = spark.read.option("header", True).csv(out).count()
    split_stream(spark, src + "/part1", seg, out, checkpoint=ckpt)          # rerun: nothing new
    assert spark.read.option("header", True).csv(out).count() == n1 == first.count()
    second.coalesce(1).write.mode("append").option("header", True).csv(src + "/part1")
    split_stream(spark, src + "/part1", seg, out, checkpoint=ckpt)          # only the new file
    assert spark.read.option("header", True).csv(out).count() == raw.count()


def test_new_files_arrive_with_the_default_checkpoint(spark):
    src, out = tempfile.mkdtemp(prefix="shopseg-src3-"), tempfile.mkdtemp(prefix="shopseg-out3-")
    seg = spark.createDataFrame([(i, "core") for i in range(3)], "User_ID int, segment string")
    for i in range(3):
        row = spark.createDataFrame([(str(i), *["1"] * 9)], ", ".join(f"{c} string" for c in TRANSACTION_COLUMNS))
        row.coalesce(1).write.mode("append").option("header", True).csv(src)
        split_stream(spark, src, seg, out)
        assert spark.read.option("header", True).csv(out).count() == i + 1
