import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shopseg.sources import runs
from shopseg.sources.transactions import RAW_SCHEMA, read_transactions, read_transactions_rescued


def _root():
    return tempfile.mkdtemp(prefix="shopseg-runs-")


def test_commit_read_and_rerun(spark):
    root = _root()
    with pytest.raises(ValueError, match="no committed"):
        runs.read_run(spark, root, "a")
    first = runs.write_run(spark, root, {"a": spark.range(3), "b": spark.range(5).withColumn("x", F.lit(None).cast("string"))})
    assert runs.read_run(spark, root, "b", verify=True).count() == 5
    second = runs.write_run(spark, root, {"a": spark.range(7)}, run="again")
    assert second == "again" and runs.read_run(spark, root, "a").count() == 7
    assert runs.read_run(spark, root, "a", run=first, verify=True).count() == 3
    with pytest.raises(ValueError, match="no committed"):  # the newest run has no such table
        runs.read_run(spark, root, "b")
    with pytest.raises(ValueError, match="committed already"):
        runs.write_run(spark, root, {"a": spark.range(1)}, run="again")
    listed = {(r.number, r["name"], r["rows"]) for r in runs.manifests(spark, root).collect()}
    assert listed == {(0, "a", 3), (0, "b", 5), (1, "a", 7)}


def test_a_run_that_fails_between_two_tables_leaves_the_last_one(spark):
    root = _root()
    runs.write_run(spark, root, {"a": spark.range(3), "b": spark.range(3)}, run="good")
    broken = spark.range(4).withColumn("x", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        runs.write_run(spark, root, {"a": spark.range(9), "b": broken}, run="bad")
    assert runs.read_run(spark, root, "a").count() == 3
    runs.write_run(spark, root, {"a": spark.range(9), "b": spark.range(9)}, run="bad")  # the same run, tried again
    assert runs.read_run(spark, root, "a", verify=True).count() == 9


def test_a_manifest_that_was_not_finished_does_not_count(spark):
    root = _root()
    runs.write_run(spark, root, {"a": spark.range(3)}, run="one")
    runs.write_run(spark, root, {"a": spark.range(4)}, run="two")
    os.remove(f"{root}/manifests/two/_SUCCESS")
    assert runs.read_run(spark, root, "a").count() == 3


def test_changed_files_are_noticed(spark):
    root = _root()
    run = runs.write_run(spark, root, {"a": spark.range(3)})
    path = runs.manifests(spark, root).first()["path"]
    spark.range(1, 4).write.mode("overwrite").parquet(f"{root}/{path}")
    with pytest.raises(ValueError, match="manifest"):
        runs.read_run(spark, root, "a", run=run, verify=True)


def test_runners_write_all_their_tables(spark):
    from tests.conftest import SF001
    from shopseg.operators.clean import basket_transactions
    from shopseg.plans.levels import production_levels
    from shopseg.plans.segmentation import hybrid_segments
    from shopseg.sources.transactions import transactions_from_tables
    raw, root = transactions_from_tables(spark, SF001), _root()
    h = hybrid_segments(raw, leaves=40)
    tables = runs.hybrid_tables(h)
    runs.write_run(spark, root + "/segments", tables)
    final = runs.read_run(spark, root + "/segments", "final_assignments", verify=True)
    assert final.count() == 150 and len(tables) == 12
    assert {r["pass"]: r.certain for r in runs.read_run(spark, root + "/segments", "silhouettes").collect()} == {
        "detect": h.detect_certain, "core": h.core_certain}
    mined = production_levels(basket_transactions(raw), final)  # the rules read what the segments committed
    runs.write_run(spark, root + "/rules", runs.rules_tables(mined))
    summary = {r.level: r.n_rules for r in runs.read_run(spark, root + "/rules", "run_summary").collect()}
    rules = {r.level: r["count"] for r in runs.read_run(spark, root + "/rules", "rules").groupBy("level").count().collect()}
    assert {k: n for k, n in summary.items() if n} == rules and len(summary) > 2


HEADER = ",".join(f.name for f in RAW_SCHEMA.fields)
GOOD = b"1000001,P1,F,0-17,10,A,2,0,3,8370"


def _csv(*lines: bytes) -> str:
    path = tempfile.mkdtemp(prefix="shopseg-csv-") + "/tx.csv"
    with open(path, "wb") as f:
        f.write(b"\n".join([HEADER.encode(), *lines]) + b"\n")
    return path


def test_bad_lines_are_kept_apart(spark):
    short, long, bytes_ = b"1000002,P2,F", GOOD + b",one,more", b"1000003,P\xff\xfe,F,0-17,10,A,2,0,3,1"
    odd = b"1000004,,M,NA,x,B,4+,1,abc,"  # whole, with values of wrong types
    path = _csv(GOOD, short, long, bytes_, odd, b'1000005,"P,5",F,26-35,1,C,1,0,5,12.5')
    tx, rejected = read_transactions_rescued(spark, path)
    rows = {r.User_ID: r for r in tx.collect()}
    assert rows.keys() == {1000001, 1000004, 1000005} and rows[1000005].Product_ID == "P,5"
    assert (rows[1000004].Product_ID, rows[1000004].Age, rows[1000004].Occupation, rows[1000004].Purchase) == (None, None, None, None)
    got = sorted((r.reason, r.line) for r in rejected.collect())
    assert [r for r, _ in got] == ["bytes", "fields", "fields"]
    assert {line for _, line in got[1:]} == {short.decode(), long.decode()} and got[0][1].startswith("1000003,P�")
    assert rejected.count() == 3 and tx.schema == read_transactions(spark, _csv(GOOD)).schema


def test_clean_files_reject_nothing_and_columns_are_pruned(spark):
    path = _csv(GOOD, GOOD)
    tx, rejected = read_transactions_rescued(spark, path, ["User_ID", "Purchase"])
    assert tx.columns == ["User_ID", "Purchase"] and [tuple(r) for r in tx.collect()] == [(1000001, 8370.0)] * 2
    assert rejected.collect() == []
