import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shopseg.llm import catalog, curriculum
from .helpers import ODD, SCHEMA, corpus, table

CLASH = {"at": 1, "time": "t", "draw": "d", "row": 5, "copies": "c", "target": 2.0, "weight": 1, "cap": 7, "place": "p"}
RAMPS = [(7.5, -5.0), (2.0, 0.0), (0.5, 1.0)]


def targets(sizes, share=1.5, most=2):
    """Targets by resharing the excess until none is above. ``sizes``: source -> words."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level > most * sizes[s]}
        if not above:
            return out | {s: weight[s] * level for s in free}
        for s in above:
            out[s] = most * sizes[s]
            left -= out[s]
        free -= above
    return out


def check(docs):
    rows = docs.select("doc_id", "text", "source").collect()
    size = [len(re.findall(r"[^ \t-\r]+", r.text or "")) for r in rows]
    source_size = Counter()
    for r, s in zip(rows, size):
        source_size[r.source] += s
    want = targets(source_size)
    got = curriculum.mixed(docs).collect()
    assert sorted((str(r.doc_id), r["size"]) for r in got) == sorted((str(r.doc_id), s) for r, s in zip(rows, size))
    assert all(r.taken <= 2 * r["size"] and math.isclose(r.target, want_, rel_tol=1e-9, abs_tol=1e-9)
               for r in got for want_ in [min(want.values(), key=lambda x: abs(x - r.target))])
    assert sum(r.taken for r in got) == sum(int(t + 1e-6) for s, t in want.items())
    return got, want, source_size


def test_corpus_matches_the_sources_targets(spark):
    docs = corpus(spark).cache()
    got, want, sizes = check(docs)
    source = {r.doc_id: r.source for r in docs.collect()}
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]] and math.isclose(r.target, want[source[r.doc_id]], rel_tol=1e-9)
        taken[source[r.doc_id]] += r.taken
    assert all(taken[s] == int(want[s] + 1e-6) for s in want)
    assert sorted(map(str, curriculum.mixed(docs).collect())) == sorted(map(str, got))
    assert sorted(map(str, curriculum.mixed(docs.repartition(7)).collect())) == sorted(map(str, got))


def test_times_invert_the_schedules(spark):
    docs = corpus(spark).cache()
    planned = curriculum.plan(docs).collect()
    order = sorted({r.source for r in planned}, key=lambda s: (s is None, s or ""))
    for i, s in enumerate(order):
        w0, slope = RAMPS[i % 3]
        total = w0 + slope / 2
        stream = sorted((r for r in planned if r.source == s), key=lambda r: hashlib.md5(str(r.doc_id).encode()).hexdigest())
        at, seen = 0, []
        for copy in (0, 1):
            for r in stream:
                mine = [c for c in r.copies if c.copy == copy]
                if mine:
                    demand = (at + mine[0].taken / 2) / r.target
                    t = mine[0].time
                    assert math.isclose((w0 * t + slope * t * t / 2) / total, demand, rel_tol=1e-9, abs_tol=1e-9)
                    seen.append(t)
                    at += mine[0].taken
        assert seen == sorted(seen) and all(0 <= t <= 1 for t in seen)


def test_heavy_sources_come_early(spark):
    order = curriculum.training_order(curriculum.plan(corpus(spark))).collect()
    assert sorted(r["at"] for r in order) == list(range(len(order)))
    rows = sorted(order, key=lambda r: r["at"])
    assert [r.time for r in rows] == sorted(r.time for r in rows)
    names = sorted({r.source for r in rows}, key=lambda s: (s is None, s or ""))
    share = [sum(r.taken for r in rows if r.source in names[0::3] and a <= r.time < b) for a, b in ((0, 0.5), (0.5, 1.1))]
    assert share[0] > 1.2 * share[1]


def test_own_schedules(spark):
    docs = table(spark, ["a b c d"] * 40).withColumn("source", F.when(F.col("doc_id") % 2 > 0, F.lit("odd")).otherwise(F.lit("even")))
    late = [[(0.0, 1.0), (1.0, 1.0)], [(0.0, 0.0), (0.5, 0.0), (0.75, 1.0), (1.0, 1.0)]]
    rows = curriculum.training_order(curriculum.plan(docs, late, share=0.5, most=1)).collect()
    assert min(r.time for r in rows if r.source == "odd") >= 0.5
    assert 78 <= sum(r.taken for r in rows) <= 80 and {r.copy for r in rows} == {0}
    for bad in ([(0.0, 1.0)], [(0.0, 1.0), (0.9, 1.0)], [(0.0, -1.0), (1.0, 1.0)], [(0.0, 0.0), (1.0, 0.0)]):
        with pytest.raises(ValueError):
            curriculum.plan(docs, [bad])


def test_odd_repeated_and_null(spark):
    odd = table(spark, ODD + ["w " * 100_000], **CLASH).withColumn("source", F.when(F.col("doc_id") % 4 > 0, F.concat(F.lit("s"), F.col("doc_id") % 3)))
    got, _, _ = check(odd)
    assert all(r.time is None and r.taken == 0 for r in got if r["size"] == 0)
    rows = [(None, "a b c", None, None, None)] * 5 + [(1, "x y", None, "s", None)] * 4 + [(1, None, None, "s", None), (2, "", None, "t", None)]
    check(spark.createDataFrame(rows, SCHEMA))


def test_a_hot_source(spark):
    docs = table(spark, [f"w{i} " * (i % 7 + 1) for i in range(600)]).withColumn(
        "source", F.when(F.col("doc_id") % 3 > 0, F.lit("big")).otherwise(F.concat(F.lit("s"), F.col("doc_id") % 40)))
    check(docs)


def test_empty(spark):
    assert curriculum.mixed(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r.taken for r in curriculum.mixed(table(spark, [None, ""])).collect()] == [0, 0]


def test_query(spark):
    got = catalog.op12_curriculum(spark, "/root/testdata/sf0.001").collect()
    assert [r.time for r in got] == sorted(r.time for r in got)
    assert {r.doc_id for r in got} == {r.doc_id for r in corpus(spark).collect()}
