import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from shopseg.llm import catalog, divergence
from .helpers import ODD, SCHEMA, corpus, table

CLASH = {"n": 1, "docs": "d", "term": "t", "total": 2, "id": 3, "block": 4, "v": 5, "a": "a", "b": "b", "item": "i", "value": 6, "rank": 7}


def plain(rows, least=3, top=200):
    """Brute force over (text, lang, source) rows."""
    rows = [tuple(x or "" for x in r) for r in rows]
    terms = [re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t)) for t, _, _ in rows]
    holders, total, own = {}, {}, {}
    for (_, lang, source), w in zip(rows, terms):
        holders.setdefault(lang, Counter()).update(set(w))
        total.setdefault(lang, Counter()).update(w)
        own.setdefault((lang, source), Counter()).update(w)
    out = []
    for lang in holders:
        kept = [t for t, n in holders[lang].items() if n >= least]
        v = len(kept)

        def p(counts, n):
            return {t: 1 + 1_000_000_000 * (counts[t] + 1) // (n + v) for t in kept}

        q = p(total[lang], sum(total[lang][t] for t in kept))
        groups = {s: p(c, sum(c[t] for t in kept)) for (x, s), c in own.items() if x == lang}
        for s, mine in groups.items():
            pairs = [(-sum((mine[t] - o[t]) ** 2 // o[t] for t in kept), i) for i, o in groups.items() if i != s]
            single = [(-((mine[t] - q[t]) ** 2 // q[t]), t) for t in kept if own[lang, s][t] and mine[t] > q[t]]
            for part, found in (("pair", pairs), ("term", single)):
                found.sort(key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, i, -value, rank) for rank, (value, i) in enumerate(found, 1) if part == "pair" or rank <= top]
    return sorted(out)


def check(docs, **more):
    got = sorted(map(tuple, divergence.audit(docs, **more).collect()))
    assert got == plain([(r.text, r.lang, r.source) for r in docs.select("text", "lang", "source").collect()],
                        more.get("least_docs", 3), more.get("top", 200))
    return got


def made(spark, many=240, **extra):
    rng = random.Random(many)
    names = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)] + ["É", "é", "日本", "O'Neil"]
    texts = [" ".join(rng.choices(names, weights=range(len(names), 0, -1), k=rng.randint(0, 30))) for _ in range(many)]
    docs = table(spark, texts, **extra)
    return docs.withColumns({"lang": F.when(F.col("doc_id") % 5 > 0, F.concat(F.lit("l"), F.col("doc_id") % 2)),
                             "source": F.when(F.col("doc_id") % 7 > 0, F.concat(F.lit("s"), F.pmod(F.hash("doc_id"), F.lit(6))))})


def test_made_texts(spark):
    got = check(made(spark, **CLASH))
    assert {r[2] for r in got} == {"pair", "term"} and "" in {r[0] for r in got} and "" in {r[1] for r in got}


def test_small_blocks_and_long_texts_give_the_same(spark, monkeypatch):
    docs = made(spark, 120)
    for name, value in (("SPAN", 16), ("BLOCK", 300), ("HELD", 900)):
        monkeypatch.setattr(divergence, name, value)
    check(docs.unionByName(table(spark, ["waa wab " * 500, "wac\n" * 400], lang="l1", source="s1").select(docs.columns)))


def test_corpus_and_top(spark):
    check(corpus(spark))
    check(corpus(spark), top=3, least_docs=2)


def test_groups_without_terms_and_odd_texts(spark):
    docs = table(spark, ODD, lang="xx").withColumn("source", F.concat(F.lit("s"), F.col("doc_id")))
    check(docs)
    got = check(table(spark, ["", None, "1 2 3"], lang="xx").withColumn("source", F.concat(F.lit("s"), F.col("doc_id"))))
    assert len(got) == 6 and {r[4] for r in got} == {0}


def test_repeats_one_group_and_empty(spark):
    check(table(spark, ["a b c"] * 4, lang="xx", source="only"))
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_shares_are_exact_for_large_counts():
    counts = np.array([0, 1, 7, 10**13, 9 * 10**14, 9_007_199_254_740_993 // 10], np.int64)
    for total in (10**15 + 7, 3 * 10**14 + 1, 12):
        want = [1 + 1_000_000_000 * (int(c) + 1) // total for c in counts if int(c) < total]
        assert divergence.shares(counts[counts < total], total).tolist() == want


def test_merge_against_dense_arrays():
    rng = np.random.default_rng(5)
    for v, na, nb in ((50, 10, 30), (50, 0, 5), (7, 7, 7), (1000, 3, 900), (5, 0, 0)):
        a, b = np.zeros(v, np.int64), np.zeros(v, np.int64)
        ids_a, ids_b = np.sort(rng.choice(v, na, replace=False)), np.sort(rng.choice(v, nb, replace=False))
        a[ids_a], b[ids_b] = rng.integers(1, 9, na), rng.integers(1, 9, nb)
        p, q = divergence.shares(a, int(a.sum()) + v), divergence.shares(b, int(b.sum()) + v)
        want = (int(divergence.price(p, q).sum()), int(divergence.price(q, p).sum()))
        assert divergence.merged(ids_a, a[ids_a], int(a.sum()) + v, ids_b, b[ids_b], int(b.sum()) + v, v) == want


def test_query(spark):
    got = sorted(map(tuple, catalog.op13_divergence(spark, "/root/testdata/sf0.001").collect()))
    assert got == plain([(r.text, r.lang, r.source) for r in corpus(spark).select("text", "lang", "source").collect()])
