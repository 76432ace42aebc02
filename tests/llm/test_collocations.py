import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopseg.llm import catalog, collocations, doublearray, words
from .helpers import ODD, SCHEMA, corpus, table

CLASH = {"w": "x", "f": 1, "n": 2, "h": 3, "word": "y", "gram": 4, "score": 5, "numbers": "z"}


def lowered(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def plain(rows, least, longest=4, share=80, top=2000):
    """Brute force over (text, lang) rows: (lang, rank, phrase, a, l, r, n, score)."""
    counts, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lowered(text)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i:i + k]] = max(longer[p[i:i + k]], a)
        for p, a in candidates.items():
            if 100 * longer[p] >= share * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def check(docs, least, **more):
    got = sorted(map(tuple, collocations.collocations(docs, least=least, **more).collect()))
    want = plain([(r.text, r.lang) for r in docs.select("text", "lang").collect()], least, **more)
    assert got == want
    return got


def made(seed, n=200):
    """Texts of few words, so that phrases of all lengths are frequent; commas and odd spaces between them."""
    rng = random.Random(seed)
    names = ["Ab", "cd", "é", "É", "日本", "x1", "y", "the", "of", "o'f", "-"]
    return [" ".join(rng.choices(names, weights=range(len(names), 0, -1), k=rng.randint(0, 60))).replace("y the", rng.choice(["y, the", "y\tthe", "y\nthe"]))
            for _ in range(n)]


def test_made_texts(spark):
    got = check(table(spark, made(1) + ODD, **CLASH).withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.lit("xx"))), 5)
    assert {len(r[2].split(" ")) for r in got} == {2, 3, 4} and {r[0] for r in got} == {"xx", "und"}


def test_corpus(spark):
    assert check(corpus(spark), 10)


def test_many_tries_and_rounds_give_the_same(spark, monkeypatch):
    docs = table(spark, made(2)).withColumn("lang", F.when(F.col("doc_id") % 2 > 0, F.lit("xx")))
    want = check(docs, 4)
    for name, value in (("SHARD", 60), ("ROUND", 130), ("BLOCK", 500), ("HELD", 1500)):
        monkeypatch.setattr(collocations, name, value)
    assert sorted(map(tuple, collocations.collocations(docs, least=4).collect())) == want


def test_many_partitions_sum_side_by_side(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SUMMING", 2)  # of 4 partitions
    check(table(spark, made(6, 80), lang="xx"), 4)


def test_full_bitmaps_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "LEAST_BITS", 1 << 12)
    monkeypatch.setattr(collocations, "MOST_BITS", 1 << 12)
    check(table(spark, made(3), lang="xx"), 4)


def test_a_shared_word_hash_is_found_and_mended(spark, monkeypatch):
    docs = table(spark, made(4, 60), lang="xx")
    want = sorted(map(tuple, collocations.collocations(docs, least=4).collect()))
    blocks, seeds = collocations._blocks, []

    def clashing(docs, seed):
        seeds.append(seed)
        out = blocks(docs, seed)
        return out.withColumn("hashes", F.transform("hashes", lambda h: F.lit(7).cast("long"))) if seed == 0 else out

    monkeypatch.setattr(collocations, "_blocks", clashing)
    assert sorted(map(tuple, collocations.collocations(docs, least=4).collect())) == want and seeds == [0, 1]


def test_ties_top_and_repeats(spark):
    text = "a b. c d. e f. a b c d. g h"
    docs = table(spark, [text] * 6, lang="xx")
    got = check(docs, 3, top=2)
    assert [r[1] for r in got] == [1, 2]
    check(docs.unionByName(docs), 3)


def test_long_text(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 2_000)
    check(table(spark, [" ".join(made(5, 120)), "ab cd " * 4_000, None, ""], lang="xx"), 4)


def test_empty(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert collocations.collocations(table(spark, [None, "", "one. two"])).collect() == []
    with pytest.raises(ValueError):
        collocations.frequent_phrases(table(spark, ["a"]), least=0)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = corpus(spark, "sf0.01")
    got = sorted(map(tuple, catalog.op11_collocations(spark, sf).collect()))
    assert got == plain([(r.text, r.lang) for r in docs.select("text", "lang").collect()], 30) and got


@pytest.mark.parametrize("n,v,k", [(1, 1, 1), (300, 30, 3), (4000, 70_000, 2), (3000, 500, 4)])
def test_double_array(n, v, k):
    rng = np.random.default_rng(n)
    phrases = np.unique(np.minimum((rng.pareto(0.8, (n, k)) * 3).astype(np.int64) + 1, v), axis=0)
    trie = doublearray.build(phrases)
    numbers = np.minimum((rng.pareto(0.8, 20_000) * 3).astype(np.int64), v + 3)
    places, found = doublearray.walk(trie, numbers, np.arange(len(numbers) - k + 1))
    known = {tuple(p): i + 1 for i, p in enumerate(phrases.tolist())}
    want = {i: known[t] for i in range(len(numbers) - k + 1) if (t := tuple(numbers[i:i + k].tolist())) in known}
    assert dict(zip(places.tolist(), found.tolist())) == want


def test_cut():
    c = words.Cut("É A,b  a\tx.".encode(), words.byte_kinds(b" \t", b",."))
    assert [w.decode() for w in c.words.to_pylist()] == ["É", "a", "b", "x"]
    assert c.with_ends().tolist() == [1, 2, 0, 3, 2, 4] and c.counts().tolist() == [1, 2, 1, 1]
    assert words.Cut(b"", words.byte_kinds(b" ", b".")).with_ends().tolist() == []
