import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shopseg.llm import components, simhash
from .helpers import ODD, SCHEMA, corpus, table


def plain_fingerprint(text, shingle=4):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hs = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(pairs, distance):
    """Brute force: class id (smallest doc_id) per row of (doc_id, fp)."""
    fps = sorted({f for _, f in pairs})
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    a = np.array(fps, np.uint64)
    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= distance):
            x, y = find(f), find(fps[i + 1 + j])
            parent[max(x, y)] = min(x, y)
    least = {}
    for d, f in pairs:
        least.setdefault(find(f), []).append(d)
    return [min((x for x in least[find(f)] if x is not None), default=None) for _, f in pairs]


@pytest.mark.parametrize("text", [*ODD, "one two three", "A b C d E", "w " * 3000])
def test_fingerprint(text, monkeypatch):
    want = plain_fingerprint(text)
    assert simhash.fingerprint(text, 4) == want
    monkeypatch.setattr(simhash, "SPAN", 50)
    assert simhash.fingerprint(text, 4) == want


def test_corpus_against_brute_force(spark):
    docs = corpus(spark)
    rows = docs.collect()
    fps = [(r.doc_id, plain_fingerprint(r.text)) for r in rows]
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {d: (f, c) for (d, f), c in zip(fps, classes(fps, 4))}


def test_odd_rows(spark):
    docs = table(spark, [*ODD, *ODD])
    fps = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert got == {d: c for (d, _), c in zip(fps, classes(fps, 4))}
    rows = [(None, "a b c d e"), (None, "other words here now"), (7, "a b c d e"), (7, "a b c d e"), (3, None)]
    got = simhash.near_duplicates(spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted([(None, 7), (7, 7), (7, 7), (None, None), (3, 3)], key=str)
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("distance, refine", [(4, 256), (4, 3), (3, 3), (2, 3)])
def test_dense_groups_lose_no_link(spark, monkeypatch, distance, refine):
    """Crowded balls, chains, and strangers that share segments: classes equal brute force."""
    monkeypatch.setattr(simhash, "REFINE", refine)
    rng = random.Random(5)
    fps = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(120):
            f = centre
            for b in rng.sample(range(64), rng.randint(0, 7)):
                f ^= 1 << b
            fps.add(f)
        f = centre ^ rng.getrandbits(40)
        for _ in range(15):
            fps.add(f)
            for b in rng.sample(range(64), distance):
                f ^= 1 << b
    high = rng.getrandbits(22) << 42
    fps |= {high | rng.getrandbits(42) for _ in range(80)}
    pairs = list(enumerate(sorted(fps)))
    rng.shuffle(pairs)
    df = spark.createDataFrame([(i, f - 2**64 if f >> 63 else f) for i, f in pairs], "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash._with_classes(df, distance).collect()}
    assert got == {i: c for (i, _), c in zip(pairs, classes(pairs, distance))}


def test_components_of_a_chain(spark):
    edges = spark.range(0, 60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    edges = edges.unionByName(spark.createDataFrame([(100, 101), (101, 100), (102, 102)], "a long, b long"))
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
