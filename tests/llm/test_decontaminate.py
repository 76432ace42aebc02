import hashlib
import random
import re

from shopseg.llm import catalog, decontaminate
from .helpers import ODD, SCHEMA, corpus, table


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, width=10):
    """(doc_id, n_words, n_hit, items) per document, sorted."""
    lookup = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - width + 1) if w else 0):
            lookup.setdefault(tuple(w[s:s + width]), set()).add(i)
    lengths = {len(k) for k in lookup}
    out = []
    for d, t in docs:
        w, hit, own = words(t), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                if (k := tuple(w[s:s + n])) in lookup:
                    hit.update(range(s, s + n))
                    own |= lookup[k]
        out.append((d, len(w), len(hit), sorted(str(i) for i in own if i is not None)))
    return sorted(out, key=str)


def check(spark, docs, items):
    got = decontaminate.contamination(docs, items).select("doc_id", "n_words", "n_hit", "item_ids").collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert sorted((tuple(r) for r in got), key=str) == want
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(w[0]) for w in want if not w[2])


def bench(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_corpus(spark):
    check(spark, corpus(spark), spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))


def test_few_words_repeats_and_overlaps(spark):
    rng = random.Random(1)
    items = ["a b c a b c a b c a b c", "a", "b b", "Zebra, É!", "", None, "a a a a a a a a a a a", "x " * 30, "c a b c a b c a b c a"]
    docs = [" ".join(rng.choice("abcx") for _ in range(rng.randrange(60))) for _ in range(40)] + ["x " * 200, "zebra É", "zebra é", "A a"]
    check(spark, table(spark, [*docs, *ODD]), bench(spark, items))


def test_null_repeated_and_empty(spark):
    text = "one two three four five six seven eight nine ten eleven"
    rows = [(None, text), (None, "other"), (1, text), (1, text), (1, "short"), (2, None)]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)
    items = spark.createDataFrame([(None, text), (7, text), (7, text)], "item_id long, text string")
    got = decontaminate.contamination(docs, items).collect()
    assert sorted(((r.doc_id, r.n_hit, tuple(r.item_ids)) for r in got), key=str) == sorted(
        [(None, 11, ("7",)), (None, 0, ()), (1, 11, ("7",)), (1, 11, ("7",)), (1, 0, ()), (2, 0, ())], key=str)
    assert len(got) == len(rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert decontaminate.contamination(empty, items).collect() == []
    assert {r.n_hit for r in decontaminate.contamination(docs, bench(spark, [])).collect()} == {0}
    assert decontaminate.clean(docs, bench(spark, [])).count() == len(rows)


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = table(spark, [f"start {item} end", "alpha beta gamma delta extra epsilon zeta eta theta iota kappa", "alpha kappa only", "none at all"])
    got = {r.doc_id: (r.n_hit, r.n_near) for r in decontaminate.contamination(docs, bench(spark, [item])).collect()}
    assert got == {0: (10, 0), 1: (0, 1), 2: (0, 0), 3: (0, 0)}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = {d: (n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0)
            for d, n, h, i in brute([(r.doc_id, r.text) for r in corpus(spark).collect()], items)}
    assert {r.doc_id: tuple(r)[1:] for r in catalog.op8_decontamination(spark, sf).collect()} == want
