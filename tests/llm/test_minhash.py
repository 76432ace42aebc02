import hashlib
import random
import re

import numpy as np
import pytest

from shopseg.llm import catalog, minhash
from .helpers import ODD, SCHEMA, corpus, table


def shingles(text, size=5):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    """(doc_id, n_chars, edited hash) by ascending doc_id, and each text, edited text and next text."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: r[0])
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        q = len(t) // 4
        out.append((i, t, t[:len(t) - q] + nxt[:q], nxt))
    return out


def check(spark, docs):
    got = {r.doc_id: r for r in minhash.compare_with_next(docs).collect()}
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert len(got) == len(want)
    errors = []
    for i, t, e, nxt in want:
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        sigs = minhash.signatures([t, e, nxt])
        assert bytes(r.fingerprint) == sigs[0].tobytes() and bytes(r.edited_fingerprint) == sigs[1].tobytes()
        assert r.near_edited == (sigs[0] == sigs[1]).mean() and r.near_next == (sigs[0] == sigs[2]).mean()
        errors += [r.near_edited - jaccard(t, e), r.near_next - jaccard(t, nxt)]
    assert max(map(abs, errors)) < 0.3 and np.sqrt(np.mean(np.square(errors))) < 0.07


def test_odd_and_corpus(spark):
    check(spark, table(spark, ODD))
    check(spark, corpus(spark))


def test_one_empty_repeated(spark):
    check(spark, table(spark, ["only one text here, and no next"]))
    assert minhash.compare_with_next(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (1, None), (1, None), (1, "x y")]
    assert len(minhash.compare_with_next(spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)).collect()) == 5


@pytest.mark.parametrize("span, block", [(1 << 18, 1 << 14), (40, 7), (1, 1)])
def test_signatures_do_not_depend_on_chunks(monkeypatch, span, block):
    texts = [t or "" for t in ODD] + ["some words " * 40, "w" * 300 + " tail of it all now"]
    want = minhash.signatures(texts)
    monkeypatch.setattr(minhash, "SPAN", span)
    monkeypatch.setattr(minhash, "BLOCK", block)
    assert (minhash.signatures(texts) == want).all()


def test_equal_shingle_sets_only():
    a, b = minhash.signatures(["one two three four five six", "ONE  two\nthree four five six"])
    assert (a == b).all()
    sig = minhash.signatures(["", "a", "b", "a b", "b a"])
    assert len({s.tobytes() for s in sig}) == 5


def classes(rows, threshold=0.8):
    ids = [i for i, _ in rows]
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            u = len(sets[i] | sets[j])
            if rows[i][1] == rows[j][1] or not u or len(sets[i] & sets[j]) >= threshold * u:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return {ids[i]: min(ids[j] for j in range(len(rows)) if find(j) == find(i)) for i in range(len(rows))}


def test_near_duplicates(spark):
    rng = random.Random(3)
    texts = [*ODD, None, "a b c", "a b c"]
    for _ in range(6):
        words = [str(rng.randrange(1000)) for _ in range(120)]
        for _ in range(12):
            texts.append(" ".join(words))
            words[rng.randrange(120)] = str(rng.randrange(1000))  # a chain: each close to the one before
    docs = table(spark, texts)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert got == classes([(i, t or "") for i, t in enumerate(texts)])
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query(spark):
    rows = catalog.op3_minhash(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in corpus(spark).collect()}
    assert len(rows) == len(texts) and all(re.fullmatch("[0-9a-f]{256}", r.fingerprint) for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
