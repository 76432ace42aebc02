import numpy as np

from shopseg.llm import arrays, catalog, toxicity
from .helpers import ODD, SCHEMA, corpus, table


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int")


def test_held_out(spark):
    """Most held-out toxic documents are found, nearly no clean one is."""
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in catalog.op7_toxicity(spark, sf).collect()}
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(got[i].predicted, t) for i, t in marks.items() if got[i].held_out]
    assert len(got) == corpus(spark, "sf0.1").count()
    precision = np.mean([t for p, t in held if p])
    recall = np.mean([p for p, t in held if t])
    assert precision > 0.95 and recall > 0.8
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_odd_rows_and_no_positives(spark):
    docs = table(spark, ODD)
    none = toxicity.train(docs, labels(spark, [(0, 0), (1, None), (None, 1)]))
    assert {round(r.score, 9) for r in toxicity.score(docs, none).collect()} == {0}
    model = toxicity.train(docs, labels(spark, [(0, 0), (5, 1), (5, 0), (10, 1)]))
    out = toxicity.score(docs, model).collect()
    assert sorted(r.doc_id for r in out) == list(range(len(ODD))) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(spark.createDataFrame([], SCHEMA), model).collect() == []
    assert toxicity.train(spark.createDataFrame([], SCHEMA), labels(spark, []))[0].size == 0


def test_long_text_has_the_features_of_its_slices(monkeypatch):
    texts = ["bad words here " * 50 + "end", "fine words " * 60, "bad", "w" * 100, None]

    def sets():
        found = {}
        for own, points, owner, _ in arrays.chunks(texts):
            row, f = toxicity.features(points, owner)
            for r, x in zip(own[row], f):
                found.setdefault(int(r), set()).add(int(x))
        return found

    want = sets()
    monkeypatch.setattr(arrays, "CHUNK", 40)
    arrays._powers.cache_clear()
    assert sets() == want
    monkeypatch.undo()
    arrays._powers.cache_clear()


def test_non_negative_risk_prefers_the_planted_feature():
    rng = np.random.default_rng(0)
    pos = [np.unique(np.append(rng.integers(10, 500, 30), 1)).astype(np.uint32) for _ in range(60)]
    unl = [np.unique(np.append(rng.integers(10, 500, 30), [1] if i % 10 == 0 else [])).astype(np.uint32) for i in range(300)]
    chosen, weights, bias = toxicity.fit(pos, unl, 0.1)
    w = dict(zip(chosen.tolist(), weights))
    assert w[1] == max(w.values())

    def score(s):
        return toxicity._sigmoid(bias + sum(w.get(int(x), 0) for x in s))

    assert np.mean([score(s) > 0.5 for s in pos]) > 0.95
    assert np.mean([score(s) > 0.5 for i, s in enumerate(unl) if i % 10]) < 0.05


def test_rare_toxic_word_beyond_the_samples(spark, monkeypatch):
    """Features are counted over all learning rows: a word that hardly any sampled document holds is learned all the same."""
    monkeypatch.setattr(toxicity, "POSITIVES", 12)
    monkeypatch.setattr(toxicity, "UNLABELLED", 36)
    rare = lambda i: i % 200 == 0
    texts = [f"plain {'abcdefgh'[i % 8] * 3} words" + (" vrxq" if rare(i) else " zkwth" if i % 10 == 0 else "") for i in range(4000)]
    docs = table(spark, texts)
    marks = labels(spark, [(i, int(i % 10 == 0)) for i in range(4000)])
    rows = docs.select("doc_id", "text", (docs.doc_id % 10 == 0).alias("toxic"))
    counts = {r.feature: (r.p, r.u) for r in toxicity.feature_counts(rows).collect()}
    want = {}
    for t, i in zip(texts, range(4000)):
        for f in toxicity._feature_sets([t])[0].tolist():
            p, u = want.get(f, (0, 0))
            want[f] = (p + (i % 10 == 0), u + 1)
    assert counts == want
    model = toxicity.train(docs, marks)
    got = {r.doc_id: r.score for r in toxicity.score(table(spark, ["plain vrxq words", "plain zkwth words", "plain aaa words"]), model).collect()}
    assert got[0] >= 0.5 and got[1] >= 0.5 and got[2] < 0.5
