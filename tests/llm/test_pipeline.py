"""Every stage against brute force on what the stage before it kept."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from shopseg.llm import language, shared, simhash
from .helpers import ODD, SCHEMA, corpus, table
from .test_decontaminate import brute as windows_hit
from .test_lines_shards import kept_lines
from .test_simhash import classes, plain_fingerprint
from .test_tokens import fills

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage returns."""
    docs, out = corpus(spark), {}
    for name, stage in P.STAGES:
        out[name] = docs = shared.written(stage(spark, docs, SF), name)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(spark, kept):
    want = corpus(spark).columns
    assert len(P.STAGES) == 5
    for name, _ in P.STAGES[:-1]:
        assert kept[name].columns == want


def test_language_keeps_clean_documents(spark, kept):
    before, after = rows(corpus(spark)), rows(kept["language_id"])
    assert all(after[i] == before[i] for i in after)
    assert set(before) - set(after) <= {i for i, r in before.items() if len(r.text or "") < 5}


def test_lines(kept):
    before, after = rows(kept["language_id"]), rows(kept["line_dedup"])
    want = {i: t for i, _, _, t in kept_lines([(i, r.text) for i, r in before.items()])}
    assert {i: r.text for i, r in after.items()} == want
    assert all(r.n_chars == len(r.text) and r.source == before[i].source for i, r in after.items())


def test_simhash(kept):
    before, after = rows(kept["line_dedup"]), rows(kept["simhash_dedup"])
    pairs = [(i, plain_fingerprint(r.text)) for i, r in before.items()]
    assert set(after) == set(classes(pairs, P.DISTANCE))
    assert all(after[i] == before[i] for i in after)


def test_decontamination(spark, kept):
    before, after = rows(kept["simhash_dedup"]), rows(kept["decontamination"])
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(after) == {d for d, _, hit, _ in windows_hit([(i, r.text) for i, r in before.items()], items) if not hit}


def test_packing(kept):
    docs, pieces = rows(kept["decontamination"]), kept["best_fit_packing"].collect()
    assert {r.doc_id for r in pieces} == set(docs)
    fills(pieces, P.CAPACITY)


def test_run(spark, kept):
    got = sorted(tuple(r)[:5] for r in P.run(spark, SF).collect())
    assert got == sorted(tuple(r)[:5] for r in kept["best_fit_packing"].collect())


def test_keep_one_of_odd_rows(spark):
    docs = table(spark, [*ODD, *ODD])
    want = set(classes([(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()], 4))
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == want
    data = [(None, "a b c d e"), (None, "a b c d e"), (7, "x y z w v"), (7, "x y z w v"), (3, None), (None, None)]
    got = simhash.keep_one(spark.createDataFrame([(*r, None, None, None) for r in data], SCHEMA)).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == [("3", None), ("7", "x y z w v"), ("None", "a b c d e")]


def test_stages_on_odd_and_empty_tables(spark):
    for docs in (table(spark, ODD), spark.createDataFrame([], SCHEMA), spark.createDataFrame([(None, None, None, None, None)] * 2, SCHEMA)):
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            assert out.count() <= docs.count()
        assert P.pack(spark, docs, SF).count() >= docs.count()


def test_language_model(spark):
    """Held-out accuracy, rejection, and the rules for texts without letters."""
    docs = corpus(spark, "sf0.01")
    half = F.col("doc_id") % 2 == 0
    model = language.train(docs.where(half))
    out = language.identify(docs.where(~half), model)
    right = out.where(F.length("text") > 50).agg(F.avg((F.col("lang") == F.col("__lang_pred")).cast("int"))).first()[0]
    assert right > 0.98
    odd = language.identify(table(spark, ["123 ...", None, "", "\U0001F600", "the of and", "字" * 100], lang_x="x"), model).collect()
    assert [r["__lang_pred"] for r in odd[:4]] == ["und"] * 4 and [r["__score"] for r in odd[:4]] == [0] * 4
    assert [r["__rejected"] for r in odd[:5]] == [True] * 4 + [False]
    nothing = language.train(table(spark, ["no language"]))
    assert [r["__lang_pred"] for r in language.identify(table(spark, ["text"]), nothing).collect()] == ["und"]


def test_trigrams_of_long_texts_add_up(monkeypatch):
    from shopseg.llm import arrays
    texts = ["short one", "word " * 60, "", "x" * 200, "Ende gut, alles gut. " * 20]
    want = np.zeros((len(texts), language.DIMS))
    for r, c in language.trigram_counts(texts):
        want[r] = c
    monkeypatch.setattr(arrays, "CHUNK", 64)
    got = np.zeros_like(want)
    for r, c in language.trigram_counts(texts):
        got[r] += c
    assert (got == want).all()


def test_language_rejects_junk_and_left_out_languages(spark):
    """Long texts: lettered junk and a language not learned are rejected, learned ones are not."""
    rng = np.random.default_rng(0)
    junk = [" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(n)) for n in (30, 100, 300)]
    docs = corpus(spark, "sf0.01")
    model = language.train(docs.where("lang <> 'de'"))
    assert all(r["__rejected"] for r in language.identify(table(spark, junk), model).collect())
    out = {r.german: r.share for r in language.identify(docs.where("length(text) > 400"), model).groupBy((F.col("lang") == "de").alias("german"))
           .agg(F.avg(F.col("__rejected").cast("int")).alias("share")).collect()}
    assert out[True] > 0.9 and out[False] < 0.02
