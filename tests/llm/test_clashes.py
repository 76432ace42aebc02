"""Extra columns named like the operators' own helper columns come back untouched."""

import corpus_pipeline as P
from pyspark.sql import functions as F

from shopseg.llm import language, linededup, pii, shared
from .helpers import corpus

NAMES = ["__id", "__h", "__hash", "__kept", "__kept_", "__rejected", "__score", "__lang_pred", "__dropped", "__spans", "__n_lines", "__n_dropped",
         "__ID_", "h", "spans", "fp", "class_fp"]


def clashing(spark):
    docs = corpus(spark).limit(60)
    return docs.select("*", *[F.concat(F.lit(f"{n}-"), F.col("doc_id")).alias(n) for n in NAMES]).cache()


def plain(docs, columns):
    return sorted(map(tuple, docs.select(*columns).collect()))


def test_spare_names(spark):
    docs = spark.createDataFrame([(1, 2)], "`__ID` int, `__id_` int")
    assert shared.spare(docs, "__id", "__id", "__h") == ["__id__", "__id___", "__h"]


def test_stages(spark):
    docs = clashing(spark)
    own = [c for c in docs.columns if c not in NAMES]
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns
        assert plain(out, own) == plain(stage(spark, docs.select(*own), "/root/testdata/sf0.001"), own), name
        assert all(r[n] == f"{n}-{r.doc_id}" for r in out.collect() for n in NAMES), name


def test_operators(spark):
    docs = clashing(spark)
    own = [c for c in docs.columns if c not in NAMES]
    out = pii.sanitise(docs)
    assert out.columns == docs.columns and plain(out, own) == plain(pii.sanitise(docs.select(*own)), own)
    assert all(r[n] == f"{n}-{r.doc_id}" for r in out.collect() for n in NAMES)
    out = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs))
    assert out.columns == [*docs.columns, *shared.spare(docs, *linededup.ADDED)]
    out = language.identify(docs, language.train(docs))
    assert out.columns == [*docs.columns, *shared.spare(docs, *language.ADDED)]
