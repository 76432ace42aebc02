"""Language identification by nearest centroid.

A text's letters (white space and all else as one space) give character trigrams, hashed to ``DIMS`` counts; the vector
is ``ln(1 + tf) * idf``, normalised. Document frequencies come from all learning documents. Spherical k-means on a
bounded sample finds several centroids per language; a text gets the language of the centroid with the
highest cosine. It is rejected if its distance to that centroid is far beyond those of the learning texts (all of them) with about
as many different trigrams: its cosine is under ``SLACK`` times their ``LOW`` quantile, ``SHORT_SLACK`` times for texts of a class below
``LONG``, which lie further off.

Null text, and text without a letter, is ``und`` with score 0 and rejected. Learning rows without text or ``lang`` are
ignored. Without any learning row everything is ``und``. Rows that repeat a ``doc_id`` are judged one by one. An
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from shopseg.llm import shared
from shopseg.llm.arrays import chunks, letters

DIMS = 8_192
#: Bound of the clustering sample (expected number of documents, shared by the languages) and centroids per language.
SAMPLE_DOCS, CENTROIDS, ROUNDS = 1_600, 4, 12
#: Share of a low quantile of comparable learning texts' cosines under which a text is rejected; their classes by size.
SLACK, SHORT_SLACK, LOW, SIZES = 0.5, 0.15, 0.02, 14
#: Class from which a text counts as long (63 different trigrams), and the bins in which cosines are counted.
LONG, BINS = 6, 2_000
UNKNOWN = "und"

_A, _B, _C = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))


def trigram_counts(texts):
    """``(positions, counts)`` per group of texts: a row of ``DIMS`` trigram counts for each position."""
    held = None  # of a long text so far
    for rows, points, owner, last in chunks(texts):
        text = letters()[points]
        points = np.where(text, points, np.uint32(32))
        keep = text | np.append(True, text[:-1])  # one space where there were several
        p, o = points[keep], owner[keep]
        x = np.concatenate([p[-1:] * 0 + np.uint32(32), p])  # a word's first trigram starts with a space
        h = (x[:-2] * _A) ^ (x[1:-1] * _B) ^ (x[2:] * _C)
        h = ((h ^ (h >> np.uint32(15))) * _A) >> np.uint32(19)
        middle = x[1:-1] != 32  # trigrams around a letter; none reaches into another text
        at = o[:-1][middle] * DIMS + h[middle]
        for a in range(0, len(rows), 128):
            n = min(128, len(rows) - a)
            mine = at[(at >= a * DIMS) & (at < (a + n) * DIMS)] if len(rows) > 128 else at
            counts = np.bincount(mine - a * DIMS, minlength=n * DIMS).reshape(n, DIMS).astype(np.float32)
            if not last or held is not None:
                held = counts if held is None else held + counts
                if last:
                    yield rows, held
                    held = None
            else:
                yield rows[a:a + n], counts


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts with a letter, and in how many each trigram occurs, over all of ``docs`` (text)."""
    def partial(batches):
        n, df = 0, np.zeros(DIMS, np.int64)
        for b in batches:
            for _, counts in trigram_counts(b["text"].to_pylist()):
                df += (counts > 0).sum(0)
                n += int((counts.sum(1) > 0).sum())
        yield pa.RecordBatch.from_pydict({"gram": pa.array([-1, *range(DIMS)], pa.int32()), "n": pa.array([n, *df.tolist()], pa.int64())})

    out = np.zeros(DIMS + 1, np.int64)
    for r in docs.select("text").mapInArrow(partial, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        out[r.gram + 1] = r.n
    return int(out[0]), out[1:]


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """At most ``k`` unit centroids of unit rows; seeds are the mean, then the row worst served so far."""
    unit = lambda v: v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-12)
    c = unit(x.mean(0, keepdims=True))
    while len(c) < min(k, len(x)):
        c = np.vstack([c, x[np.argmin((x @ c.T).max(1))]])
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        c = unit(np.vstack([x[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))]))
    return c


def _size(counts: np.ndarray) -> np.ndarray:
    """Class of a text by its number of different trigrams, on a logarithmic scale."""
    return np.minimum(np.log2(1 + (counts > 0).sum(1)).astype(int), SIZES - 1)


def _cosines(docs: DataFrame, centroids: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """How many texts of ``docs`` (text) are in each size class and bin of the cosine to the nearest centroid."""
    def partial(batches):
        out = np.zeros(SIZES * (BINS + 1), np.int64)
        for b in batches:
            for _, counts in trigram_counts(b["text"].to_pylist()):
                some = counts[counts.sum(1) > 0]
                top = (vectors(some, idf) @ centroids.T).max(1, initial=0)
                out += np.bincount(_size(some) * (BINS + 1) + np.minimum(top * BINS, BINS).astype(int), minlength=len(out))
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(out[at])], ["at", "n"])

    out = np.zeros(SIZES * (BINS + 1), np.int64)
    for r in docs.select("text").mapInArrow(partial, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r.n
    return out.reshape(SIZES, BINS + 1)


def train(docs: DataFrame):
    """The model of learning rows ``docs`` (doc_id, text, lang): ``(languages, centroid language, centroids, idf, floors)``."""
    docs = docs.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    n, df = document_frequencies(docs)
    idf = (np.log((1 + n) / (1 + df)) + 0.05).astype(np.float32)
    sizes = {r.lang: r.n for r in docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n or not sizes:
        return [], np.zeros(0, int), np.zeros((0, DIMS), np.float32), idf, np.zeros(SIZES)
    share = SAMPLE_DOCS / len(sizes)
    spark = docs.sparkSession
    bounds = spark.createDataFrame([(k, int(min(1.0, share / c) * (1 << 20)) + 1) for k, c in sizes.items()], "lang string, below int")
    sample = docs.join(F.broadcast(bounds), "lang").where(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1 << 20)) < F.col("below"))

    def counted(batches):
        for b in batches:
            langs = b["lang"].to_pylist()
            for rows, counts in trigram_counts(b["text"].to_pylist()):
                yield pa.RecordBatch.from_pydict({"lang": pa.array([langs[r] for r in rows], pa.string()),
                                                  "counts": pa.array([c.tobytes() for c in np.minimum(counts, 65535).astype("<u2")], pa.binary())})

    got = sample.select("lang", "text").mapInArrow(counted, "lang string, counts binary").toArrow()
    counts = np.frombuffer(b"".join(x.as_buffer() for x in got["counts"]), "<u2").reshape(-1, DIMS)
    lang = np.array(got["lang"].to_pylist())
    names, owner, centroids = sorted(sizes), [], []
    for i, name in enumerate(names):
        x = vectors(counts[(lang == name) & (counts.sum(1) > 0)].astype(np.float32), idf)
        if len(x):
            c = spherical_kmeans(x, CENTROIDS)
            centroids.append(c)
            owner += [i] * len(c)
    if not owner:
        return [], np.zeros(0, int), np.zeros((0, DIMS), np.float32), idf, np.zeros(SIZES)
    centroids = np.vstack(centroids).astype(np.float32)
    near, floors = _cosines(docs, centroids, idf), np.zeros(SIZES)
    for k in range(SIZES):  # with the neighbouring classes; one without texts has the floor of the one before it
        below = np.cumsum(near[max(k - 1, 0):k + 2].sum(0))
        if below[-1]:
            floors[k] = (SLACK if k >= LONG else SHORT_SLACK) * np.searchsorted(below, max(LOW * below[-1], 1)) / BINS
        elif k:
            floors[k] = floors[k - 1]
    return names, np.array(owner), centroids, idf, floors


def _judged(batch, model):
    """Per row: language (or ``und``), cosine, whether it is rejected."""
    names, owner, centroids, idf, floors = model
    lang, score, rejected = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
    if len(owner):
        for rows, counts in trigram_counts(batch["text"].to_pylist()):
            some = counts.sum(1) > 0
            cos = vectors(counts[some], idf) @ centroids.T
            best = cos.argmax(1) if len(cos) else np.zeros(0, int)
            top = cos[np.arange(len(best)), best]
            score[rows[some]] = np.clip(top, 0, 1)
            rejected[rows[some]] = top < floors[_size(counts[some])]
            for r, c in zip(rows[some], owner[best]):
                lang[r] = names[c]
    return lang, score, rejected


#: Columns that ``identify`` adds.
ADDED = ("__lang_pred", "__score", "__rejected")


def identify(docs: DataFrame, model) -> DataFrame:
    """``docs`` plus ``ADDED``: nearest language (``und`` without letters; of equally near centroids the first counts),
    cosine, whether the text is rejected.

    Where ``docs`` has such columns itself, the new ones are called ``shared.spare(docs, *ADDED)``.
    """
    added = shared.spare(docs, *ADDED)

    def rows(batches):
        for b in batches:
            lang, score, rejected = _judged(b, model)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                [*b.schema.names, *added])

    kinds = (StringType(), DoubleType(), BooleanType())
    schema = StructType([*docs.schema.fields, *(StructField(c, k) for c, k in zip(added, kinds))])
    return docs.mapInArrow(rows, schema)
