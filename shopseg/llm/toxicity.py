"""Toxicity by non-negative positive-unlabelled learning.

Positives are the confirmed toxic documents, the unlabelled set a sample of all learning documents (whatever
their label). Features: which words, and which beginnings of words, a text holds. The features that tell
the two sets apart best get a linear model, fitted in numpy to the non-negative risk estimator
``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))`` with sigmoid loss; where the second term is negative the step
goes the other way, so that the model cannot overfit the positives. The class prior is the toxic share
of all labelled learning rows. Scoring streams whole texts.

How many documents of either set hold a feature is counted over all learning rows. The fit alone uses bounded samples
(``POSITIVES``, ``UNLABELLED`` documents and about ``HOLDERS`` that hold each chosen feature, weighted by the inverse of their
chance); the model's size is ``FEATURES``. Null or empty text has no features and gets the model's base score. Null labels are ignored;
a document with several labels is toxic if one says so. Rows that repeat a ``doc_id`` are scored one by
one. Without any confirmed toxic document every score is 0. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopseg.llm import shared
from shopseg.llm.arrays import chunks, letters, span_hashes

#: Expected number of documents at most in either training sample.
POSITIVES, UNLABELLED = 1_500, 4_500
FEATURES = 1_024
#: Expected number of documents of either sample, at least, that hold a chosen feature (all of them if there are fewer).
HOLDERS = 4
#: Toxic ids are broadcast up to so many; beyond, the join shuffles. Features a task counts before it hands them on.
BROADCAST_ROWS, HELD = 200_000, 1 << 20
#: G statistic (one degree of freedom) from which a feature is taken to tell the sets apart.
TELLING = 7.0
#: Lengths, in code points, of the beginnings of words that are features.
BEGINNINGS = (3, 4, 5, 6, 7)
STEPS, RATE, DECAY = 400, 0.1, 1e-3

_MIX = np.uint64(0x9E3779B97F4A7C15)


def features(points: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, feature)`` of each word and beginning in a chunk: 32-bit hashes, repeats included."""
    word = letters()[points]
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lengths = ends - starts
    rows, found = [owner[starts]], [span_hashes(points, starts, ends) >> np.uint64(32)]
    h = np.zeros(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(1, max(BEGINNINGS) + 1):  # one letter more of every word that has one left
            long = lengths >= k
            starts, lengths, h = starts[long], lengths[long], h[long]
            h = (h ^ points[starts + k - 1]) * _MIX
            h ^= h >> np.uint64(29)
            if k in BEGINNINGS:
                rows.append(owner[starts])
                found.append((h + np.uint64(k)) * _MIX >> np.uint64(32))
    return np.concatenate(rows), np.concatenate(found).astype(np.uint32)


def _feature_sets(texts) -> list[np.ndarray]:
    """Each text's set of features, sorted."""
    sets: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
    for rows, points, owner, _ in chunks(texts):
        row, found = features(points, owner)
        both = np.unique(row.astype(np.uint64) << np.uint64(32) | found)
        cuts = np.searchsorted(both, np.arange(1, len(rows), dtype=np.uint64) << np.uint64(32))
        for r, own in zip(rows, np.split(both.astype(np.uint32), cuts)):
            sets[r] = np.union1d(sets[r], own) if len(sets[r]) else own
    return sets


def feature_counts(marked: DataFrame) -> DataFrame:
    """``feature, p, u``: in how many texts of ``marked`` (text, toxic) each feature is, of the toxic ones and of all."""
    def partial(batches):
        found, p, u = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(p), pa.array(u)], ["feature", "p", "u"])

        for b in batches:
            sets = _feature_sets(b["text"].to_pylist())
            toxic = np.repeat(b["toxic"].to_numpy(zero_copy_only=False).astype(np.int64), [len(x) for x in sets])
            own, at = np.unique(np.concatenate([found, *sets]), return_inverse=True)
            old, new = at[:len(found)], at[len(found):]
            p, p0, u, u0 = np.bincount(new, toxic, len(own)).astype(np.int64), p, np.bincount(new, minlength=len(own)), u
            p[old] += p0
            u[old] += u0
            found = own
            if len(found) > HELD:
                yield out()
                found, p, u = found[:0], p[:0], u[:0]
        yield out()

    return marked.select("text", "toxic").mapInArrow(partial, "feature long, p long, u long") \
        .groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def telling(p: np.ndarray, u: np.ndarray, n_p: int, n_u: int) -> np.ndarray:
    """G statistic of features that ``p`` of ``n_p`` texts of one set and ``u`` of ``n_u`` of the other hold."""
    m = (p + u) / (n_p + n_u)

    def told(count, size):  # what the counts of one set add to the G statistic
        x, y = count / size, 1 - count / size
        return 2 * size * (np.where(x > 0, x * np.log(np.maximum(x, 1e-12) / m), 0)
                           + np.where(y > 0, y * np.log(np.maximum(y, 1e-12) / np.maximum(1 - m, 1e-12)), 0))

    return told(p, n_p) + told(u, n_u)


def choose_counted(counts: DataFrame, n_p: int, n_u: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``n`` features (sorted) that say most about which of the two sets a text is of, and how many of each hold them."""
    def judged(batches):
        for b in batches:
            p, u = b["p"].to_numpy(), b["u"].to_numpy()
            g = telling(p.astype(float), u.astype(float), n_p, n_u)
            keep = pa.array(g > TELLING)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(g)], ["feature", "p", "u", "g"]).filter(keep)

    best = counts.mapInArrow(judged, "feature long, p long, u long, g double").orderBy(F.desc("g"), "feature").limit(n).toArrow()
    feature = best["feature"].to_numpy().astype(np.uint32)
    order = np.argsort(feature)
    return feature[order], best["p"].to_numpy()[order], best["u"].to_numpy()[order]


def sampled(marked: DataFrame, chosen: np.ndarray, p: np.ndarray, u: np.ndarray, n_p: int, n_u: int):
    """``(sets, weights)`` of either sample: the chosen features of its texts and the inverse of each one's chance."""
    def rows(batches):
        base = {True: min(1.0, POSITIVES / n_p), False: min(1.0, UNLABELLED / n_u)}
        chance = {True: np.minimum(1, HOLDERS / np.maximum(p, 1)), False: np.minimum(1, HOLDERS / np.maximum(u, 1))}
        for b in batches:
            sets, weights, positive = [], [], []
            drawn = b["drawn"].to_numpy()
            for own, toxic, x in zip(_feature_sets(b["text"].to_pylist()), b["toxic"].to_pylist(), drawn):
                at = np.searchsorted(chosen, own[np.isin(own, chosen)])
                for side in ((True, False) if toxic else (False,)):
                    share = max(base[side], chance[side][at].max(initial=0))
                    if x < share:
                        sets.append(chosen[at].astype("<u4").tobytes())
                        weights.append(1 / share)
                        positive.append(side)
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.binary()), pa.array(weights, pa.float64()), pa.array(positive, pa.bool_())],
                                             ["features", "weight", "positive"])

    drawn = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    got = marked.select("text", "toxic", drawn.alias("drawn")).mapInArrow(rows, "features binary, weight double, positive boolean").toArrow()
    sets = [np.frombuffer(x.as_buffer(), "<u4") for x in got["features"]]
    weight, positive = got["weight"].to_numpy(), got["positive"].to_numpy(zero_copy_only=False).astype(bool)
    return [([x for x, of in zip(sets, positive) if of == side], weight[positive == side]) for side in (True, False)]


def choose_features(pos: list[np.ndarray], unl: list[np.ndarray], n: int) -> np.ndarray:
    """The ``n`` features (sorted) that say most about which of the two sets a text is of."""
    both, at = np.unique(np.concatenate([*pos, *unl, np.zeros(0, np.uint32)]), return_inverse=True)
    cut = sum(len(x) for x in pos)
    p, u = (np.bincount(x, minlength=len(both)).astype(float) for x in (at[:cut], at[cut:]))
    g = telling(p, u, len(pos), len(unl))
    best = np.argsort(-g, kind="stable")[:n]
    return np.sort(both[best[g[best] > TELLING]])


def _matrix(sets: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    x = np.zeros((len(sets), len(chosen)), np.float32)
    for i, s in enumerate(sets):
        x[i, np.searchsorted(chosen, s[np.isin(s, chosen)])] = 1
    return x


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, chosen=None, weights=None) -> tuple[np.ndarray, np.ndarray, float]:
    """``(features, weights, bias)`` that minimise the non-negative risk by Adam steps; ``weights`` of either set's texts."""
    chosen = choose_features(pos, unl, FEATURES) if chosen is None else chosen
    vp, vu = (v / v.sum() for v in weights or (np.ones(len(pos)), np.ones(len(unl))))
    xp, xu = _matrix(pos, chosen), _matrix(unl, chosen)
    w = np.zeros(len(chosen) + 1)
    first, second = np.zeros_like(w), np.zeros_like(w)
    w[-1] = -1.0  # most text is clean
    for step in range(1, STEPS + 1):
        sp, su = _sigmoid(xp @ w[:-1] + w[-1]), _sigmoid(xu @ w[:-1] + w[-1])
        dp, du = sp * (1 - sp), su * (1 - su)  # slope of the sigmoid loss, whose value is 1 - s or s
        negative = vu @ su - prior * (vp @ sp)

        def slope(x, d):
            return np.append(d @ x, d.sum())

        gp, gn = -prior * slope(xp, vp * dp), slope(xu, vu * du) - prior * slope(xp, vp * dp)
        g = gp + gn if negative >= 0 else -gn
        g = g + DECAY * np.append(w[:-1], 0) * prior
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return chosen, w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame):
    """The model ``(features, weights, bias)`` of learning rows ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    toxic = marked.where("toxic = 1").select("doc_id")
    n, n_toxic = marked.agg(F.count(F.lit(1)), F.count(F.when(F.col("toxic") == 1, 1))).first()
    if not n_toxic:
        return np.zeros(0, np.uint32), np.zeros(0), -30.0
    toxic = toxic.withColumn("toxic", F.lit(True))
    rows = docs.select("doc_id", "text").join(F.broadcast(toxic) if n_toxic <= BROADCAST_ROWS else toxic, "doc_id", "left") \
        .withColumn("toxic", F.coalesce("toxic", F.lit(False)))
    n_u, n_p = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("toxic"), 1))).first()
    if not n_p:
        return np.zeros(0, np.uint32), np.zeros(0), -30.0
    prior = min(max(n_toxic / n, 0.001), 0.5)
    chosen, p, u = choose_counted(feature_counts(rows), n_p, n_u, FEATURES)
    (pos, vp), (unl, vu) = sampled(rows, chosen, p, u, n_p, n_u)
    if not pos or not unl:
        return np.zeros(0, np.uint32), np.zeros(0), -30.0
    return fit(pos, unl, prior, chosen, (vp, vu))


def score(docs: DataFrame, model) -> DataFrame:
    """``doc_id, score`` (0 to 1) of every row."""
    chosen, weights, bias = model

    def rows(batches):
        near = np.zeros(1 << 16, bool)  # which upper halves the model knows: most features end here
        near[chosen >> np.uint32(16)] = True
        for b in batches:
            z = np.full(b.num_rows, bias)
            seen: dict[int, set] = {}
            for own, points, owner, last in chunks(b["text"].to_pylist()):
                row, found = features(points, owner)
                some = near[found >> np.uint32(16)]
                row, found = row[some], found[some]
                at = np.searchsorted(chosen, found)
                hit = at < len(chosen)
                hit[hit] = chosen[at[hit]] == found[hit]
                both = np.unique(row[hit] * len(chosen) + at[hit]) if len(chosen) else np.zeros(0, np.int64)
                row, at = both // max(len(chosen), 1), both % max(len(chosen), 1)
                if not last or own[0] in seen:  # a long text: a feature counts once over all its slices
                    known = seen.setdefault(own[0], set())
                    new = np.array([a not in known for a in at.tolist()], bool)
                    known.update(at.tolist())
                    row, at = row[new], at[new]
                z += np.bincount(own[row], weights[at], b.num_rows) if len(row) else 0
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(_sigmoid(z))], ["doc_id", "score"])

    return shared.texts(docs).mapInArrow(rows, "doc_id long, score double")
