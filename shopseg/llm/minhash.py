"""MinHash fingerprints over word shingles, and near-duplicates by signature bands.

A fingerprint is the least value of each of ``PERMUTATIONS`` universal hash functions (odd multiplier and offset modulo
2**64, upper bits) over the text's shingles, 16 bits of each kept; two fingerprints' likeness is the share of equal
places, an estimate of their shingle sets' Jaccard similarity. Bands of ``ROWS`` places are one 64-bit key each; texts
that share a key are candidates, joined in Spark, and verified by the exact Jaccard similarity.

Words are runs without ``[\\x20\\x09-\\x0D]`` of the text with A-Z lowered; fewer than a shingle's words make one shingle,
none the empty fingerprint (all ones). Null text is empty. Equal texts have equal fingerprints. Null ``doc_id``
sorts first; rows that repeat a ``doc_id`` follow each other by a hash of their text. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopseg.llm import shared
from shopseg.llm.arrays import mixed, span_hashes
from shopseg.llm.components import components

SHINGLE, THRESHOLD = 5, 0.8
PERMUTATIONS, ROWS = 64, 4
#: Code points of texts whose shingles are hashed together, and shingles that go through the permutations together.
SPAN, BLOCK = 1 << 18, 1 << 14
_SEED = 20_231

_rng = np.random.default_rng(_SEED)
_MULTIPLIERS = _rng.integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _rng.integers(0, 1 << 63, PERMUTATIONS, np.uint64)
#: How a shingle's words are told apart by their place.
_PLACES = _rng.integers(0, 1 << 63, 16, np.uint64) * np.uint64(2) + np.uint64(1)


def _words(points: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hash)`` of every word."""
    points = np.where((points >= 65) & (points <= 90), points + np.uint32(32), points)
    word = ~((points == 32) | ((points >= 9) & (points <= 13)))
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return owner[starts], span_hashes(points, starts, ends)


def _combined(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive word hashes."""
    n = len(words) - size + 1
    with np.errstate(over="ignore"):
        total = np.zeros(max(n, 0), np.uint64)
        for k in range(size):
            total += words[k:k + n] * _PLACES[k] if n > 0 else 0
    return mixed(total)


def _least(into: np.ndarray, rows: np.ndarray, hashes: np.ndarray) -> None:
    """Lower the signatures ``into[rows]`` by the shingle hashes; equal rows are adjacent."""
    for a in range(0, len(hashes), BLOCK):
        h, r = hashes[a:a + BLOCK], rows[a:a + BLOCK]
        cuts = np.flatnonzero(np.diff(r, prepend=-1))
        own = r[cuts]
        with np.errstate(over="ignore"):
            for p in range(PERMUTATIONS):
                least = np.minimum.reduceat((h * _MULTIPLIERS[p] + _OFFSETS[p]) >> np.uint64(32), cuts)
                into[own, p] = np.minimum(into[own, p], least)


def _hashes(texts: list[str], size: int):
    """``(rows, shingle hashes)`` in groups of texts, or of spans of a long text, of bounded size."""
    def word_hashes(group):
        lengths = np.fromiter((len(t) + 1 for t in group), np.int64, len(group))
        points = np.frombuffer((" ".join(group) + " ").encode("utf-32-le", "surrogatepass"), "<u4")
        return _words(points, np.repeat(np.arange(len(group)), lengths))

    def shingled(rows, row, words):
        if len(words) < size:
            n = np.zeros(0, np.int64)
            full = np.zeros(0, np.uint64)
        else:
            full = _combined(words, size)
            whole = row[:len(full)] == row[size - 1:]  # no shingle reaches into the next text
            n, full = row[:len(full)][whole], full[whole]
        counts = np.bincount(row, minlength=len(rows))
        few = np.flatnonzero((counts > 0) & (counts < size))
        at = np.concatenate([[0], np.cumsum(counts)])
        single = np.array([int(_combined(words[at[i]:at[i + 1]], counts[i])[0]) for i in few], np.uint64)
        order = np.argsort(np.concatenate([n, few]), kind="stable")
        return np.asarray(rows)[np.concatenate([n, few])[order]], np.concatenate([full, single])[order]

    rows, group, length = [], [], 0
    for i, t in enumerate(texts):
        if len(t) > SPAN:
            carried = np.zeros(0, np.uint64)
            total = 0
            for part in _parts(t):
                _, words = word_hashes([part])
                total += len(words)
                words = np.concatenate([carried, words])
                if len(words) >= size:
                    h = _combined(words, size)
                    yield np.full(len(h), i), h
                carried = words[max(0, len(words) - size + 1):]
            if 0 < total < size:
                yield np.array([i]), _combined(carried, total)
            continue
        if group and length + len(t) > SPAN:
            yield shingled(rows, *word_hashes(group))
            rows, group, length = [], [], 0
        rows.append(i)
        group.append(t)
        length += len(t) + 1
    if group:
        yield shingled(rows, *word_hashes(group))


def _parts(text: str):
    at = 0
    while at < len(text):
        end = min((e for e in (text.find(" ", at + SPAN), text.find("\n", at + SPAN)) if e >= 0), default=len(text))
        yield text[at:end]
        at = end


def signatures(texts: list[str], size: int = SHINGLE) -> np.ndarray:
    """A row of ``PERMUTATIONS`` unsigned 16-bit values per text."""
    out = np.full((len(texts), PERMUTATIONS), (1 << 32) - 1, np.uint64)
    for rows, hashes in _hashes(texts, size):
        if len(rows):
            _least(out, rows, hashes)
    return out.astype(np.uint16)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the beginning of ``following``."""
    q = len(text) // 4
    return text[:len(text) - q] + following[:q]


def _ordered(docs: DataFrame) -> DataFrame:
    """Rows by ``doc_id`` (then a hash of the text) in range partitions."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = shared.texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    return rows.repartitionByRange(parts, "doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie", "row").select("doc_id", "text")


_ROW = ("doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
        "near_edited double, near_next double")


def _compared(ids, texts, following, own, nexts, size) -> pa.RecordBatch:
    """Result rows of texts, the text after each, and both signatures."""
    edits = [edited(t, f) for t, f in zip(texts, following)]
    sigs = signatures(edits, size)
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(ids, pa.int64()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edits], pa.string()),
        "fingerprint": pa.array([s.tobytes() for s in own], pa.binary()),
        "edited_fingerprint": pa.array([s.tobytes() for s in sigs], pa.binary()),
        "near_edited": pa.array((own == sigs).mean(1) if len(ids) else [], pa.float64()),
        "near_next": pa.array((own == nexts).mean(1) if len(ids) else [], pa.float64())})


def compare_with_next(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Fingerprints of every text and of its edited text (see ``edited``; the next document by ``doc_id``, the first after
    the last), and their likeness: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    """
    spark = docs.sparkSession

    def rows(batches):
        part, before = TaskContext.get().partitionId(), None  # the row whose next one has not come yet

        def border(kind, doc_id, text):
            empty = _compared([], [], [], np.zeros((0, PERMUTATIONS), np.uint16), np.zeros((0, PERMUTATIONS), np.uint16), size)
            columns = [pa.nulls(1, f.type) for f in empty.schema]
            columns[0] = pa.array([doc_id], pa.int64())
            return _marked(pa.RecordBatch.from_arrays(columns, empty.schema.names), kind, [text])

        def _marked(batch, kind, texts=None):
            n = batch.num_rows
            return pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * n, pa.int32()), pa.array([kind] * n, pa.int32()), pa.array(texts or [None] * n, pa.string())],
                [*batch.schema.names, "part", "border", "text"])

        for b in batches:
            for at in range(0, b.num_rows, 512):
                ids, texts = b["doc_id"].slice(at, 512).to_pylist(), b["text"].slice(at, 512).to_pylist()
                sigs = signatures(texts, size)
                if before is None:
                    yield border(1, ids[0], texts[0])
                else:
                    ids, texts, sigs = [before[0], *ids], [before[1], *texts], np.vstack([before[2][None], sigs])
                yield _marked(_compared(ids[:-1], texts[:-1], texts[1:], sigs[:-1], sigs[1:], size), 0)
                before = ids[-1], texts[-1], sigs[-1]
        if before is not None:
            yield border(2, before[0], before[1])

    done = shared.written(_ordered(docs).mapInArrow(rows, f"{_ROW}, part int, border int, text string"), "fingerprints")
    # each partition's last text and the first of the next partition (or of the first): one pair per partition
    last = done.where("border = 2").select("part", "doc_id", "text")
    first = done.where("border = 1").select(F.col("part").alias("next"), F.col("text").alias("following"))
    parts = first.select("next").withColumnRenamed("next", "part")
    after = Window.orderBy("part")
    follows = parts.select("part", F.coalesce(F.lead("part").over(after), F.first("part").over(after)).alias("next"))
    pairs = last.join(follows, "part").join(first, "next").select("doc_id", "text", "following")

    def borders(batches):
        for b in batches:
            texts, following = b["text"].to_pylist(), b["following"].to_pylist()
            yield _compared(b["doc_id"].to_pylist(), texts, following, signatures(texts, size), signatures(following, size), size)

    names = done.columns[:-3]
    return done.where("border = 0").select(*names).unionByName(pairs.mapInArrow(borders, _ROW))


def _nodes(docs: DataFrame, size: int) -> DataFrame:
    """``node, fingerprint, shingles`` of each different text; ``node`` its smallest row number, ``shingles`` its set of hashes."""
    def rows(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                texts = b["text"].slice(at, 256).to_pylist()
                sets: list = [np.zeros(0, np.uint64)] * len(texts)
                for own, hashes in _hashes(texts, size):
                    for r in np.unique(own):
                        sets[r] = np.union1d(sets[r], hashes[own == r])
                yield pa.RecordBatch.from_pydict({
                    "node": b["node"].slice(at, 256), "fingerprint": pa.array([s.tobytes() for s in signatures(texts, size)], pa.binary()),
                    "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))})

    return docs.mapInArrow(rows, "node long, fingerprint binary, shingles array<long>")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """``doc_id, component_id``: the smallest ``doc_id`` reachable over pairs of Jaccard similarity of at least ``threshold``.

    Candidates share a band. Each bucket's members are compared with its smallest one; then only members of different
    components are compared with each other, so that a bucket of many copies costs no pairs of its own.
    """
    rows = shared.texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("text"), "text").alias("h2"))
    ids = shared.written(rows.select("doc_id", "h1", "h2"), "ids")
    distinct = ids.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"))
    distinct = shared.written(distinct.withColumn("node", F.monotonically_increasing_id()), "texts")
    one = rows.groupBy("h1", "h2").agg(F.first("text").alias("text")).join(distinct, ["h1", "h2"]).select("node", "text")
    nodes = shared.written(_nodes(one, size), "nodes")

    bands = PERMUTATIONS // ROWS
    keys = ", ".join(f"xxhash64({i}, substring(fingerprint, {2 * ROWS * i + 1}, {2 * ROWS}))" for i in range(bands))
    keyed = nodes.select("node", F.explode(F.expr(f"array({keys})")).alias("key"))
    buckets = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("pivot")).where("n > 1")
    members = shared.written(keyed.join(buckets, "key").where("node <> pivot"), "members")

    def verified(pairs):
        sets = nodes.select("node", "shingles")
        both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a") \
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
        shared_ = F.size(F.array_intersect("x", "y"))
        total = F.size("x") + F.size("y") - shared_
        return both.where((total == 0) | (shared_ >= threshold * total)).select("a", "b")

    star = shared.written(verified(members.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()), "star")
    roots = components(star)
    left = members.where("n > 2").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("class"))
    left = shared.written(left, "left")
    classes = left.select("key", "class").distinct()
    pairs = classes.withColumnRenamed("class", "c1").join(classes.withColumnRenamed("class", "c2"), "key").where("c1 < c2")
    crossed = pairs.join(left.select("key", F.col("class").alias("c1"), F.col("node").alias("a")), ["key", "c1"]) \
        .join(left.select("key", F.col("class").alias("c2"), F.col("node").alias("b")), ["key", "c2"])
    links = shared.written(star.unionByName(verified(crossed.select("a", "b").distinct())), "links")
    roots = shared.written(components(links), "roots")
    smallest = roots.join(distinct, "node").groupBy("root").agg(F.min("least").alias("smallest"))
    linked = roots.join(smallest, "root").select("node", "smallest")
    classes = distinct.join(linked, "node", "left").select("h1", "h2", F.coalesce("smallest", "least").alias("component_id"))
    return ids.join(classes, ["h1", "h2"]).select("doc_id", "component_id")
