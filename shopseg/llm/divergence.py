"""Divergence of sources: how a source's words differ from those of the other sources of its language.

Every language keeps the terms that occur in at least ``least_docs`` of its documents, numbered in order. A (lang, source)
group is an array of term numbers with counts, cut in blocks of ``SPAN`` numbers and packed. For every unordered pair
of groups of a language, the two sides' blocks meet in a task: the shorter array is looked up in the longer one, terms that
both have are priced by their two counts, those of one side from the histogram of its counts (less the shared ones),
and those that neither has all at once - in both directions. Sums over blocks are the pair's two divergences.

Shares are whole billionths with one added to every count, worked out exactly whatever the counts.

Null ``text``, ``lang`` and ``source`` are empty strings. A group without any term still counts as one. A text longer than a
block of texts is counted alone, slice by slice. Repeated rows are documents of their own. Other columns, ``doc_id`` included, are ignored, whatever
their names. Ties in rank go by the item's bytes. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopseg.functions.numbering import numbered
from shopseg.llm import shared, words

#: A term is a run of ASCII letters and non-ASCII characters.
GAPS = bytes(b for b in range(128) if not chr(b).isalpha())
_GAP = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
BLOCK, HELD = 6 << 20, 24 << 20
#: Term numbers of a block.
SPAN = 1 << 17
SCALE = 1_000_000_000

COUNTS = "lang string, source string, term string, n long, docs long"


# ---------------------------------------------------------------------------
# Counts
# ---------------------------------------------------------------------------

def _cut_counts(texts: list[bytes], kinds: np.ndarray):
    """Terms of these whole texts, their occurrences, and the texts that hold each."""
    c = words.Cut(b"\n".join(texts), kinds)
    firsts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    doc = np.searchsorted(firsts, c.starts, "right") - 1
    holders = np.unique(c.ids * len(texts) + doc) // len(texts)
    return c.words, c.counts(), np.bincount(holders, minlength=len(c.words))


def _long_counts(text: bytes, kinds: np.ndarray):
    """The same for one text of any length."""
    total: Counter = Counter()
    for piece in words.slices(text, BLOCK, _GAP):
        c = words.Cut(piece, kinds)
        total.update(dict(zip(c.words.to_pylist(), c.counts().tolist())))
    return pa.array(total.keys(), pa.binary()), np.fromiter(total.values(), np.int64, len(total)), np.ones(len(total), np.int64)


def _rows(value: str, n: int) -> pa.Array:
    return pa.DictionaryArray.from_arrays(np.zeros(n, np.int32), pa.array([value], pa.string())).cast(pa.string())


def group_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of each group's terms; every group has a row without a term."""
    kinds = words.byte_kinds(GAPS, b"")

    def counted(batches):
        for (lang, source), texts in words.gathered(batches, lambda b: zip(b["lang"].to_pylist(), b["source"].to_pylist()), BLOCK, HELD):
            long = [t for t in texts if len(t) > BLOCK]
            parts = [_long_counts(t, kinds) for t in long]
            if len(texts) > len(long):
                parts.append(_cut_counts([t for t in texts if len(t) <= BLOCK], kinds))
            for terms, n, holders in parts:
                yield pa.RecordBatch.from_pydict({
                    "lang": _rows(lang, len(terms) + 1), "source": _rows(source, len(terms) + 1),
                    "term": pa.concat_arrays([terms.view(pa.string()), pa.nulls(1, pa.string())]),
                    "n": pa.array(np.append(n, 0), pa.int64()), "docs": pa.array(np.append(holders, 0), pa.int64())})

    own = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    summed = own.mapInArrow(counted, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return shared.written(summed, "group-counts")


class Counts:
    """The tables everything else is worked out from.

    ``own``: ``lang, source, term, id, n, total`` of each group's kept terms (``total``: in the language);
    ``groups``: ``lang, source, n_group, n_lang, v`` of every group.
    """

    def __init__(self, docs: DataFrame, least_docs: int):
        every = group_counts(docs)
        counts = every.where(F.col("term").isNotNull())
        kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total")) \
            .where(F.col("docs") >= least_docs).select("lang", "term", "total")
        kept = shared.written(numbered(kept, ["lang", "term"], "id", by=["lang"]), "kept")
        self.own = shared.written(counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "own")
        langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("n_lang"))
        sums = self.own.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
        zero = F.lit(0).cast("long")
        self.groups = shared.written(
            every.where(F.col("term").isNull()).join(sums, ["lang", "source"], "left").join(langs, "lang", "left").select(
                "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("n_group", "n_lang", "v")]), "groups")


# ---------------------------------------------------------------------------
# Single terms
# ---------------------------------------------------------------------------

def share_sql(count: str, words_: str, v: str) -> str:
    return f"(1 + (CAST({count} + 1 AS DECIMAL(20, 0)) * {SCALE}) div (CAST({words_} AS DECIMAL(20, 0)) + {v}))"


def telling_terms(counts: Counts, top: int = 200) -> DataFrame:
    """``lang, source, item, value, rank``: the ``top`` terms of each group above their share in the language."""
    shares = counts.own.join(counts.groups, ["lang", "source"]).selectExpr(
        "lang", "source", "term AS item", f"{share_sql('n', 'n_group', 'v')} AS p", f"{share_sql('total', 'n_lang', 'v')} AS q")
    priced = shares.where("p > q").selectExpr("lang", "source", "item", "((p - q) * (p - q)) div q AS value")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return priced.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)


# ---------------------------------------------------------------------------
# Pairs of groups
# ---------------------------------------------------------------------------

PACKED = "lang string, source string, block long, ids binary, n binary, n_group long, v long"


def _pack(a: np.ndarray) -> bytes:
    return zstandard.compress(a.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), "<i8") if data else np.zeros(0, np.int64)


def _packed(counts: Counts) -> DataFrame:
    """Each group's sorted arrays by block of term numbers; blocks without any of its terms are empty."""
    arrays = counts.own.groupBy("lang", "source", F.expr(f"id div {SPAN}").alias("block")) \
        .agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("t"))  # at most SPAN terms
    grid = counts.groups.select("lang", "source", "n_group", "v").where("v > 0") \
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(v - 1) div {SPAN}"))))
    whole = grid.join(arrays, ["lang", "source", "block"], "left") \
        .select("lang", "source", "block", F.col("t.id").alias("ids"), F.col("t.n").alias("n"), "n_group", "v")

    def pack(batches):
        for b in batches:
            packed = {"ids": [], "n": []}
            for r in range(b.num_rows):
                for c, out in packed.items():
                    values = b[c][r].values
                    a = np.zeros(0, np.int64) if values is None else values.to_numpy(zero_copy_only=False)
                    out.append(_pack(np.diff(a, prepend=0) if c == "ids" else a))
            yield pa.RecordBatch.from_pydict({c: pa.array(packed[c], pa.binary()) if c in packed else b[c] for c in b.schema.names})

    return shared.written(whole.mapInArrow(pack, PACKED), "packed")


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """``1 + floor(SCALE * (count + 1) / total)``, digit by digit, so that no product passes 64 bits."""
    whole, rest = np.divmod(counts + 1, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digit
    return whole + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def shared_places(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the ascending arrays hold the same numbers: the shorter one gallops through the longer one."""
    if len(a) > len(b):
        return shared_places(b, a)[::-1]
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(b, a)
    hit = b[np.minimum(at, len(b) - 1)] == a
    return np.flatnonzero(hit), at[hit]


def merged(ids_a, n_a, total_a: int, ids_b, n_b, total_b: int, v: int) -> tuple[int, int]:
    """Prices of ``v`` terms in both directions (a's shares against b's, b's against a's)."""
    at_a, at_b = shared_places(ids_a, ids_b)
    none = np.zeros(1, np.int64)
    p0_a, p0_b = shares(none, total_a), shares(none, total_b)
    both_a, both_b = shares(n_a[at_a], total_a), shares(n_b[at_b], total_b)
    out = []
    for (p, p0, n_p, total_p), (q, q0, n_q, total_q) in (
            ((both_a, p0_a, n_a, total_a), (both_b, p0_b, n_b, total_b)),
            ((both_b, p0_b, n_b, total_b), (both_a, p0_a, n_a, total_a))):
        value = int(price(p, q).sum())
        own, times = np.unique(n_p, return_counts=True)
        value += int((price(shares(own, total_p), q0) * times).sum()) - int(price(p, q0).sum())
        own, times = np.unique(n_q, return_counts=True)
        value += int((price(p0, shares(own, total_q)) * times).sum()) - int(price(p0, q).sum())
        out.append(value + int(price(p0, q0)[0]) * (v - len(ids_a) - len(ids_b) + len(at_a)))
    return out[0], out[1]


def pair_divergences(counts: Counts) -> DataFrame:
    """``lang, source, item, value, rank``: every source against every other one of its language."""
    def priced(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for a in left.to_pylist():
            for b in right.to_pylist():  # one row a side
                v = min(SPAN, a["v"] - a["block"] * SPAN)
                ab, ba = merged(np.cumsum(_unpack(a["ids"])), _unpack(a["n"]), a["n_group"] + a["v"],
                                np.cumsum(_unpack(b["ids"])), _unpack(b["n"]), b["n_group"] + b["v"], v)
                rows.append({"lang": a["lang"], "a": a["a"], "b": a["b"], "ab": ab, "ba": ba})
        return pa.Table.from_pylist(rows, pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()),
                                                     ("ab", pa.int64()), ("ba", pa.int64())]))

    packed = _packed(counts)
    # the result has a row for each of these pairs, twice
    names = counts.groups.select("lang", "source")
    pairs = names.withColumnRenamed("source", "a").join(names.withColumnRenamed("source", "b"), "lang").where("a < b")
    key = ["lang", "a", "b", "block"]
    left = packed.withColumnRenamed("source", "a").join(pairs, ["lang", "a"])
    right = packed.withColumnRenamed("source", "b").join(pairs, ["lang", "b"])
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)  # columns of their own for each side
    sums = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(priced, "lang string, a string, b string, ab long, ba long") \
        .groupBy("lang", "a", "b").agg(F.sum("ab").alias("ab"), F.sum("ba").alias("ba"))
    whole = shared.written(pairs.join(sums, ["lang", "a", "b"], "left"), "pairs")
    zero = F.lit(0).cast("long")
    both = whole.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), F.coalesce("ab", zero).alias("value")) \
        .unionByName(whole.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), F.coalesce("ba", zero).alias("value")))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return both.withColumn("rank", F.row_number().over(by_value))


def audit(docs: DataFrame, least_docs: int = 3, top: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank``: parts ``pair`` and ``term``."""
    counts = Counts(docs, least_docs)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pair_divergences(counts).withColumn("part", F.lit("pair")).select(*columns) \
        .unionByName(telling_terms(counts, top).withColumn("part", F.lit("term")).select(*columns))
