"""Best-fit packing of tokenized documents into sequences of a fixed capacity (large-item matching).

Lengths are whole numbers up to the capacity, so the packing is worked out on their histogram, which has
at most ``capacity`` rows whatever the corpus: items above one third of the capacity are matched
greedily, largest first, with the largest partner that still fits (two of them per sequence at most);
then smaller items, longest first, go to the smallest gap that holds them, which is sequential best
fit done for all items of a length at once. The outcome is a list of runs ("items r0..r1 of length L go
to sequences s0.., k each, from offset o"), bounded by the capacity too. Each piece finds its run by its
length and its number among the pieces of that length; Spark counts those numbers in salted groups, so a
length that a third of all pieces share is no hot group.

Null or empty text: the end id alone. Null ``doc_id`` stays null; rows that repeat a ``doc_id`` are
documents of their own. Documents longer than the capacity are cut into full pieces after a first piece
that holds the rest (a full one if nothing is left over). An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopseg.llm import shared, tokens

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
RUNS = "length long, r0 long, r1 long, seq0 long, per_seq long, offset0 long"
#: Pieces that one salted group of a length holds, about.
GROUP = 1_000_000


def document_pieces(docs: DataFrame, capacity: int, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every whole text's ids, cut at the capacity."""
    tokenizer = tokenizer or tokens.default_tokenizer()
    end = end_id.to_bytes(4, "little")

    def pieces(batches):
        enc = tokens.encoder(tokenizer)
        for b in batches:
            out = []
            texts = [t or b"" for t in b["text"].cast(pa.binary()).to_pylist()]
            for i, encoded in zip(b["doc_id"].to_pylist(), enc.encode_all(texts)):
                ids = encoded.tobytes() + end
                n = len(ids) // 4
                first = n % capacity or min(n, capacity)
                cuts = [0, *range(first, n + 1, capacity)]
                out += [(i, k, a, z - a, zlib.crc32(ids[4 * a:4 * z])) for k, (a, z) in enumerate(zip(cuts, cuts[1:]))]
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    return shared.texts(docs).mapInArrow(pieces, PIECES)


class _Sequences:
    """Sequences by free space, as ranges ``(first, count)``; equal sequences are handled together."""

    def __init__(self):
        self.gaps: dict[int, list[tuple[int, int]]] = {}
        self.sizes: list[int] = []  # the gaps there are, ascending
        self.n = 0

    def put(self, gap: int, first: int, count: int) -> None:
        if gap > 0 and count > 0:
            if gap not in self.gaps:
                bisect.insort(self.sizes, gap)
                self.gaps[gap] = []
            self.gaps[gap].append((first, count))

    def take(self, least: int) -> tuple[int, int, int] | None:
        """A range of the sequences with the smallest gap of at least ``least``."""
        at = bisect.bisect_left(self.sizes, least)
        if at == len(self.sizes):
            return None
        gap = self.sizes[at]
        first, count = self.gaps[gap].pop()
        if not self.gaps[gap]:
            del self.gaps[gap]
            del self.sizes[at]
        return gap, first, count

    def new(self, count: int) -> int:
        self.n += count
        return self.n - count


def pack_histogram(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs ``(length, r0, r1, seq0, per_seq, offset0)`` that place ``counts[length]`` items of each length.

    Item number r (r0 <= r < r1) goes to sequence ``seq0 + (r - r0) // per_seq`` at offset
    ``offset0 + (r - r0) % per_seq * length``.
    """
    left, used, runs, seqs = Counter({k: n for k, n in counts.items() if n}), Counter(), [], _Sequences()
    if any(not 0 < k <= capacity for k in left):
        raise ValueError("lengths must be 1 to the capacity")

    def place(length: int, count: int, seq0: int, per_seq: int, offset0: int) -> None:
        runs.append((length, used[length], used[length] + count, seq0, per_seq, offset0))
        used[length] += count
        left[length] -= count

    large = sorted(k for k in left if 3 * k > capacity)
    for length in reversed(large):
        while left[length]:
            # the longest partner that fits, itself included
            at = bisect.bisect_right(large, min(capacity - length, length)) - 1
            while at >= 0 and left[large[at]] <= (large[at] == length):
                at -= 1
            if at < 0:
                n = left[length]
                first = seqs.new(n)
                place(length, n, first, 1, 0)
                seqs.put(capacity - length, first, n)
            elif (mate := large[at]) == length:
                n = left[length] // 2
                first = seqs.new(n)
                place(length, 2 * n, first, 2, 0)
                seqs.put(capacity - 2 * length, first, n)
            else:
                n = min(left[length], left[mate])
                first = seqs.new(n)
                place(length, n, first, 1, 0)
                place(mate, n, first, 1, length)
                seqs.put(capacity - length - mate, first, n)
    for length in sorted((k for k in left if left[k] and 3 * k <= capacity), reverse=True):
        while left[length]:
            gap, first, count = seqs.take(length) or (capacity, None, None)
            fit = gap // length
            if first is None:
                count = -(-left[length] // fit)
                first = seqs.new(count)
            full = min(count, left[length] // fit)
            if full:
                place(length, full * fit, first, fit, capacity - gap)
                seqs.put(gap - fit * length, first, full)
            if full < count and (rest := left[length]):  # fewer than one sequence takes; it stays the tightest
                place(length, rest, first + full, rest, capacity - gap)
                seqs.put(gap - rest * length, first + full, 1)
                full += 1
            seqs.put(gap, first + full, count - full)
    return runs


def pack_items(items: DataFrame, capacity: int) -> DataFrame:
    """``items`` (with ``doc_id``, ``piece``, ``length``) plus ``sequence_id`` and ``offset``.

    ``items`` is read several times: pass a written table.
    """
    spark = items.sparkSession
    sizes = items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most `capacity` rows
    runs = pack_histogram({r.length: r.n for r in sizes}, capacity)
    salts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(r.n for r in sizes) // GROUP)
    ties = [c for c in items.columns if c not in ("length", "doc_id", "piece")]
    salted = items.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    numbered = salted.withColumn("__n", F.row_number().over(
        Window.partitionBy("length", "__salt").orderBy("doc_id", "piece", *ties)) - F.lit(1))
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = salted.groupBy("length", "__salt").agg(F.count(F.lit(1)).alias("__rows")).select(
        "length", "__salt", F.coalesce(F.sum("__rows").over(before), F.lit(0).cast("long")).alias("__before"))
    ranked = numbered.join(firsts, ["length", "__salt"]) \
        .withColumn("__r", F.col("__n").cast("long") + F.col("__before"))
    plan = spark.createDataFrame(runs, RUNS).withColumnsRenamed({"length": "__length"})
    k = F.col("__r") - F.col("r0")
    return ranked.join(F.broadcast(plan), (F.col("length") == F.col("__length")) & (F.col("__r") >= F.col("r0"))
                       & (F.col("__r") < F.col("r1"))).select(
        *items.columns,
        (F.col("seq0") + F.expr("(__r - r0) div per_seq")).alias("sequence_id"),
        (F.col("offset0") + k % F.col("per_seq") * F.col("length")).alias("offset"))


def pack_documents(docs: DataFrame, capacity: int = 2048, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """Per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    pieces = shared.written(document_pieces(docs, capacity, tokenizer, end_id), "pieces")
    return pack_items(pieces, capacity)
