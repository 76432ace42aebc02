"""Frequent itemsets by vertical mining over compressed user sets.

Every user of a level gets a number, and numbers are cut in ranges of 65,536. Per level and range, an item's users are one
container: sorted 16-bit offsets while they are few, a bitmap of 8 KB once that is smaller. The count of an itemset is the
sum over ranges of the size of its items' intersection; sets that begin alike share the intersection of that beginning.

Sets grow by one item a round, so none longer than ``max_len`` is ever built: candidates are joined from the last round's
frequent sets (all their subsets must be frequent), sent to the tasks at most ``ROUND`` at a time, and counted where the containers
lie. With few ranges the candidates are also split by their first item, so that every task has work. A task holds one
range's containers and one array of counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopseg.functions.numbering import numbered, stored
from shopseg.operators.basket import Basket
from shopseg.session import cut_lineage

#: Users of a range; containers with at least so many users are bitmaps; candidates counted in one pass.
RANGE, DENSE, ROUND = 1 << 16, 4_096, 200_000


def container(offsets: np.ndarray) -> np.ndarray:
    """The users at these ascending offsets: 16-bit offsets (uint16) or a bitmap (uint8)."""
    if len(offsets) < DENSE:
        return offsets.astype("<u2")
    bits = np.zeros(RANGE, bool)
    bits[offsets] = True
    return np.packbits(bits, bitorder="little")


def size(a: np.ndarray) -> int:
    return len(a) if a.dtype != np.uint8 else int(np.bitwise_count(a).sum())


def intersection(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.dtype == np.uint8 and b.dtype == np.uint8:
        both = a & b
        return both if size(both) >= DENSE else np.flatnonzero(np.unpackbits(both, bitorder="little")).astype("<u2")
    if b.dtype == np.uint8:
        return a[(b[a >> 3] >> (a & 7).astype(np.uint8)) & 1 > 0]
    if a.dtype == np.uint8 or len(a) > len(b):
        return intersection(b, a)
    at = np.minimum(np.searchsorted(b, a), max(len(b) - 1, 0))
    return a[b[at] == a] if len(b) else a[:0]


TIDSETS = "level string, range long, idx array<int>, dense array<boolean>, sets array<binary>"


def tidsets(bk: Basket, levels: DataFrame) -> DataFrame:
    """``TIDSETS``: a row per level and range of users with the containers of all items there; stored."""
    member = bk.basket.join(F.broadcast(levels.select("level")), "level", "left_semi").select("level", "User_ID", "idx")
    users = numbered(member.select("level", "User_ID").distinct(), ["level", "User_ID"], "n", by=["level"])
    rows = member.join(users, ["level", "User_ID"]).select(
        "level", F.expr(f"n div {RANGE}").alias("range"), "idx", F.expr(f"CAST(n % {RANGE} AS INT)").alias("at"))

    def packed(batches):
        key, found, open_idx, open_at = None, [], None, []

        def closed():
            if open_idx is not None:
                found.append((open_idx, container(np.concatenate(open_at))))

        def row():
            return pa.RecordBatch.from_pydict({
                "level": pa.array([key[0]], pa.string()), "range": pa.array([key[1]], pa.int64()),
                "idx": pa.array([[i for i, _ in found]], pa.list_(pa.int32())),
                "dense": pa.array([[s.dtype == np.uint8 for _, s in found]], pa.list_(pa.bool_())),
                "sets": pa.array([[s.tobytes() for _, s in found]], pa.list_(pa.binary()))})

        for b in batches:
            own, idx = list(zip(b["level"].to_pylist(), b["range"].to_pylist())), b["idx"].to_numpy(zero_copy_only=False)
            at = b["at"].to_numpy(zero_copy_only=False)
            cuts = [0, *(i for i in range(1, b.num_rows) if own[i] != own[i - 1] or idx[i] != idx[i - 1]), b.num_rows]
            for a, z in zip(cuts, cuts[1:]):
                if a == z:
                    continue
                if own[a] != key or idx[a] != open_idx:
                    closed()
                    open_idx, open_at = int(idx[a]), []
                    if own[a] != key:
                        if key is not None:
                            yield row()
                        key, found = own[a], []
                open_at.append(at[a:z])
        if key is not None:
            closed()
            yield row()

    parts = int(bk.basket.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "level", "range").sortWithinPartitions("level", "range", "idx", "at")
    return stored(dealt.mapInArrow(packed, TIDSETS), "tidsets")


def _counted(sets: DataFrame, candidates: DataFrame, length: int) -> DataFrame:
    """``level, items, freq`` of ``candidates`` (``level, items, no``), at most ``ROUND`` of them."""
    spark = sets.sparkSession
    by_level: dict[str, list] = {}
    for r in sorted(candidates.collect(), key=lambda r: (r.level, r["items"])):  # one round
        by_level.setdefault(r.level, []).append((r.no, r["items"]))
    sent = spark.sparkContext.broadcast(by_level)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    splits = -(-tasks // max(sets.select("level", "range").count(), 1))
    dealt = sets.withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(splits - 1)))).repartition(tasks, "level", "range", "split")

    def count(batches):
        totals: dict[int, int] = {}
        for b in batches:
            for r in range(b.num_rows):
                users = {i: np.frombuffer(s, np.uint8 if d else "<u2")
                         for i, d, s in zip(*(b[c][r].as_py() for c in ("idx", "dense", "sets")))}
                split = b["split"][r].as_py()
                none = np.zeros(0, "<u2")
                begun: list = []  # the last set's items with the intersections of its beginnings
                for no, items in sent.value.get(b["level"][r].as_py(), ()):
                    if items[0] % splits != split:
                        continue
                    same = 0
                    while same < min(len(begun), length - 1) and begun[same][0] == items[same]:
                        same += 1
                    del begun[same:]
                    for i in items[same:]:
                        own = users.get(i, none)
                        begun.append((i, intersection(begun[-1][1], own) if begun else own))
                    if n := size(begun[-1][1]):
                        totals[no] = totals.get(no, 0) + n
        yield pa.RecordBatch.from_pydict({"no": pa.array(totals.keys(), pa.int64()), "n": pa.array(totals.values(), pa.int64())})

    counts = dealt.mapInArrow(count, "no long, n long").groupBy("no").agg(F.sum("n").alias("freq"))
    out = cut_lineage(candidates.join(counts, "no").select("level", "items", "freq"))
    sent.destroy()
    return out


def frequent_itemsets_vertical(bk: Basket, params: DataFrame) -> DataFrame:
    """R3 for every level of ``params`` (``level, min_support, max_len``): ``level, items, freq``."""
    from shopseg.operators.rules import candidate_sets, named_sets

    floor = cut_lineage(params.select("level", "min_support", "max_len").join(bk.basket_users, "level")
                        .withColumn("U", F.col("U").cast("double")))
    longest = floor.agg(F.max("max_len")).first()[0] or 0

    def frequent(counted: DataFrame, length: int) -> DataFrame:
        return cut_lineage(counted.join(F.broadcast(floor.where(F.col("max_len") >= length)), "level")
                           .where(F.col("freq") / F.col("U") >= F.col("min_support")).select("level", "items", "freq"))

    found = [frequent(bk.kept.select("level", F.array("idx").alias("items"), F.col("user_count").cast("long").alias("freq")), 1)]
    sets = tidsets(bk, floor)
    for length in range(2, longest + 1):
        candidates = cut_lineage(numbered(candidate_sets(found[-1], length), ["level", "items"], "no"))
        n, counted = candidates.count(), None
        for first in range(0, n, ROUND):
            part = _counted(sets, candidates.where((F.col("no") >= first) & (F.col("no") < first + ROUND)), length)
            counted = part if counted is None else counted.unionByName(part)
        if counted is None:
            break
        found.append(frequent(counted, length))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return named_sets(every, bk)
