"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into few enough segments (three for up to four differing bits) that two linked
fingerprints differ by at most one bit in one of them. Each fingerprint is indexed under every segment with every
single bit of it deleted; fingerprints that share a key are candidates, joined by equality and verified by their
distance. So that a key tells more than a third of the bits, it also holds bits outside its segment: if one segment is
equal, one of ``distance + 1`` pieces of the rest is, too; if none is, two segments differ by exactly one bit, and one half
of the second is equal. That makes 141 keys of about 30 bits for four differing bits, and chance hardly fills a bucket.

Only classes are asked for, so a bucket's pairs are not all formed: its members are compared with one of them
(picked by hash) first, and after the components of these links only members of *different* components are compared with
each other. Large buckets are cut once more, by pieces of the bits that the key leaves open; that loses no
link either. No cap on buckets or candidates.

Words are runs without ``[\\x20\\x09-\\x0D]`` of the text with A-Z lowered; fewer words than the shingle length
make one shingle, none the fingerprint 0. Null text has no words. Equal texts share a fingerprint and so a
class. Null ``doc_id`` links like any other but never is a class id; a class of such rows alone has a null id.
Rows that repeat a ``doc_id`` are linked through it only if their texts are. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopseg.llm import shared
from shopseg.llm.components import components

SEED = 42
#: Bytes of a text whose words are handled at a time.
SPAN = 1 << 20
#: A bucket with more members left to compare is cut once more.
REFINE = 256
_SPACE = b" \t\n\x0b\x0c\r"


def _word_lists(raw: bytes):
    """The words of a text in lists, span by span."""
    at = 0
    while at < len(raw):
        end = at + SPAN
        while end < len(raw) and raw[end] not in _SPACE:
            end += 1
        if words := raw[at:end].split():
            yield words
        at = end


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, lowest first."""
    bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
    full = len(bits) // 255 * 255  # sums of 255 rows fit in a byte, which numpy adds much faster
    return (bits[:full].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
            + bits[full:].sum(0, dtype=np.int64))


def fingerprint(text: str | None, shingle: int) -> int:
    """The unsigned 64-bit SimHash of a whole text."""
    digest, carried = xxhash.xxh64_intdigest, []
    counts, n = np.zeros(64, np.int64), 0
    for words in _word_lists((text or "").encode().lower()):  # bytes.lower() changes A-Z only
        words = carried + words
        carried = words[-shingle + 1:] if shingle > 1 else []
        k = len(words) - shingle + 1
        if k <= 0:
            carried = words
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[:k - 1] + 1).tolist()]
        counts += _bit_counts(np.array([digest(joined[a:z], SEED) for a, z in zip(starts, ends[shingle - 1:].tolist())],
                                       "<u8"))
        n += k
    if not n:
        return digest(b" ".join(carried), SEED) if carried else 0
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``doc_id, __id, __h, fp`` (the fingerprint as a signed long) of every row."""
    def rows(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b["text"]), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["__id"], b["__h"], pa.array(fps.view(np.int64))],
                                             ["doc_id", "__id", "__h", "fp"])

    return shared.keyed(shared.texts(docs)).mapInArrow(rows, "doc_id long, __id long, __h long, fp long")


def _even(bits: list[int], n: int) -> list[int]:
    """Masks of ``n`` pieces of these bits."""
    cuts = [len(bits) * i // n for i in range(n + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(cuts, cuts[1:])]


def segments(distance: int) -> list[list[int]]:
    """Bits of the fewest segments of which, if none is equal, two at least differ by one bit only."""
    n = max(2, (distance + 1) // 2 + 1)
    return [list(range(64 * i // n, 64 * (i + 1) // n)) for i in range(n)]


def key_masks(distance: int) -> list[int]:
    """The bits that each key holds."""
    own, masks = segments(distance), []
    for i, seg in enumerate(own):
        rest = [b for b in range(64) if b not in seg]
        masks += [sum(1 << b for b in seg) | piece for piece in _even(rest, distance + 1)]
        for other in own[i + 1:]:
            masks += [sum(1 << b for b in seg if b != gone) | half for gone in seg for half in _even(other, 2)]
    return masks


def _long(mask: int) -> str:
    return f"{mask - (1 << 64) if mask >> 63 else mask}L".replace("-9223372036854775808L", "(-9223372036854775807L - 1L)")


def links(fps: DataFrame, distance: int) -> DataFrame:
    """Edges ``a, b`` between different fingerprints (column ``fp``, distinct) that connect all that link.

    Each edge is a verified pair within ``distance`` bits; pairs already connected otherwise may be missing.
    """
    masks = key_masks(distance)
    if len(masks) > 256:
        raise ValueError("the distance needs more keys than a key's low byte can number")
    listed = f"array({', '.join(map(_long, masks))})"
    near = f"bit_count(a ^ b) <= {distance}"
    # a key: hash of the bits it holds, its number in the low byte; candidates are verified, so a clash costs a look
    keys = ", ".join(f"(xxhash64(fp & {_long(m)}) & -256L) | {tag}L" for tag, m in enumerate(masks))
    spread = fps.select("fp").repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    keyed = spread.select("fp", F.explode(F.expr(f"array({keys})")).alias("key"))
    bucket = Window.partitionBy("key").orderBy(F.xxhash64("fp", "key"))
    members = keyed.withColumns({"pivot": F.first("fp").over(bucket), "n": F.row_number().over(bucket)}).where("n > 1")
    members = shared.written(members.select("key", "fp", "pivot"), "members")

    star = shared.written(members.select(F.col("fp").alias("a"), F.col("pivot").alias("b")).where(near).distinct(), "star")
    roots = components(star)

    # members other than the pivot, with their class so far; a pair of them is open if the classes differ
    open_ = members.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("key", "fp", F.coalesce("root", "fp").alias("class"))
    open_ = shared.written(open_, "open")
    mixed = open_.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi"), F.count(F.lit(1)).alias("n")) \
        .where("lo <> hi").select("key", "n")
    left = open_.join(mixed, "key")
    free = [_even([b for b in range(64) if not m >> b & 1], distance + 1) for m in masks]
    pieces = f"array({', '.join('array(' + ', '.join(map(_long, f)) + ')' for f in free)})[cast(key & 255L as int)]"
    whole = left.where(f"n <= {REFINE}").select("key", F.lit(-1).alias("piece"), F.lit(0).cast("long").alias("more"), "fp", "class")
    cut = left.where(f"n > {REFINE}").select("key", F.posexplode(F.expr(f"transform({pieces}, m -> fp & m)")).alias("piece", "more"),
                                             "fp", "class")
    left = shared.written(whole.unionByName(cut), "left")
    key = ["key", "piece", "more"]
    one, two = left.select(*key, F.col("fp").alias("a"), F.col("class").alias("c1")), \
        left.select(*key, F.col("fp").alias("b"), F.col("class").alias("c2"))
    # of the keys that a pair shares, the first one finds it
    first = f"NOT exists(slice({listed}, 1, cast(x.key & 255L as int)), m -> ((a ^ b) & m) = 0L)"
    same = " AND ".join(f"x.{k} = y.{k}" for k in key)
    crossed = one.alias("x").join(two.alias("y"), F.expr(f"{same} AND c1 < c2 AND {near} AND {first}"))
    return star.unionByName(crossed.select("a", "b").distinct())


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest ``doc_id`` that can be reached over links, per row."""
    fps = shared.written(fingerprints(docs, shingle), "fingerprints")
    return _with_classes(fps, distance).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest ``doc_id``, and of rows that repeat that id one
    of the least hash of the text. A group of rows without ``doc_id`` keeps one, too."""
    classes = _with_classes(shared.written(fingerprints(docs, shingle), "fingerprints"), distance)
    order = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "__h", "__id"))
    key = shared.spare(docs, "__id", "__h")
    kept = classes.groupBy("class_fp").agg(order.alias("first")) \
        .select(F.col("first.__id").alias(key[0]), F.col("first.__h").alias(key[1]))
    return shared.keyed(docs, *key).join(kept, key, "left_semi").dropDuplicates(key).select(*docs.columns)


def _with_classes(fps: DataFrame, distance: int) -> DataFrame:
    """``fps`` plus ``class_fp`` (smallest fingerprint of the class) and ``component_id`` (smallest ``doc_id``, null if none)."""
    least = shared.written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = shared.written(components(links(least.select("fp"), distance)), "roots")
    smallest = roots.join(least.withColumnRenamed("fp", "node"), "node").groupBy("root").agg(F.min("least").alias("smallest"))
    linked = roots.join(smallest, "root").select(F.col("node").alias("fp"), "root", "smallest")
    ids = least.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("class_fp"),
                                                  F.coalesce("smallest", "least").alias("component_id"))
    ids = shared.written(ids, "ids")  # so that both sides of the join are dealt out anew and a hot fingerprint can be split
    return fps.join(ids, "fp").select(*fps.columns, "class_fp", "component_id")


def hex16(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
