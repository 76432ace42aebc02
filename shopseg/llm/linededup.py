"""Line dedup: of a line that several documents hold, only the document with the smallest id keeps it.

Every line's key (white space stripped, A-Z lowered) becomes a 128-bit hash. The hashes are
range-partitioned and sorted by hash, document and position, so equal lines lie next to each other, in
document order, and a line that a third of all documents hold spans many partitions. A stream over the
sorted rows gives each hash's first document (partitions that share a hash add one row each to that);
later occurrences are dropped. The decision is returned as a bitmap per document, compressed: 64 lines a
word, only words with a dropped line. ``apply_bitmaps`` makes texts of it.

Null or empty text is one empty line. Documents with null ``doc_id`` are neither index nor dropped: they
keep every line. Rows with the same ``doc_id`` are one document as far as "several documents" goes; they
have a bitmap each (told apart by a hash of the text). An empty table gives no rows. Extra columns come back
untouched, whatever their names. A text of any length is split and joined again as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopseg.llm import shared

#: The white space that a key loses at both ends.
SPACE = r"[\x20\x09-\x0D]"
WORD = 64
#: Columns that ``apply_bitmaps`` adds.
ADDED = ("__n_lines", "__n_dropped", "__kept")


def _rows(docs: DataFrame) -> DataFrame:
    return shared.texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("text_hash", F.xxhash64("text"))


def line_hashes(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """A row per line whose key has at least ``min_chars`` code points: ``h1, h2, doc_id, text_hash, pos``."""
    lines = _rows(docs).where(F.col("doc_id").isNotNull()).select(
        "doc_id", "text_hash", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    key = shared.lower_ascii(F.btrim("line", F.lit(" \t\n\x0b\x0c\r")))
    keyed = lines.select("doc_id", "text_hash", "pos", key.alias("key")).where(F.char_length("key") >= min_chars)
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"),
                        "doc_id", "text_hash", "pos")


def keep_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``doc_id, text_hash, dropped`` of each document that loses a line.

    ``dropped``: map from word number to the 64 bits of that word; bit ``pos % 64`` of word ``pos div 64``
    is set if line ``pos`` goes. Words without a dropped line are left out.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["h1", "h2", "doc_id", "pos"]
    hashes = shared.written(line_hashes(docs, min_chars), "lines")  # sampled and dealt without reading texts again
    dealt = shared.written(hashes.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                           .withColumn("part", F.spark_partition_id()), "sorted")
    # a hash can go on from one partition to the next: the first document of the one each partition starts with
    edges = dealt.groupBy("part").agg(F.min(F.struct("h1", "h2")).alias("lo"),
                                      F.max(F.struct("h1", "h2", F.bitwise_not("doc_id").alias("rev"))).alias("hi"))
    began = edges.groupBy(F.col("hi.h1").alias("h1"), F.col("hi.h2").alias("h2")) \
        .agg(F.min(F.bitwise_not("hi.rev")).alias("earlier"))
    carried = edges.select("part", "lo.h1", "lo.h2").join(began, ["h1", "h2"])  # a row per partition at most
    stream = Window.partitionBy("part", "h1", "h2").orderBy("doc_id", "pos")
    gone = dealt.withColumn("first", F.first("doc_id").over(stream)) \
        .join(F.broadcast(carried), ["part", "h1", "h2"], "left") \
        .where(F.col("doc_id") > F.least("first", "earlier"))
    words = gone.groupBy("doc_id", "text_hash", F.expr(f"pos div {WORD}").cast("int").alias("word")) \
        .agg(F.bit_or(F.expr(f"shiftleft(1L, pos % {WORD})")).alias("bits"))
    return words.groupBy("doc_id", "text_hash").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("dropped"))


def dropped_count(dropped):
    """Lines a bitmap drops (0 for null)."""
    return F.coalesce(F.aggregate(F.map_values(dropped), F.lit(0).cast("long"), lambda n, b: n + F.bit_count(b)),
                      F.lit(0).cast("long"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with the columns ``ADDED``: lines, dropped lines, and the text without the dropped lines.

    Where ``docs`` has such columns itself, the new ones are called ``shared.spare(docs, *ADDED)``.
    """
    n_lines, n_dropped, kept_text, own_id, own_hash, bits = shared.spare(docs, *ADDED, "__id", "__hash", "__dropped")
    marked = docs.withColumn(own_id, F.col("doc_id").cast("long")) \
        .withColumn(own_hash, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    b = bitmaps.select(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash), F.col("dropped").alias(bits))
    joined = marked.join(b, [own_id, own_hash], "left")
    lines = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")
    # an unset word reads as 0
    kept = F.expr(
        f"filter(split(coalesce(cast(text as string), ''), '\\n'), (x, i) -> "
        f"shiftright(coalesce(try_element_at({bits}, cast(i div {WORD} as int)), 0L), i % {WORD}) & 1L = 0L)")
    kept = F.when(F.col(bits).isNull(), F.coalesce(F.col("text").cast("string"), F.lit(""))) \
        .otherwise(F.array_join(kept, "\n"))
    return joined.withColumns({n_lines: F.size(lines).cast("long"), n_dropped: dropped_count(F.col(bits)), kept_text: kept}) \
        .select(*docs.columns, n_lines, n_dropped, kept_text)
