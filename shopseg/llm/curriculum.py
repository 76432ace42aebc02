"""Mix sources to target weights along a curriculum: every source's weight may change over the training run.

A source's schedule is a piecewise linear weight over training time 0 to 1; its mean (the integral) is the weight that
shares the words out. A target stops at ``most`` times the source's words; what is above goes to the other sources by
weight, worked out in one sorted pass: ordered by how soon they fill up, the sources before the first one that
does not fill take all they may, the others share the rest.

Each source's documents stand in an order drawn by hash; repeated ``most`` times they are its stream, and the
mix takes the stream's first ``target`` words (the last document only as far as that). The middle of each copy's
words, as a share of the target, is the demand to be met there; inverting the schedule's integral
gives the time in training at which the copy comes. Copies are then range-sorted by time and numbered.

Sizes are words. Null text counts none, so such documents are never taken (and have no time). Null ``source`` is a source of its own, after
all others. Null ``doc_id`` is ordered as an empty one; rows that repeat a ``doc_id`` are documents of their own. A text of any
length is one document. Other columns are ignored, whatever their names. Copies due at the same time follow the drawn order. An empty
table gives no rows. A source of any size spans as many range partitions as it needs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopseg.functions.numbering import PART, dealt_by_range, numbered, stored, totals_before
from shopseg.llm import shared

#: What separates words.
WORD = r"[^\x20\x09-\x0D]+"
#: Schedules (time, weight) with means 5, 2 and 1: heavy sources early, light ones late.
SCHEDULES = [[(0.0, 7.5), (1.0, 2.5)], [(0.0, 2.0), (1.0, 2.0)], [(0.0, 0.5), (1.0, 1.5)]]
_ORDER = ["draw", "doc_id", "size", "text_crc32", "row"]


def _same(left: str, right: str, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, draw, text_crc32, row`` of every document, stored."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return stored(docs.select(
        doc_id.alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")).alias("draw"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("row")), "sizes")


def _curve(knots: list[tuple[float, float]]) -> tuple[list[tuple[float, float, float, float]], float]:
    """Segments ``(time, weight, slope, integral before)`` of a schedule, and its whole integral."""
    times = [t for t, _ in knots]
    if len(knots) < 2 or times[0] != 0 or times[-1] != 1 or any(a >= b for a, b in zip(times, times[1:])) or any(w < 0 for _, w in knots):
        raise ValueError("a schedule needs times rising from 0 to 1 and weights of at least 0")
    area, out = 0.0, []
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        out.append((t0, w0, (w1 - w0) / (t1 - t0), area))
        area += (t1 - t0) * (w0 + w1) / 2
    if area <= 0:
        raise ValueError("a schedule's weight must not be 0 throughout")
    return out, area


def source_targets(sizes: DataFrame, schedules=SCHEDULES, share: float = 1.5, most: int = 2) -> DataFrame:
    """Per source (``sizes``: ``source, size``): ``source, source_size, weight, curve, target``.

    ``schedules`` are dealt to the sources in code point order, over and over.
    """
    spark = sizes.sparkSession
    curves = spark.createDataFrame([(i, w, c) for i, (c, w) in enumerate(map(_curve, schedules))],
                                   "turn long, weight double, curve array<struct<t double, w double, slope double, area double>>")
    sources = numbered(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), [F.asc_nulls_last("source")], "place")
    weighed = sources.withColumn("turn", F.col("place") % len(schedules)).join(F.broadcast(curves), "turn")
    weighed = weighed.withColumn("cap", most * F.col("source_size")).withColumn("full_at", F.col("cap") / F.col("weight"))
    dealt = dealt_by_range(weighed.drop("turn"), ["full_at", "place"], "sources")
    before = totals_before(dealt, [], {"cap_before": F.sum("cap"), "weight_before": F.sum("weight")})
    # a single row
    whole = dealt.agg(F.sum("weight").alias("weights"), (F.sum("source_size") * F.lit(share)).alias("words"))
    own = Window.partitionBy(PART).orderBy("full_at", "place").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    filling = dealt.join(before, PART).crossJoin(F.broadcast(whole)).withColumn("level", (
        F.col("words") - F.col("cap_before") - F.coalesce(F.sum("cap").over(own), zero)) / (
        F.col("weights") - F.col("weight_before") - F.coalesce(F.sum("weight").over(own), zero)))
    # the first source that the level does not fill decides the level; a single row
    level = filling.where("level <= full_at").agg(F.min(F.struct("full_at", "place", "level")).alias("first"))
    return dealt.crossJoin(F.broadcast(level)).select(
        "source", "source_size", "weight", "curve",
        F.when(F.col("first").isNull(), F.col("cap").cast("double"))
        .otherwise(F.least(F.col("cap").cast("double"), F.col("weight") * F.col("first.level"))).alias("target"))


def _time(demand: str) -> str:
    """SQL: the time at which a source (``curve``, ``weight``) has met this share of its demand."""
    # y words of weight into a segment: w * d + slope * d * d / 2 = y
    y = f"({demand} * weight - s.area)"
    root = f"(s.w + sqrt(greatest(s.w * s.w + 2 * s.slope * {y}, 0D)))"
    step = f"transform(array(element_at(filter(curve, g -> g.area <= {demand} * weight), -1)), " \
           f"s -> s.t + CASE WHEN {root} > 0 THEN 2 * {y} / {root} ELSE 0D END)[0]"
    return f"least(1D, {step})"


def plan(docs: DataFrame, schedules=SCHEDULES, share: float = 1.5, most: int = 2) -> DataFrame:
    """Per document: ``doc_id, source, size, draw, row, source_size, target`` and ``copies``.

    ``copies``: an array of ``(copy, taken, time)``, one entry for each copy (from 0) of which the mix takes a word.
    """
    sizes = sized(docs)
    targets = source_targets(sizes, schedules, share, most)
    dealt = dealt_by_range(sizes, ["source", *_ORDER], "stream")
    before = totals_before(dealt, ["source"], {"words_before": F.sum("size")})
    bases = before.alias("b").join(targets.alias("t"), _same("b", "t", ["source"])) \
        .select(f"b.{PART}", "b.source", "words_before", "source_size", "weight", "curve", "target")
    stream = Window.partitionBy(PART, "source").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, -1)
    running = dealt.withColumn("within", F.coalesce(F.sum("size").over(stream), F.lit(0).cast("long")))
    placed = running.alias("d").join(bases.alias("b"), _same("d", "b", [PART, "source"])).select(
        "d.doc_id", "d.source", "size", "draw", "row", "source_size", "target", "weight", "curve",
        (F.col("within") + F.col("words_before")).alias("start"))
    copies = F.expr(f"""filter(transform(sequence(0, {most - 1}), c -> struct(c AS copy,
        greatest(0L, least(size, CAST(floor(target) AS BIGINT) - start - c * source_size)) AS taken)), x -> x.taken > 0)""")
    timed = F.expr(f"""transform(copies, x -> struct(x.copy, x.taken,
        {_time('((start + x.copy * source_size + x.taken / 2D) / target)')} AS time))""")
    return placed.withColumn("copies", copies).withColumn("copies", timed).drop("weight", "curve", "start")


def training_order(planned: DataFrame) -> DataFrame:
    """A row per taken copy: ``at`` (its number in training, from 0), ``time, doc_id, source, copy, taken, row``."""
    each = planned.select("doc_id", "source", "draw", "row", F.inline("copies"))
    return numbered(each, ["time", "draw", "row", "copy"], "at").select("at", "time", "doc_id", "source", "copy", "taken", "row")


def mixed(docs: DataFrame, schedules=SCHEDULES, share: float = 1.5, most: int = 2) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, taken``, the time of its first copy and that copy's number ``at``."""
    planned = stored(plan(docs, schedules, share, most), "plan")
    firsts = training_order(planned).where("copy = 0").select("row", "time", "at")
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda n, x: n + x["taken"])
    return planned.join(firsts, "row", "left").select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), "time", "at")
