"""Benchmark decontamination with a distributed positional inverted index (DataFrame functions only).

A window is a run of ``width`` consecutive words of a benchmark item (the whole item if it is shorter).
Corpus counts of the benchmark's words, over all documents, name the two rarest positions of each window.
One pass over the documents then stores the postings (term, document, position) of those terms as a table;
postings of a rarest term carry the words around them. The rarest term's list, moved by its offset to the
window's start, is intersected with the second term's by document and adjusted position. The words around a
posting rule out most candidates before that join and decide the rest: the whole phrase is an exact match; the second term
within ``slack`` words of its place, with most of the window's words (``LIKE`` of them) around, is a proximity match.

Words: A-Z lowered, runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. Null or empty text has no words. A benchmark row
without words has no window; one with null ``item_id`` marks words as hit but is not counted or listed as an
item. Windows that several items hold are looked up once. Documents with null ``doc_id`` and rows that
repeat a ``doc_id`` are judged by their own text. Empty tables (either one) give a result without hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopseg.llm import shared

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Ends every document's words in the index, so that its position is their number. No word holds this character.
END = "\x00"
#: A benchmark-side table is broadcast up to so many rows; beyond, the join shuffles.
BROADCAST_ROWS = 200_000
#: Share of a window's different words that a proximity match has.
LIKE = 0.8


def words_of(text: str = "text"):
    lowered = shared.lower_ascii(F.coalesce(F.col(text).cast("string"), F.lit("")))
    return F.array_remove(F.split(lowered, BREAKS), "")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast hint for a table of a counted size."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def windows(benchmark: DataFrame, width: int) -> DataFrame:
    """``item_id, words``: each item's windows."""
    items = benchmark.select("item_id", words_of().alias("all")).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - width + 1, F.lit(1)))
    return items.select("item_id", "all", F.explode(starts).alias("at")) \
        .select("item_id", F.slice("all", F.col("at"), F.lit(width)).alias("words")).distinct()


def _rarest(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """``window, words, t1, o1, t2, o2``: terms and offsets of the two rarest positions (equal if there is one only)."""
    terms = phrases.select("window", "words", F.posexplode("words").alias("o", "term")) \
        .join(counts, "term", "left").fillna(0, ["n"])
    ranked = F.sort_array(F.collect_list(F.struct("n", "o", "term")))
    return terms.groupBy("window", "words").agg(ranked.alias("r")).select(
        "window", "words", F.col("r")[0]["term"].alias("t1"), F.col("r")[0]["o"].alias("o1"),
        F.coalesce(F.get("r", F.lit(1))["term"], F.col("r")[0]["term"]).alias("t2"),
        F.coalesce(F.get("r", F.lit(1))["o"], F.col("r")[0]["o"]).alias("o2"))


def phrase_matches(docs: DataFrame, benchmark: DataFrame, width: int = 10, slack: int = 3):
    """``(matches, lengths, members)``.

    ``matches``: ``__id, __h, window, start, length, kind`` (``exact`` or ``proximity``), ``lengths``: ``__id, __h,
    doc_id, n_words`` of every row of ``docs``, ``members``: ``window, item_id``.
    """
    pairs = windows(benchmark, width).withColumn("window", F.concat_ws(" ", "words"))
    pairs = shared.written(pairs, "windows")
    members = pairs.select("window", "item_id").where(F.col("item_id").isNotNull()).distinct()
    phrases = pairs.select("window", "words").distinct()

    tokens = shared.keyed(shared.texts(docs)).select("doc_id", "__id", "__h", words_of().alias("words"))
    terms = _small(phrases.select(F.explode("words").alias("term")).distinct())
    counts = shared.written(tokens.select(F.explode("words").alias("term")).join(terms, "term")
                            .groupBy("term").agg(F.count(F.lit(1)).alias("n")), "counts")
    plan = shared.written(_rarest(phrases, counts), "plan")

    # the index: postings of the windows' rarest terms, and each document's end
    first = plan.select(F.col("t1").alias("term"), F.lit(True).alias("around"))
    wanted = first.unionByName(plan.select(F.col("t2").alias("term"), F.lit(False).alias("around"))) \
        .groupBy("term").agg(F.max("around").alias("around"))
    end = docs.sparkSession.createDataFrame([(END, False)], "term string, around boolean")
    reach = width - 1 + slack
    postings = tokens.select("doc_id", "__id", "__h", "words",
                             F.posexplode(F.concat("words", F.array(F.lit(END)))).alias("pos", "term")) \
        .join(_small(wanted.unionByName(end)), "term") \
        .select("term", "doc_id", "__id", "__h", "pos", F.when(F.col("around"), F.expr(
            f"slice(words, greatest(pos - {reach}, 0) + 1, {2 * reach + 1})")).alias("near"))
    index = shared.written(postings, "postings")

    # candidates: the rarest term's list moved to the window's start; the words around rule most of them out
    lists = index.where(F.col("term") != END)
    first = f"greatest(pos - {reach}, 0)"  # where `near` begins

    def around(a, z):  # words a to z (exclusive) of the document, as far as `near` has them
        return f"slice(near, greatest({a} - {first}, 0) + 1, greatest({z} - greatest({a}, {first}), 0))"

    found = lists.join(_small(plan.withColumnRenamed("t1", "term")), "term") \
        .withColumn("start", F.col("pos") - F.col("o1")).where("start >= 0") \
        .where(F.expr(f"array_contains({around(f'start + o2 - {slack}', f'start + o2 + {slack + 1}')}, t2)")) \
        .withColumn("phrase", F.expr(f"{around('start', 'start + size(words)')} = words")) \
        .where(F.expr(f"phrase OR size(array_intersect(words, {around(f'start - {slack}', f'start + size(words) + {slack}')})) "
                      f">= {LIKE} * size(array_distinct(words))")) \
        .select("__id", "__h", "window", "start", F.size("words").alias("length"), "phrase", "t2", "o2").distinct()
    # intersection with the second term's list, at its own offset or up to `slack` words off
    probes = found.withColumn("off", F.explode(F.sequence(F.lit(-slack), F.lit(slack)))) \
        .select("*", F.col("t2").alias("term"), F.expr("start + o2 + off").alias("pos"))
    met = probes.join(lists.select("term", "__id", "__h", "pos"), ["term", "__id", "__h", "pos"]) \
        .groupBy("__id", "__h", "window", "start", "length").agg(F.max(F.col("phrase") & (F.col("off") == 0)).alias("exact"))
    matches = met.select("__id", "__h", "window", F.col("start").cast("long"), F.col("length").cast("long"),
                         F.when(F.col("exact"), "exact").otherwise("proximity").alias("kind"))
    lengths = index.where(F.col("term") == END).select("__id", "__h", "doc_id", F.col("pos").cast("long").alias("n_words"))
    return matches, lengths, members


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, slack: int = 3) -> DataFrame:
    """Per row of ``docs``: ``__id, __h, doc_id, n_words, n_hit, item_ids`` (sorted strings) and ``n_near`` (windows
    with a proximity match only)."""
    matches, lengths, members = phrase_matches(docs, benchmark, width, slack)
    matches = shared.written(matches, "matches")
    exact = matches.where("kind = 'exact'")
    # the length of a union of intervals: each adds what lies beyond the furthest end before it
    spans = exact.groupBy("__id", "__h", "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    before = Window.partitionBy("__id", "__h").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    hits = spans.withColumn("reached", F.coalesce(F.max("end").over(before), F.lit(0).cast("long"))) \
        .groupBy("__id", "__h").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "reached"))).alias("n_hit"))
    items = exact.select("__id", "__h", "window").distinct().join(_small(members), "window") \
        .select("__id", "__h", F.col("item_id").cast("string").alias("item")).distinct() \
        .groupBy("__id", "__h").agg(F.sort_array(F.collect_list("item")).alias("item_ids"))
    near = matches.groupBy("__id", "__h", "window").agg(F.max(F.col("kind") == "exact").alias("exact")) \
        .where("not exact").groupBy("__id", "__h").agg(F.count(F.lit(1)).alias("n_near"))
    key = ["__id", "__h"]
    return lengths.join(hits.join(items, key, "left").join(near, key, "full"), key, "left").select(
        *key, "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"))


def clean(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """``docs`` without the documents that hold any window."""
    matches, _, _ = phrase_matches(docs, benchmark, width, slack=0)
    key = shared.spare(docs, "__id", "__h")
    bad = matches.where("kind = 'exact'").select("__id", "__h").distinct().toDF(*key)
    return shared.keyed(docs, *key).join(_small(shared.written(bad, "contaminated")), key, "left_anti").select(*docs.columns)
