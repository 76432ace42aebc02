"""Information-theoretic sanitisation of personal data (DataFrame functions only).

Base spans are e-mail addresses, IPv4 addresses, card numbers and phone numbers found by pattern and check. They are
the protected entities. What else gives an entity away is estimated from the whole corpus: a term (run of letters, marks and
digits of any length, outside the base spans) discloses an entity of the same text as far as their pointwise mutual
information ``log2(p(entity | term) * N / n(entity))`` comes near the entity's own information ``log2(N / n(entity))``.
All counts are over different whole texts (copies say nothing new): ``N`` of the corpus, ``n(term)``, ``n(entity)``,
``n(term, entity)``, and pooled by the entity's kind ``n(kind)`` and ``n(term, kind)``. ``p(entity | term)`` is smoothed, so that
entities and terms of one or two texts are judged as well: the texts of a term count together with ``PRIOR`` more that follow
the kind, ``p(kind | term) * n(entity) / n(kind)``, where ``p(kind | term)`` is smoothed by ``n(kind) / N`` the same way. From
a share ``GENERALISE`` of the entity's information on a term is generalised to ``[TERM]``, from ``REMOVE`` on it is removed.
Its spans are all its places in the texts that hold the entity; they are added to the base spans, which stay. A term
stays in texts without the entity.

Spans are ``kind, start, end`` in code points, end exclusive. Null or empty text has none. Rows with null or repeated
``doc_id`` are handled by their own text; equal texts have equal spans. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopseg.llm import shared

#: Kinds in the order of the result, each with its pattern. Possessive loops end as the greedy ones would here (nothing
#: after them can match what they took) and need no stack; the e-mail pattern starts at the first character it can.
EMAIL, IP, CARD, PHONE = "email", "ip", "card", "phone"
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    EMAIL: rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    IP: r"[0-9]++(?:\.[0-9]++){3}",
    CARD: r"[0-9](?:[\x20-]?[0-9])++",
    PHONE: r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap pattern that any text with a match of the kind satisfies.
HINTS = {EMAIL: "@", IP: r"[0-9]\.[0-9]++\.[0-9]", CARD: r"[0-9](?:[\x20-]?[0-9]){15}", PHONE: r"\+[0-9]"}
TERM = "term"
KINDS = [EMAIL, IP, CARD, PHONE, TERM]
GENERALISE, REMOVE = 0.8, 0.95
#: Texts that the estimate by kind counts for beside the texts of a term.
PRIOR = 2.5
#: Hashes of copied texts are broadcast up to so many; beyond, the join shuffles.
BROADCAST_ROWS = 200_000


def _sql(s: str) -> str:
    return "r'" + s + "'"


def _valid() -> str:
    """SQL condition on a match ``m`` of kind number ``kind``."""
    digits = "regexp_replace(m, '[^0-9]', '')"
    octets = ("forall(split(m, '[.]'), p -> length(trim(LEADING '0' FROM p)) <= 3 AND cast(right(p, 3) AS int) <= 255)")
    # digits from the right; every second one doubled, less 9 beyond 9
    luhn = (f"aggregate(transform(regexp_extract_all(reverse({digits}), '[0-9]', 0), (c, i) -> CASE WHEN i % 2 = 0 THEN cast(c AS int) "
            "WHEN c > '4' THEN cast(c AS int) * 2 - 9 ELSE cast(c AS int) * 2 END), 0, (a, x) -> a + x) % 10 = 0")
    return (f"CASE kind WHEN 0 THEN true WHEN 1 THEN {octets} "
            f"WHEN 2 THEN CASE WHEN length({digits}) BETWEEN 16 AND 19 THEN {luhn} ELSE false END "
            f"ELSE length({digits}) BETWEEN 8 AND 15 END")


def _hint(kind: str) -> str:
    """SQL condition that any text with a match of the kind satisfies."""
    if kind == EMAIL:
        return "contains(text, '@')"
    return ("contains(text, '+') AND " if kind == PHONE else "") + f"text RLIKE {_sql(HINTS[kind])}"


def _matches(docs: DataFrame) -> DataFrame:
    """``rid, doc_id, h, kind, idx, gap, m``: a row per pattern match, or one of nulls per text without any.

    ``gap``: code points between the match before it and this one. The texts are read once, here; ``rid`` is unique.
    """
    found = shared.texts(docs).withColumns({"rid": F.monotonically_increasing_id(), "h": F.xxhash64("text")})
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        hint = _hint(kind)
        found = found.withColumns({
            f"m{k}": F.expr(f"CASE WHEN {hint} THEN regexp_extract_all(text, {_sql(pattern)}, 0) END"),
            f"g{k}": F.expr(f"CASE WHEN {hint} THEN split(text, {_sql(pattern)}, -1) END")})
    one = "struct({k} AS kind, i AS idx, char_length(z.g{k}) AS gap, z.m{k} AS m)"
    kinds = ", ".join(f"coalesce(transform(filter(arrays_zip(m{k}, g{k}), z -> z.m{k} IS NOT NULL), "
                      f"(z, i) -> {one.format(k=k)}), array())" for k in range(4))
    return shared.written(found.select("rid", "doc_id", "h", F.expr(f"inline_outer(concat({kinds}))")), "matches")


def _words(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``h, term, start, end``: the words outside base spans, once for each different text with an entity."""
    word = r"r'[\p{L}\p{M}\p{N}]+'"
    own = shared.texts(docs).where(" OR ".join(f"({_hint(k)})" for k in PATTERNS)).select(F.xxhash64("text").alias("h"), "text") \
        .join(spans.select("h").distinct(), "h", "left_semi").dropDuplicates(["h"])
    pairs = own.select("h", F.posexplode(F.expr(f"arrays_zip(regexp_extract_all(text, {word}, 0), split(text, {word}, -1))")).alias("i", "z")) \
        .select("h", "i", F.col("z.0").alias("word"), F.char_length("z.1").alias("gap")).where("word IS NOT NULL")
    placed = pairs.withColumn("end", F.sum(F.col("gap") + F.char_length("word")).over(Window.partitionBy("h").orderBy("i"))) \
        .select("h", F.lower("word").alias("term"), (F.col("end") - F.char_length("word")).alias("start"), "end")
    both = placed.unionByName(spans.select("h", F.lit(None).cast("string").alias("term"), "start", "end").distinct())
    base = F.col("term").isNull()
    before = Window.partitionBy("h").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy("h").orderBy("start").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    both = both.withColumns({"reached": F.max(F.when(base, F.col("end"))).over(before), "next": F.min(F.when(base, F.col("start"))).over(after)})
    return both.where(F.expr("term IS NOT NULL AND coalesce(reached <= start, true) AND coalesce(next >= end, true)")) \
        .select("h", "term", "start", "end")


def _text_counts(docs: DataFrame, matches: DataFrame) -> DataFrame:
    """``term, n_term``: the number of different texts that hold each word of the corpus.

    Rows of a text that no other row has are counted where they are read; only texts with copies are shuffled.
    """
    copied = shared.written(matches.select("rid", "h").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "copied")
    if copied.count() <= BROADCAST_ROWS:
        copied = F.broadcast(copied)
    every = shared.texts(docs).where("text IS NOT NULL").select(F.xxhash64("text").alias("h"), "text")

    def words(df):
        return df.select(F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{M}\p{N}]+"))).alias("term"))

    once = words(every.join(copied, "h", "left_anti")).unionByName(words(every.join(copied, "h", "left_semi").dropDuplicates(["h"])))
    return once.where("term <> ''").groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))


def disclosing(docs: DataFrame, matches: DataFrame, spans: DataFrame, words: DataFrame) -> DataFrame:
    """``h, term, removed``: the terms of each text that give an entity of it away, and whether they are removed or generalised."""
    n = matches.select("h").distinct().count()
    held = spans.select("h", "kind", F.col("m").alias("value")).distinct()
    # entities of a kind in the very same texts have the same counts: one class stands for them
    group = ["kind", "n_entity", "a", "b"]
    counts = held.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n_entity"), F.bit_xor("h").alias("a"),
                                               F.bit_xor(F.xxhash64("h")).alias("b"))
    classes = shared.written(held.join(counts, ["kind", "value"]).select("h", *group).distinct(), "classes")
    kinds = classes.groupBy("h", "kind").agg(F.max("n_entity").alias("most"))
    pooled = F.broadcast(kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("n_kind"), F.max("most").alias("most_of_kind")))  # four rows

    def possible(most):  # no share of GENERALISE is reached beyond, whatever the other counts are
        return F.expr(f"(least({most}, n_term) + {PRIOR}D) / (n_term + {PRIOR}D) >= pow({most} / {float(n)}D, {1 - GENERALISE}D) - 1e-9D")

    terms = words.select("h", "term").distinct().join(kinds, "h")
    told = terms.groupBy("term", "kind").agg(F.count(F.lit(1)).alias("n_both_kind")).join(_text_counts(docs, matches), "term", "left") \
        .withColumn("n_term", F.greatest(F.coalesce("n_term", F.lit(0)), "n_both_kind")).join(pooled, "kind").where(possible("most_of_kind"))
    pairs = shared.written(terms.join(told, ["term", "kind"]).where(possible("most")).drop("most", "most_of_kind")
                           .join(classes, ["h", "kind"]).where(possible("n_entity")), "pairs")
    own = F.expr(f"n_entity / {float(n)}D")
    of_kind = F.expr(f"(n_both_kind + {PRIOR}D * n_kind / {float(n)}D) / (n_term + {PRIOR}D)")
    p = (F.col("n_both") + PRIOR * of_kind * F.col("n_entity") / F.col("n_kind")) / (F.col("n_term") + PRIOR)
    share = F.log2(p / own) / -F.log2(own)
    judged = pairs.groupBy(*group, "term", "n_term", "n_both_kind", "n_kind").agg(F.count(F.lit(1)).alias("n_both")) \
        .where(own < 1).withColumn("share", share).where(F.col("share") >= GENERALISE)
    return pairs.select("h", *group, "term").join(judged.select(*group, "term", "share"), [*group, "term"]) \
        .groupBy("h", "term").agg((F.max("share") >= REMOVE).alias("removed"))


def find_spans(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``rid, doc_id, h, spans``, an array of ``struct(kind, start, end, removed)`` in order.

    ``kind`` is a number in ``KINDS``; ``removed`` tells disclosing terms that are removed from generalised ones.
    """
    matches = _matches(docs)
    each = Window.partitionBy("rid", "kind").orderBy("idx")
    placed = matches.where("m IS NOT NULL").withColumn("end", F.sum(F.col("gap") + F.char_length("m")).over(each)) \
        .withColumn("start", F.col("end") - F.char_length("m")).where(F.expr(_valid()))
    spans = shared.written(placed.select("rid", "h", "kind", "start", "end", "m"), "spans")
    words = shared.written(_words(docs, spans), "words")
    span = "struct<kind:int,start:bigint,end:bigint,removed:boolean>"
    added = words.join(disclosing(docs, matches, spans, words), ["h", "term"]).groupBy("h").agg(F.collect_list(
        F.struct(F.lit(KINDS.index(TERM)).alias("kind"), "start", "end", "removed").cast(span)).alias("added"))
    every = matches.select("rid", "doc_id", "h", F.lit(None).cast(span).alias("span")).distinct().unionByName(
        spans.select("rid", F.lit(None).cast("long").alias("doc_id"), "h",
                     F.struct("kind", "start", "end", F.lit(False).alias("removed")).cast(span).alias("span")))
    return every.groupBy("rid").agg(F.max("doc_id").alias("doc_id"), F.max("h").alias("h"), F.collect_list("span").alias("spans")) \
        .join(added, "h", "left") \
        .select("rid", "doc_id", "h", F.sort_array(F.when(F.col("added").isNull(), F.col("spans")).otherwise(F.concat("spans", "added"))).alias("spans"))


def listed(spans: str, where: str = "true"):
    """``kind:start:end`` of the spans, comma-joined."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform(filter({spans}, s -> {where}), s -> concat({names}[s.kind], ':', s.start, ':', s.end)), ',')")


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` rid of all spans: ``[EMAIL]`` and so on for entities, ``[TERM]`` for a generalised term and
    nothing for a removed one. Overlapping spans become one, named by the first."""
    own_id, own_hash, found = shared.spare(docs, "__id", "__h", "__spans")
    spans = find_spans(docs).where("size(spans) > 0").select(F.coalesce("doc_id", F.lit(0).cast("long")).alias(own_id),
                                                          F.col("h").alias(own_hash), F.col("spans").alias(found)) \
        .dropDuplicates([own_id, own_hash])
    keyed = docs.withColumns({own_id: F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")),
                              own_hash: F.xxhash64(F.col("text").cast("string"))})
    labels = "array(" + ", ".join(f"'[{k.upper()}]'" for k in KINDS) + ")"
    order = "array_sort(transform(" + found + ", s -> struct(s.start AS start, s.end AS end, CASE WHEN s.removed THEN '' ELSE {}[s.kind] END AS label)))"
    fold = ("aggregate({}, named_struct('at', 0L, 'out', ''), (a, s) -> CASE WHEN s.start < a.at THEN named_struct('at', greatest(a.at, s.end), 'out', a.out) "
            "ELSE named_struct('at', s.end, 'out', concat(a.out, substring(text, cast(a.at AS int) + 1, cast(s.start - a.at AS int)), s.label)) END, "
            "a -> concat(a.out, substring(text, cast(a.at AS int) + 1)))").format(order.format(labels))
    joined = keyed.join(spans, [own_id, own_hash], "left")
    text = F.when(F.col(found).isNull(), F.col("text")).otherwise(F.expr(fold))
    return joined.withColumn("text", text).select(*docs.columns)
