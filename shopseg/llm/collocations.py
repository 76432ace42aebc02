"""Phrase collocations: phrases of two to ``longest`` words that stand together more often than their parts apart.

Phrases are counted level by level, two words first:

1. **Blocks.** One pass over the texts cuts them into words and pieces and writes blocks of a few MB: word numbers in
   text order (0 ends a piece), the block's different words with a 64-bit hash, and their counts. Later passes read numbers only.
2. **Apriori.** A place is looked at for k words only if the k-1 words there and the k-1 words one further on are
   frequent: looked up in a bitmap of hashes of the frequent phrases, which knows all of them (a chance
   hit only adds a candidate).
3. **Buckets.** Hashes of the phrases at those places are counted in buckets; a bucket short of ``least`` holds no frequent phrase.
   What is left, as different tuples of words, are the candidates.
4. **Tries.** Candidates are split by hash into shards of bounded size, each made a double-array trie in a task. Tries
   are broadcast, at most ``ROUND`` candidates at a time (beyond that in further rounds). In each task numpy
   advances all places' states together and bincounts the accepting ones; Spark sums the tasks' counts.

Only bitmaps (at most ``MOST_BITS`` bits) and the tries of one round go through the driver. The word hash is exact: if two words
of a language share one, the blocks are written anew with another seed.

Null text is empty, null ``lang`` is ``und``. Any other column is ignored, whatever its name. A text longer than a block is cut at a
piece's end (a piece without any end stays whole in memory). Repeated rows count again. An empty table gives no phrase.
Ties in rank are broken by count and then by the phrase's bytes; equal cuts by the shorter first part.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopseg.llm import arrays, doublearray, shared, words

#: Bytes between words of a piece, and bytes that end a piece.
GAPS, ENDS = b" \t", b".,;:!?\n\x0b\x0c\r"
_END = re.compile(rb"[.,;:!?\n-\r]")
#: Bytes of text in a block, and bytes of text a task holds back for all languages together.
BLOCK, HELD = 1 << 20, 10 << 20
#: Row groups of the blocks' files: a reader holds one at a time.
ROW_GROUP = {"parquet.block.size": 8 << 20}
#: Candidates of one trie, and of all tries broadcast at once.
SHARD, ROUND = 250_000, 1_000_000
#: Bytes of texts, blocks, bitmap parts or counts handed to Python at a time.
BATCH = 1 << 20
#: Bits of a bitmap.
LEAST_BITS, MOST_BITS = 1 << 18, 1 << 29
#: Parts of a bitmap: a block has a row for each at most, whatever the bitmap's size.
CHUNKS = 256
#: Shuffle partitions that sum one chunk side by side, from twice as many on.
SUMMING = CHUNKS

BLOCKS = "lang string, numbers binary, words array<string>, hashes array<long>, counts array<long>"
BUCKETS = "chunk int, low binary, n binary"


# ---------------------------------------------------------------------------
# Blocks
# ---------------------------------------------------------------------------

def _blocks(docs: DataFrame, seed: int) -> DataFrame:
    kinds = words.byte_kinds(GAPS, ENDS)

    def cut(batches):
        for lang, texts in words.gathered(batches, lambda b: b["lang"].to_pylist(), BLOCK, HELD, _END):
            c = words.Cut(b"\n".join(texts), kinds)
            if not len(c.ids):
                continue
            hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in c.words.to_pylist()), np.uint64, len(c.words))
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang], pa.string()), "numbers": pa.array([c.with_ends().tobytes()], pa.binary()),
                "words": pa.ListArray.from_arrays([0, len(c.words)], c.words.view(pa.string())),
                "hashes": pa.ListArray.from_arrays([0, len(hashes)], pa.array(hashes.view(np.int64))),
                "counts": pa.ListArray.from_arrays([0, len(hashes)], pa.array(c.counts()))})

    own = docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    return shared.written(own.mapInArrow(cut, BLOCKS), "blocks", **ROW_GROUP)


def _words(blocks: DataFrame) -> DataFrame:
    """``lang, word, h, f`` of every word."""
    each = blocks.select("lang", F.explode(F.arrays_zip("words", "hashes", "counts")).alias("w"))
    return each.groupBy("lang", F.col("w.words").alias("word"), F.col("w.hashes").alias("h")).agg(F.sum("w.counts").alias("f"))


# ---------------------------------------------------------------------------
# Bitmaps
# ---------------------------------------------------------------------------

class Bits:
    """A bitmap over hashes: ``has(h)`` is true for every hash put in."""

    def __init__(self, size: int, data: np.ndarray):
        self.mask, self.data = np.uint64(size - 1), data

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h & self.mask
        return (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _size(entries: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << max(entries - 1, 1).bit_length()))


def _bucket_rows(h: np.ndarray, size: int, least: int):
    """Record batch of ``BUCKETS``: the buckets of the hashes ``h`` and how often each occurs (up to ``least``, which decides)."""
    buckets, counts = np.unique((h & np.uint64(size - 1)).astype(np.int64), return_counts=True)
    span = size // CHUNKS
    chunks = np.unique(buckets // span)
    bounds = np.searchsorted(buckets, np.append(chunks, chunks[-1:] + 1) * span).tolist() if len(chunks) else []
    low, counts = (buckets % span).astype("<u4"), np.minimum(counts, least).astype("<u4")
    spans = list(itertools.pairwise(bounds))
    return pa.RecordBatch.from_pydict({
        "chunk": pa.array(chunks, pa.int32()),
        "low": pa.array([zstandard.compress(np.diff(low[a:z], prepend=np.uint32(0)).tobytes(), 1) for a, z in spans], pa.binary()),
        "n": pa.array([zstandard.compress(counts[a:z].tobytes(), 1) for a, z in spans], pa.binary())})


def _summed_buckets(rows: DataFrame, size: int, by: list[str], done, column: str) -> DataFrame:
    """Rows of a chunk (and salt) stream sorted through one task, which keeps one array of counts; ``done`` makes its bytes."""
    def summed(batches):
        own, total = None, None

        def row():
            return pa.RecordBatch.from_pydict({"chunk": pa.array([own[0]], pa.int32()), column: pa.array([done(total)], pa.binary())})

        for b in batches:
            keys = list(zip(*[b[c].to_pylist() for c in by]))
            for key, low, n in zip(keys, b["low"].to_pylist(), b["n"].to_pylist()):
                if key != own:
                    if own is not None:
                        yield row()
                    own, total = key, np.zeros(size // CHUNKS, np.uint32)
                n = np.frombuffer(zstandard.decompress(n), "<u4")
                at = np.cumsum(np.frombuffer(zstandard.decompress(low), "<u4"), dtype=np.int64) if low is not None else slice(None)
                total[at] = np.minimum(total[at].astype(np.int64) + n, (1 << 32) - 1)
        if own is not None:
            yield row()

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *by).sortWithinPartitions(*by).mapInArrow(summed, f"chunk int, {column} binary")


def _bits(rows: DataFrame, size: int, least: int) -> Bits:
    """Bitmap of the buckets whose counts in ``rows`` (``BUCKETS``) sum to at least ``least``."""
    # many partitions sum a chunk side by side first
    salts = _salts(rows.sparkSession)
    if salts > 1:
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("low"), F.lit(salts)))
        rows = _summed_buckets(rows, size, ["chunk", "salt"], lambda t: zstandard.compress(t.tobytes(), 1), "n") \
            .select("chunk", F.lit(None).cast("binary").alias("low"), "n")
    packed = _summed_buckets(rows, size, ["chunk"], lambda t: np.packbits(t >= least, bitorder="little").tobytes(), "bits")
    data = np.zeros((CHUNKS, size // CHUNKS // 8), np.uint8)
    for r in packed.toArrow().to_pylist():  # size / 8 bytes in all
        data[r["chunk"]] = np.frombuffer(r["bits"], np.uint8)
    return Bits(size, data.reshape(-1))


# ---------------------------------------------------------------------------
# Places in a block
# ---------------------------------------------------------------------------

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _lang_hash(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 1))


def _first(lang: str, h: np.ndarray) -> np.ndarray:
    """Hash of one-word phrases of a language."""
    return arrays.mixed(h ^ _lang_hash(lang))


def _further(gram: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase and the word (by its one-word hash) after it."""
    with np.errstate(over="ignore"):
        return arrays.mixed(gram * _STEP + word)


def _places(lang: str, numbers: np.ndarray, hashes: np.ndarray, frequent: list[Bits]):
    """``(places, hash of the phrase there)`` for phrases of ``len(frequent) + 1`` words whose parts are all frequent."""
    own = np.concatenate([np.zeros(1, np.uint64), _first(lang, hashes)])
    good = frequent[0].has(own)
    good[0] = False
    places = np.flatnonzero(good[numbers])
    gram = own[numbers[places]]
    for k in range(1, len(frequent) + 1):
        if k > 1:
            on = frequent[k - 1].has(gram)
            places, gram = places[on], gram[on]
        flag = np.zeros(len(numbers) + 1, bool)  # the k words at a place are frequent
        flag[places] = True
        on = flag[places + 1]
        places, gram = places[on], gram[on]
        gram = _further(gram, own[numbers[places + k]])
    return places, gram


def _each_block(batches):
    for b in batches:
        for r in range(b.num_rows):
            hashes = b["hashes"][r].values.to_numpy(zero_copy_only=False).view(np.uint64)
            yield b["lang"][r].as_py(), np.frombuffer(b["numbers"][r].as_buffer(), "<i4"), hashes


def _different(numbers: np.ndarray, places: np.ndarray, k: int, n_words: int) -> np.ndarray:
    """One of the ``places`` for each different phrase of ``k`` words."""
    code = numbers[places].astype(np.int64)
    for j in range(1, k):
        if j > 1:
            code = np.unique(code, return_inverse=True)[1]
        code = code * (n_words + 1) + numbers[places + j]
    return places[np.unique(code, return_index=True)[1]]


# ---------------------------------------------------------------------------
# One level
# ---------------------------------------------------------------------------

def _candidates(blocks: DataFrame, k: int, frequent: list[Bits], least: int, size: int) -> tuple[DataFrame, Bits]:
    """Different phrases of ``k`` words that may be frequent (``lang, gram, w1 ..``), and the bitmap of their buckets."""
    sc = blocks.sparkSession.sparkContext
    known = sc.broadcast(frequent)
    numbers_only = blocks.select("lang", "numbers", "hashes")

    def buckets(batches):
        for lang, numbers, hashes in _each_block(batches):
            yield _bucket_rows(_places(lang, numbers, hashes, known.value)[1], size, least)

    filled = _bits(numbers_only.mapInArrow(buckets, BUCKETS), size, least)
    full = sc.broadcast(filled)
    names = [f"w{j + 1}" for j in range(k)]

    def different(batches):
        for lang, numbers, hashes in _each_block(batches):
            places, gram = _places(lang, numbers, hashes, known.value)
            on = full.value.has(gram)
            places, gram = places[on], gram[on]
            at = _different(numbers, places, k, len(hashes))
            gram = gram[np.searchsorted(places, at)]
            raw = hashes.view(np.int64)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(at), pa.string()), "gram": pa.array(gram.view(np.int64)),
                **{w: pa.array(raw[numbers[at + j] - 1]) for j, w in enumerate(names)}})

    schema = "lang string, gram long, " + ", ".join(f"{w} long" for w in names)
    out = shared.written(numbers_only.mapInArrow(different, schema).dropDuplicates(), f"candidates{k}")
    known.destroy()
    full.destroy()
    return out, filled


TRIES = "lang string, shard int, phrases long, symbols binary, paths binary, base binary, check binary, accept binary, width int"


def _tries(candidates: DataFrame, k: int, shards: int) -> DataFrame:
    """One double-array trie per language and shard of candidates."""
    names = [f"w{j + 1}" for j in range(k)]

    def built(group: pa.Table) -> pa.Table:
        own = np.stack([group[w].to_numpy() for w in names], 1).view(np.uint64)
        symbols, numbers = np.unique(own, return_inverse=True)
        paths = numbers.reshape(own.shape) + 1
        paths = paths[np.lexsort(paths.T[::-1])].astype("<i4")
        trie = doublearray.build(paths)
        arrays_ = {"symbols": symbols, "paths": paths} | {c: trie[c].astype("<i4") for c in ("base", "check", "accept")}
        return pa.table({"lang": group["lang"].slice(0, 1), "shard": group["shard"].slice(0, 1), "phrases": pa.array([len(paths)], pa.int64()),
                         **{c: pa.array([a.tobytes()], pa.binary()) for c, a in arrays_.items()},
                         "width": pa.array([trie["width"]], pa.int32())})

    dealt = candidates.withColumn("shard", F.pmod("gram", F.lit(shards)).cast("int"))
    return shared.written(dealt.groupBy("lang", "shard").applyInArrow(built, TRIES), f"tries{k}")


class _Trie:
    def __init__(self, r: dict, k: int):
        self.symbols = np.frombuffer(r["symbols"], np.uint64)
        self.paths = np.frombuffer(r["paths"], "<i4").reshape(-1, k)
        self.trie = {c: np.frombuffer(r[c], "<i4") for c in ("base", "check", "accept")} | {"width": r["width"], "words": k}

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The trie's number of each word hash, with 0 for words that no phrase of it has (and at index 0)."""
        at = np.minimum(np.searchsorted(self.symbols, hashes), len(self.symbols) - 1)
        return np.concatenate([np.zeros(1, np.int64), np.where(self.symbols[at] == hashes, at + 1, 0)])


COUNTED = "lang string, shard int, n binary"


def _counts_row(lang: str, shard: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"lang": pa.array([lang], pa.string()), "shard": pa.array([shard], pa.int32()),
                                       "n": pa.array([zstandard.compress(total.tobytes(), 1)], pa.binary())})


def _running(batches):
    """``(lang, shard, sum of the counts)`` of sorted ``COUNTED`` rows; one array is held."""
    own, total = None, None
    for b in batches:
        for lang, shard, n in zip(b["lang"].to_pylist(), b["shard"].to_pylist(), b["n"].to_pylist()):
            n = np.frombuffer(zstandard.decompress(n), np.int64)
            if (lang, shard) == own:
                total = total + n
                continue
            if own is not None:
                yield *own, total
            own, total = (lang, shard), n
    if own is not None:
        yield *own, total


def _dealt(counts: DataFrame) -> DataFrame:
    """``COUNTED`` rows (and ``salt``), those of a trie sorted in one partition, few of each: many are summed side by side first."""
    spark = counts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if _salts(spark) > 1:
        def summed(batches):
            for row in _running(batches):
                yield _counts_row(*row)

        counts = counts.repartition(parts, "lang", "shard", "salt").sortWithinPartitions("salt", "lang", "shard") \
            .drop("salt").mapInArrow(summed, COUNTED)
    return counts.repartition(parts, "lang", "shard").sortWithinPartitions("lang", "shard").select("lang", "shard", "n")


def _salts(spark) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // SUMMING)


def _counted(blocks: DataFrame, tries: list[dict], k: int, shards: int, frequent: list[Bits], filled: Bits, least: int) -> DataFrame:
    """``lang, w, f`` of the frequent phrases in ``tries`` (collected rows of one round): per-task counts, summed."""
    spark = blocks.sparkSession
    sent = spark.sparkContext.broadcast(({(r["lang"], r["shard"]): _Trie(r, k) for r in tries}, frequent, filled))
    langs = sorted({r["lang"] for r in tries})

    def count(batches):
        known, parts, full = sent.value
        totals: dict = {}
        for lang, numbers, hashes in _each_block(batches):
            places, gram = _places(lang, numbers, hashes, parts)
            on = full.has(gram)
            places, shard = places[on], np.mod(gram[on].view(np.int64), shards)
            for s in range(shards):
                trie = known.get((lang, s))
                if trie is None:
                    continue
                _, found = doublearray.walk(trie.trie, trie.numbers(hashes)[numbers], places[shard == s] if shards > 1 else places)
                total = totals.setdefault((lang, s), np.zeros(len(trie.paths) + 1, np.int64))
                total += np.bincount(found, minlength=len(total))
        for (lang, s), total in totals.items():
            yield _counts_row(lang, s, total)

    def found(batches):
        known = sent.value[0]
        for lang, s, total in _running(batches):
            trie, at = known[lang, s], np.flatnonzero(total >= least)
            raw = trie.symbols.view(np.int64)
            own = raw[trie.paths[at - 1].reshape(-1) - 1]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(at), pa.string()),
                "w": pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * k, pa.array(own)), "f": pa.array(total[at])})

    own = blocks.where(F.col("lang").isin(langs)).select("lang", "numbers", "hashes")
    counts = own.mapInArrow(count, COUNTED).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(_salts(spark))))
    out = shared.written(_dealt(counts).mapInArrow(found, "lang string, w array<long>, f long"), f"phrases{k}")
    sent.destroy()
    return out


def _level(blocks: DataFrame, k: int, frequent: list[Bits], least: int, size: int) -> DataFrame:
    """``lang, w, f`` of all phrases of ``k`` words with at least ``least`` occurrences."""
    spark = blocks.sparkSession
    candidates, filled = _candidates(blocks, k, frequent, least, size)
    shards = -(-candidates.count() // SHARD) or 1
    tries = _tries(candidates, k, shards)
    rounds, held = [[]], 0
    for r in tries.select("lang", "shard", "phrases").orderBy("shard", "lang").collect():  # a row per trie
        if held and held + r.phrases > ROUND:
            rounds.append([])
            held = 0
        rounds[-1].append((r.lang, r.shard))
        held += r.phrases
    out = None
    for own in rounds:
        keys = spark.createDataFrame(own, "lang string, shard int")
        part = _counted(blocks, tries.join(F.broadcast(keys), ["lang", "shard"]).toArrow().to_pylist(), k, shards, frequent, filled, least)
        out = part if out is None else out.unionByName(part)
    return out


def _bits_of(phrases: DataFrame) -> Bits:
    """Bitmap of the hashes of ``phrases`` (``lang, w, f``)."""
    size = _size(16 * phrases.count())

    def rows(batches):
        for b in batches:
            w = np.stack(b["w"].to_numpy(zero_copy_only=False)).view(np.uint64) if b.num_rows else np.zeros((0, 1), np.uint64)
            langs = np.array([_lang_hash(x) for x in b["lang"].to_pylist()], np.uint64)
            gram = arrays.mixed(w[:, 0] ^ langs)
            for j in range(1, w.shape[1]):
                gram = _further(gram, arrays.mixed(w[:, j] ^ langs))
            yield _bucket_rows(gram, size, 1)

    return _bits(phrases.select("lang", "w").mapInArrow(rows, BUCKETS), size, 1)


def frequent_phrases(docs: DataFrame, least: int = 30, longest: int = 4) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(phrases, words, totals)``.

    ``phrases``: ``lang, w`` (word hashes), ``f`` of every phrase of 1 to ``longest`` words with at least ``least``
    occurrences; ``words``: ``lang, h, word`` of the frequent words; ``totals``: ``lang, n`` word occurrences.
    """
    if least < 1 or longest < 1:
        raise ValueError("least and longest must be at least 1")
    with shared.arrow_bytes(docs.sparkSession, BATCH):
        return _frequent_phrases(docs, least, longest)


def _frequent_phrases(docs: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    for seed in itertools.count():
        blocks = _blocks(docs, seed)
        counted = shared.written(_words(blocks), "words")
        shared_hash = counted.groupBy("lang", "h").agg((F.min("word") != F.max("word")).alias("two")).where("two").limit(1).count()
        if not shared_hash:
            break
    totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    single = shared.written(counted.where(F.col("f") >= least).select("lang", "word", "h", "f"), "frequent-words")
    phrases = single.select("lang", F.array("h").alias("w"), "f")
    entries = sum(r.n for r in totals.collect())  # a row per language
    levels, frequent = [phrases], []
    for k in range(2, longest + 1):
        frequent.append(_bits_of(levels[-1]))
        levels.append(_level(blocks, k, frequent, least, _size(entries // 4)))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out, single.select("lang", "h", "word"), totals


# ---------------------------------------------------------------------------
# Scores
# ---------------------------------------------------------------------------

#: Score of a cut whose parts never stand apart (a = l = r).
FULL = 1_000_000


def _wide(c) -> str:
    return f"CAST({c} AS DECIMAL(20, 0))"


def scored(phrases: DataFrame, share: int = 80) -> DataFrame:
    """``lang, w, a, l, r, score`` of the phrases of two words on that stay.

    The cut with the lowest score counts (of equal ones the shortest first part). A phrase inside a longer one
    that has at least ``share`` percent of its occurrences is left out.
    """
    several = phrases.where(F.size("w") > 1).select("lang", "w", F.col("f").alias("a"))
    cuts = several.select("*", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    left = phrases.select("lang", F.col("w").alias("wl"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("w").alias("wr"), F.col("f").alias("r"))
    cuts = cuts.withColumns({"wl": F.expr("slice(w, 1, k)"), "wr": F.expr("slice(w, k + 1, size(w) - k)")}) \
        .join(left, ["lang", "wl"]).join(right, ["lang", "wr"])
    score = F.expr(f"({_wide('a')} * {2 * FULL}) div ({_wide('l')} + {_wide('r')})")
    best = cuts.groupBy("lang", "w", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    # phrases of two words on inside each longer one; the whole phrase itself is no such part
    inside = several.where(F.size("w") > 2).select("lang", F.col("a").alias("longer"), F.explode(F.expr(
        "filter(flatten(transform(sequence(2, size(w) - 1), n -> transform(sequence(1, size(w) - n + 1), i -> slice(w, i, n)))), x -> size(x) > 1)")).alias("w"))
    covers = inside.groupBy("lang", "w").agg(F.max("longer").alias("longer"))
    kept = best.join(covers, ["lang", "w"], "left") \
        .where(f"longer IS NULL OR 100 * {_wide('longer')} < {share} * {_wide('a')}")
    return kept.select("lang", "w", "a", "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, share: int = 80, top: int = 2000) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    phrases, spelled, totals = frequent_phrases(docs, least, longest)
    kept = shared.written(scored(phrases, share), "scored")
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    # with all that tie with the last one, whose order needs the words
    first = kept.withColumn("place", F.rank().over(by_score)).where(F.col("place") <= top)
    each = first.select("lang", "w", F.posexplode("w").alias("at", "h")).join(spelled, ["lang", "h"]) \
        .groupBy("lang", "w").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelled"))
    named = first.join(each, ["lang", "w"]).withColumn("phrase", F.array_join("spelled.word", " "))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return named.withColumn("rank", rank).where(F.col("rank") <= top).join(totals, "lang") \
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
