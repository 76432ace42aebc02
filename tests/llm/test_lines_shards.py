import hashlib
import zlib

from shopseg.llm import catalog, linededup, sharding
from .helpers import ODD, SCHEMA, corpus, table


def kept_lines(rows, least=10):
    """Brute force: (doc_id, n_lines, n_dropped, kept text) of (doc_id, text) rows."""
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < least or i == min(holders[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def check_lines(spark, docs):
    got = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs))
    assert got.columns[:len(docs.columns)] == docs.columns
    got = sorted(((r.doc_id, r["__n_lines"], r["__n_dropped"], r["__kept"]) for r in got.collect()), key=str)
    assert got == sorted(kept_lines([(r.doc_id, r.text) for r in docs.collect()]), key=str)


def test_line_dedup_odd(spark):
    long = "\n".join(f"line number {i % 90} of them" for i in range(300))
    check_lines(spark, table(spark, [*ODD, long, long + "\nlast one stays", *ODD, "É LINE WITH CAPITALS", "é line with capitals"]))


def test_line_dedup_corpus(spark):
    check_lines(spark, corpus(spark))


def test_line_dedup_null_ids_and_repeats(spark):
    rows = [(None, "a line that is shared"), (2, "a line that is shared"), (2, "a line that is shared"),
            (2, "a line that is shared\nmore of doc two"), (1, "a line that is shared"), (None, None), (3, "more of doc two\nx")]
    check_lines(spark, spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA))


def test_line_dedup_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs)).collect() == []


def shards_hold(rows, n):
    """Shards are contiguous, slots gapless, and bytes within one document of equal."""
    rows = sorted(rows, key=lambda r: r.start_byte)
    assert [r.start_byte for r in rows] == [sum(x.size for x in rows[:i]) for i in range(len(rows))]
    assert [r.shard for r in rows] == sorted(r.shard for r in rows)
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    total, most = sum(r.size for r in rows), max(r.size for r in rows)
    for k in range(n):
        own = [r for r in rows if r.shard == k]
        assert [r.slot for r in own] == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / n) <= most + 1


def test_shards(spark):
    for docs in (table(spark, ODD), corpus(spark)):
        rows = sharding.shard_by_bytes(docs, 4).collect()
        shards_hold(rows, 4)
        want = sorted((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
        assert sorted((r.doc_id, r["size"], r.text_crc32) for r in rows) == want


def test_shards_null_repeated_empty(spark):
    rows = [(None, "a")] * 3 + [(1, "b")] * 5 + [(1, None), (0, "ccc")]
    shards_hold(sharding.shard_by_bytes(spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA), 3).collect(), 3)
    assert sharding.shard_by_bytes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_queries(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in corpus(spark).collect()}
    got = catalog.op10_line_dedup(spark, sf).collect()
    want = {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in kept_lines(list(docs.items()))}
    assert {r.doc_id: tuple(r)[1:] for r in got} == want
    got = catalog.op6_sharding(spark, sf).collect()
    assert len(got) == len(docs) and {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
