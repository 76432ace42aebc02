import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shopseg.llm import packing, shared, token_ids, tokens
from .helpers import ODD, SCHEMA, corpus, table


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(tokens.default_tokenizer())


def ids(whole, text):
    return whole.encode(text or "", add_special_tokens=False).ids


def crc(a):
    return zlib.crc32(np.array(a, "<u4").tobytes())


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(" \n\t\r\x0b\x1c\xa0 ab'sZéß²½,.;!?-_<|>12日") | st.characters(codec="utf-8"), max_size=60))
def test_pieces_give_the_ids_of_the_whole_text(text):
    e = tokens.encoder(tokens.default_tokenizer())
    assert np.frombuffer(e.encode(text), "<u4").tolist() == ids(e.whole, text)


def test_long_text_is_cut_at_boundaries_only(whole, monkeypatch):
    monkeypatch.setattr(tokens, "SPAN", 100)
    e = tokens.Encoder(tokens.default_tokenizer())
    for text in ("Some words, and more.  " * 40 + "\n\n x" * 30, "a" * 1000, " " * 1000, "ab " * 500):
        assert np.frombuffer(e.encode(text), "<u4").tolist() == ids(whole, text)


@pytest.mark.parametrize("source", ["odd", "corpus"])
def test_token_id_files(spark, whole, source):
    docs = table(spark, ODD) if source == "odd" else corpus(spark)
    path = shared.shared_path(spark, "ids")
    token_ids.write_token_ids(docs, path)
    got = [tuple(r) for r in token_ids.read_token_ids(spark, path).orderBy("doc_id").collect()]
    want, start = [], 0
    for r in docs.orderBy("doc_id").collect():
        a = ids(whole, r.text) + [2]
        want.append((r.doc_id, start, len(a), crc(a)))
        start += len(a)
    assert got == want
    text = docs.where("doc_id = 9").first().text
    assert [a.tolist() for a in token_ids.read_document(spark, path, 9)] == [ids(whole, text) + [2]]
    assert token_ids.read_document(spark, path, 10**9) == []


def test_token_ids_of_empty_and_repeated(spark, whole):
    path = shared.shared_path(spark, "ids")
    token_ids.write_token_ids(spark.createDataFrame([], SCHEMA), path)
    assert token_ids.read_token_ids(spark, path).collect() == []
    path = shared.shared_path(spark, "ids")
    rows = [(1, "x y", None, None, None)] * 3 + [(1, "other", None, None, None), (None, "no id", None, None, None)]
    token_ids.write_token_ids(spark.createDataFrame(rows, SCHEMA), path)
    got = sorted(token_ids.read_token_ids(spark, path).collect(), key=lambda r: r.start)
    assert got[0].doc_id is None and [r.doc_id for r in got[1:]] == [1] * 4
    assert sorted(r.ids_crc32 for r in got[1:]) == sorted([crc(ids(whole, "x y") + [2])] * 3 + [crc(ids(whole, "other") + [2])])
    ends = np.cumsum([0, *(r.n_tokens for r in got)])
    assert [r.start for r in got] == ends[:-1].tolist()
    assert len(token_ids.read_document(spark, path, 1)) == 4


def test_another_dictionary_is_noticed(spark):
    path = shared.shared_path(spark, "ids")
    token_ids.write_token_ids(table(spark, ["a b c"]), path)
    spark.createDataFrame([("0" * 64, bytearray(b"x"), 2)], "dict_sha256 string, dictionary binary, id_bytes int") \
        .write.mode("overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(ValueError, match="hash"):
        token_ids.read_token_ids(spark, path)


def fills(rows, capacity):
    """Sequences as lists of (offset, length), checked to be gapless and within the capacity."""
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return seqs


def best_fit_item_by_item(lengths, capacity):
    """The same rule for one item at a time, in plain Python: the number of sequences."""
    large, small = sorted((x for x in lengths if 3 * x > capacity), reverse=True), sorted(x for x in lengths if 3 * x <= capacity)
    gaps = []
    while large:
        a = large.pop(0)
        mate = next((b for b in large if a + b <= capacity), 0)
        if mate:
            large.remove(mate)
        gaps.append(capacity - a - mate)
    for x in reversed(small):
        fits = [g for g in gaps if g >= x]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else capacity) - x)
    return sorted(gaps)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=200))
def test_histogram_packing_is_best_fit_item_by_item(lengths):
    counts = {x: lengths.count(x) for x in lengths}
    runs = packing.pack_histogram(counts, 60)
    seqs = defaultdict(int)
    placed = defaultdict(list)
    for length, r0, r1, seq0, k, offset in runs:
        placed[length] += range(r0, r1)
        for r in range(r0, r1):
            seqs[seq0 + (r - r0) // k] += length
    assert {k: sorted(v) for k, v in placed.items()} == {k: list(range(n)) for k, n in counts.items()}
    assert sorted(60 - x for x in seqs.values()) == best_fit_item_by_item(lengths, 60)


def test_runs_are_bounded_by_the_capacity_not_by_the_items():
    rng = np.random.default_rng(1)
    few = np.bincount(rng.integers(1, 2049, 30_000), minlength=2049)
    runs = [len(packing.pack_histogram({i: int(n) * f for i, n in enumerate(few) if n}, 2048)) for f in (1, 1000)]
    assert max(runs) < 6 * 2048


@pytest.mark.parametrize("source", ["odd", "corpus"])
def test_pack_documents(spark, whole, source, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 50)  # several salts
    docs = table(spark, ODD) if source == "odd" else corpus(spark)
    capacity = 64 if source == "odd" else 512
    rows = packing.pack_documents(docs, capacity).collect()
    want = []
    for r in docs.collect():
        a = ids(whole, r.text) + [0]
        first = len(a) % capacity or capacity
        cuts = [0, *range(first, len(a) + 1, capacity)] if len(a) > capacity else [0, len(a)]
        want += [(r.doc_id, k, x, y - x, crc(a[x:y])) for k, (x, y) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(tuple(r)[:5] for r in rows) == sorted(want)
    seqs = fills(rows, capacity)
    assert sorted(capacity - sum(n for _, n in s) for s in seqs.values()) == best_fit_item_by_item([w[3] for w in want], capacity)


def test_pack_empty_and_repeated(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = packing.pack_documents(spark.createDataFrame([(5, "a b", None, None, None)] * 7 + [(None, None, None, None, None)], SCHEMA)).collect()
    assert len(rows) == 8 and len(fills(rows, 2048)) == 1
