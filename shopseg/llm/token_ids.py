"""Token-ID files: every document's ids as a zstandard frame of its own, with one shared dictionary.

Format (a folder; Parquet as the container, so Spark commits it as a whole and any store will do):

* ``dictionary``: one row - ``dict_sha256``, ``dictionary`` (trained on a bounded sample of serialized id
  arrays), ``id_bytes`` (2 or 4: width of a serialized id, little-endian unsigned).
* ``blocks``: a row per run of consecutive documents in ascending ``doc_id`` order - ``part``, ``block``
  (order), ``dict_sha256``, ``first_doc``, ``last_doc`` (not null), ``start`` (ids of the part before it), ``n_ids``,
  the offset index ``doc_ids``, ``n_tokens``, ``ends`` (end of each document's frame in the payload),
  and ``payload``. The index columns are read without the payload; ``first_doc`` / ``last_doc`` let a
  reader skip all other blocks, so one short document costs one block and one small frame.
* ``parts``: ids before each part - ``part``, ``part_start``.

Null text is an empty document (its end id alone). Null ``doc_id`` sorts first and stays null. Rows with
the same ``doc_id`` are documents of their own, ordered by a hash of the text. An empty table gives empty
files. Extra columns are ignored. A text of any length is one document.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopseg.llm import shared, tokens

#: Bound of the dictionary's training sample: documents (expected number) and ids of each.
SAMPLE_DOCS, SAMPLE_IDS = 2_000, 8_192
DICTIONARY_BYTES = 64 << 10
#: A block is closed at so many payload bytes or documents.
BLOCK_BYTES, BLOCK_DOCS = 1 << 20, 4_096

BLOCKS = ("part int, block int, dict_sha256 string, first_doc long, last_doc long, start long, n_ids long, "
          "doc_ids array<long>, n_tokens array<long>, ends array<long>, payload binary")
READ = "doc_id long, part int, start long, n_tokens long, ids_crc32 long"


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, width: int) -> bytes:
    """Dictionary bytes from a bounded, hash-chosen sample (empty if the sample holds nothing).

    Of a long document the sample holds ``SAMPLE_IDS`` ids from a place drawn by the text's checksum.
    """
    n = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(n, 1))
    drawn = docs.withColumn("draw", F.xxhash64("doc_id", "text")) \
        .where(F.pmod("draw", F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    sample = drawn.dropDuplicates(["draw"]).select("text")  # rows that repeat a document count once

    def serialized(batches):
        enc = tokens.encoder(tokenizer)
        for b in batches:
            texts = _bytes(b["text"])
            out = []
            for t, ids in zip(texts, enc.encode_all(texts)):
                at = zlib.crc32(t) % max(len(ids) + 2 - SAMPLE_IDS, 1)
                out.append(_serialize(ids, end_id, width)[at * width:(at + SAMPLE_IDS) * width])
            yield pa.RecordBatch.from_pydict({"ids": pa.array(out, pa.binary())})

    samples = [bytes(r.ids) for r in sample.mapInArrow(serialized, "ids binary").collect()]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few or too small samples to train on: their content is the dictionary
        return b"".join(samples)[:DICTIONARY_BYTES]


def _bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def _serialize(ids: np.ndarray, end_id: int, width: int) -> bytes:
    return ids.astype("<u2" if width == 2 else "<u4").tobytes() + end_id.to_bytes(width, "little")


def _dictionary(data: bytes):
    return zstandard.ZstdCompressionDict(data) if data else None


def write_token_ids(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2) -> None:
    """Encode every whole text and write the files described above to ``path``."""
    spark = docs.sparkSession
    tokenizer = tokenizer or tokens.default_tokenizer()
    docs = shared.texts(docs)
    width = 2 if max(tokens.encoder(tokenizer).whole.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    dictionary = train_dictionary(docs, tokenizer, end_id, width)
    sha = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(sha, bytearray(dictionary), width)], "dict_sha256 string, dictionary binary, id_bytes int") \
        .coalesce(1).write.parquet(f"{path}/dictionary")

    def blocks(batches):
        enc, part = tokens.encoder(tokenizer), TaskContext.get().partitionId()
        squeeze = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(dictionary))
        block, start, n_ids, size = 0, 0, 0, 0
        ids, counts, ends, frames = [], [], [], []

        def closed():
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()), "dict_sha256": [sha],
                "first_doc": pa.array([next((i for i in ids if i is not None), None)], pa.int64()),
                "last_doc": pa.array([ids[-1]], pa.int64()),
                "start": pa.array([start], pa.int64()), "n_ids": pa.array([n_ids], pa.int64()),
                "doc_ids": pa.array([ids], pa.list_(pa.int64())), "n_tokens": pa.array([counts], pa.list_(pa.int64())),
                "ends": pa.array([ends], pa.list_(pa.int64())), "payload": pa.array([b"".join(frames)], pa.binary())})

        for b in batches:
            for i, encoded in zip(b["doc_id"].to_pylist(), enc.encode_all(_bytes(b["text"]))):
                raw = _serialize(encoded, end_id, width)
                frame = squeeze.compress(raw)
                size += len(frame)
                ids.append(i)
                counts.append(len(raw) // width)
                ends.append(size)
                frames.append(frame)
                n_ids += counts[-1]
                if size >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                    yield closed()
                    block, start, n_ids, size = block + 1, start + n_ids, 0, 0
                    ids, counts, ends, frames = [], [], [], []
        if ids:
            yield closed()

    # the second and third key only matter where rows share a doc_id: such a run can then be cut, too
    dealt = docs.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(_partitions(spark), "doc_id", "tie", "row") \
        .sortWithinPartitions("doc_id", "tie", "row").select("doc_id", "text")
    dealt.mapInArrow(blocks, BLOCKS).write.option("compression", "uncompressed").parquet(f"{path}/blocks")

    # one row per part: as many as the shuffle has partitions, whatever the input
    parts = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("part_start")) \
        .write.parquet(f"{path}/parts")


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _frames(dictionary: bytes):
    """Decompressor of single frames (one object per use; it is not shared between threads)."""
    return zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))


def _header(spark: SparkSession, path: str) -> tuple[str, bytes, int]:
    r = spark.read.parquet(f"{path}/dictionary").first()
    data = bytes(r.dictionary)
    if hashlib.sha256(data).hexdigest() != r.dict_sha256:
        raise ValueError(f"dictionary in {path} does not match its hash")
    return r.dict_sha256, data, r.id_bytes


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32`` (ids as unsigned 32-bit)."""
    sha, dictionary, width = _header(spark, path)

    def rows(batches):
        unpack = _frames(dictionary)
        for b in batches:
            for r in range(b.num_rows):
                if b["dict_sha256"][r].as_py() != sha:
                    raise ValueError(f"a block in {path} was written with another dictionary")
                doc_ids, counts, ends = (b[c][r].as_py() for c in ("doc_ids", "n_tokens", "ends"))
                payload, at, crcs = memoryview(b["payload"][r].as_buffer()), 0, []
                for n, end in zip(counts, ends):
                    ids = np.frombuffer(unpack.decompress(payload[at:end]), "<u2" if width == 2 else "<u4")
                    if len(ids) != n:
                        raise ValueError("the offset index and a frame disagree")
                    crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    at = end
                starts = np.cumsum([b["start"][r].as_py(), *counts[:-1]])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids, pa.int64()), "part": pa.array([b["part"][r].as_py()] * len(counts), pa.int32()),
                    "start": pa.array(starts, pa.int64()), "n_tokens": pa.array(counts, pa.int64()),
                    "ids_crc32": pa.array(crcs, pa.int64())})

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks") \
        .select("part", "dict_sha256", "start", "doc_ids", "n_tokens", "ends", "payload")
    parts = spark.read.schema("part int, part_start long").parquet(f"{path}/parts")
    return blocks.mapInArrow(rows, READ).join(F.broadcast(parts), "part") \
        .select("doc_id", (F.col("start") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """Ids of the document(s) with this id: only the blocks that can hold it, only its frames unpacked."""
    _, dictionary, width = _header(spark, path)
    unpack, out = _frames(dictionary), []
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks") \
        .where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id)).orderBy("part", "block")
    for r in blocks.select("doc_ids", "ends", "payload").collect():
        payload = memoryview(bytes(r.payload))
        for k, i in enumerate(r.doc_ids):
            if i == doc_id:
                frame = payload[r.ends[k - 1] if k else 0:r.ends[k]]
                out.append(np.frombuffer(unpack.decompress(frame), "<u2" if width == 2 else "<u4"))
    return out
