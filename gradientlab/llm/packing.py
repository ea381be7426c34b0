"""Token-id files: fixed-width bit packing in blocks.

A file set is a Parquet folder whose rows are segments, in the order of the
documents.  A segment's ``packed`` bytes are self-contained:

    magic 'BPK1', width (uint8), 3 zero bytes, block length (uint32), number of ids (uint64),
    number of blocks + 1 offsets (uint64, bytes from the end of this table), then the blocks.

Each id takes ``width`` bits, the fewest that hold the vocabulary, low bits first.
A block holds a fixed number of ids and starts at a byte, so block k of any
segment unpacks alone, and an id range touches only its own blocks.  Parquet is
the container because every store that Spark writes to can hold it.

Documents are dealt out by range of (doc_id, text hash) and sorted within a
partition; a segment ends after ``segment_ids`` ids, or after one longer
document.  No task holds more than a segment.  Null texts count as empty; every
document ends with ``end_id``, so empty ones have one id.  Null doc_ids come
first; rows that share a doc_id stand next to each other, by text hash, and each
has its own place.  Other columns of the input are ignored; an empty table
writes an empty file set.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from tokenizers import Tokenizer, pre_tokenizers

from ..session import stage_table
from .pieces import Memo

MAGIC = b"BPK1"
_HEAD = struct.Struct("<4sB3xIQ")
SEGMENTS = (
    "part int, segment int, n_ids bigint, doc_ids array<bigint>, counts array<bigint>, packed binary"
)


def width_of(vocabulary_size: int) -> int:
    """Bits that hold every id below ``vocabulary_size``."""
    return max(1, int(vocabulary_size - 1).bit_length())


def pack_block(ids: np.ndarray, width: int) -> bytes:
    bits = (ids.astype(np.uint64)[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_block(data: memoryview | bytes, width: int, count: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(data, dtype=np.uint8), bitorder="little", count=count * width)
    weights = np.uint64(1) << np.arange(width, dtype=np.uint64)
    return (bits.reshape(count, width).astype(np.uint64) @ weights).astype(np.int64)


def _pack_all(ids: np.ndarray, width: int) -> bytes:
    if width == 16:
        return ids.astype("<u2").tobytes()
    if width == 8:
        return ids.astype(np.uint8).tobytes()
    return pack_block(ids, width)


def _unpack_all(data: memoryview | bytes, width: int, count: int) -> np.ndarray:
    if width == 16:
        return np.frombuffer(data, dtype="<u2", count=count).astype(np.int64)
    if width == 8:
        return np.frombuffer(data, dtype=np.uint8, count=count).astype(np.int64)
    return unpack_block(data, width, count)


def pack(ids: np.ndarray, width: int, block: int = 4096) -> bytes:
    """A segment's bytes."""
    if len(ids) and (int(ids.max()) >> width or int(ids.min()) < 0):
        raise ValueError(f"an id does not fit in {width} bits")
    blocks = [_pack_all(ids[i : i + block], width) for i in range(0, len(ids), block)]
    offsets = np.zeros(len(blocks) + 1, dtype="<u8")
    np.cumsum([len(b) for b in blocks], out=offsets[1:])
    return b"".join([_HEAD.pack(MAGIC, width, block, len(ids)), offsets.tobytes(), *blocks])


def unpack(packed: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a segment; only the blocks that hold them are read."""
    magic, width, block, count = _HEAD.unpack_from(packed)
    if magic != MAGIC:
        raise ValueError("not a packed segment")
    stop = count if stop is None else min(stop, count)
    start = max(0, start)
    if start >= stop:
        return np.zeros(0, dtype=np.int64)
    n_blocks = -(-count // block)
    offsets = np.frombuffer(packed, dtype="<u8", count=n_blocks + 1, offset=_HEAD.size)
    base, view = _HEAD.size + 8 * (n_blocks + 1), memoryview(packed)
    first, last = start // block, (stop - 1) // block
    parts = [
        _unpack_all(view[base + int(offsets[k]) : base + int(offsets[k + 1])], width, min(block, count - k * block))
        for k in range(first, last + 1)
    ]
    return np.concatenate(parts)[start - first * block : stop - first * block]


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # a special token's string inside a text is ordinary text
    return tokenizer


def vocabulary_size(path: str) -> int:
    return _tokenizer(path).get_vocab_size()


@lru_cache(maxsize=2)
def _memo(path: str) -> Memo:
    tokenizer = _tokenizer(path)
    model = tokenizer.model
    # what the library's byte-level step makes of each byte
    step = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    letters: dict[int, str] = {}
    for code in [*range(0x800), *range(0x800, 0xD800, 0x400), *range(0xE000, 0x110000, 0x4000)]:
        letters.update(zip(chr(code).encode(), step.pre_tokenize_str(chr(code))[0][0]))

    def encode(pieces: list[str]) -> list[list[int]]:
        return [[t.id for t in model.tokenize(p.encode().decode("latin-1").translate(letters))] for p in pieces]

    return Memo(encode)


def encode_texts(texts: list[str | None], path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, offsets of the texts in them), by the tokenizers library.

    The library splits a text by the same pattern before its model merges, so
    the model is asked once for each new piece and the pieces' ids are joined.
    The file must be one of byte-level BPE without a prefix blank.
    """
    return _memo(path).lookup(texts)


def write_ids(
    df: DataFrame, folder: str, path: str, text: str = "text", end_id: int = 0, segment_ids: int = 1 << 18,
    block: int = 4096, partitions: int | None = None,
) -> None:
    """Encode every text and write the file set to ``folder``."""
    width = width_of(vocabulary_size(path))
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"),
        F.xxhash64(F.col(f"`{text}`")).alias("tie"),
    )
    dealt = rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        docs: list[int | None] = []
        held: list[np.ndarray] = []
        size, segment = 0, 0

        def close() -> pa.RecordBatch:
            packed = pack(np.concatenate(held), width, block)
            counts = [len(x) for x in held]
            return pa.RecordBatch.from_pydict(
                {"part": [part], "segment": [segment], "n_ids": [size], "doc_ids": [docs], "counts": [counts], "packed": [packed]},
                schema=pa.schema([
                    ("part", pa.int32()), ("segment", pa.int32()), ("n_ids", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("packed", pa.binary()),
                ]),
            )

        for batch in batches:
            ids, offsets = encode_texts(batch.column("text").to_pylist(), path)
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), offsets[:-1], offsets[1:]):
                docs.append(doc)
                held.append(np.append(ids[a:b], np.int32(end_id)))
                size += len(held[-1])
                if size >= segment_ids:
                    yield close()
                    docs, held, size, segment = [], [], 0, segment + 1
        if held:
            yield close()

    dealt.drop("tie").mapInArrow(run, SEGMENTS).write.parquet(folder)


def read_segments(spark: SparkSession, folder: str) -> DataFrame:
    """The segments with ``start``, the number of ids before each in the whole set.

    Totals by partition are added up first, then those of the segments of each
    partition, so no window holds more than the partitions or one partition's segments.
    """
    files = spark.read.schema(SEGMENTS).parquet(folder)
    sizes = files.select("part", "segment", "n_ids")
    totals = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("ahead", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(bases, "part")
    # staged, so that its size is known: a small table is sent to the files, not the files shuffled to it
    starts = stage_table(starts.select("part", "segment", (F.col("base") + F.col("ahead")).alias("start")), "starts")
    return files.join(starts, ["part", "segment"])


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone."""
    schema = T.StructType.fromDDL("doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["counts"], dtype=np.int64)
                ends = np.cumsum(counts)
                data = memoryview(unpack(row["packed"]).astype("<u4").tobytes())
                sums = [zlib.crc32(data[4 * (e - c) : 4 * e]) for c, e in zip(counts, ends)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], type=pa.int64()), pa.array(row["start"] + ends - counts, type=pa.int64()),
                    pa.array(counts), pa.array(sums, type=pa.int64()),
                ], names=schema.names)

    return read_segments(spark, folder).select("doc_ids", "counts", "packed", "start").mapInArrow(run, schema)
