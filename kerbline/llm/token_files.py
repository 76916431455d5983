"""Token ids in files of coded blocks, in ascending order of doc_id, and back.

Documents are dealt into ranges of doc_id; a task writes its range as segments. A segment is one binary value:

    "KTOK", version, number of documents, of ids, ids per block, then documents (delta of doc_id with a null flag, number of
    ids) as variable-length integers, then per block the CRC-32 of its ids and its coded length, then the blocks

Blocks are coded independently (see `range_coder`) and checked on reading. Segments are rows of a Parquet table, written by
Spark's committer, so a lost executor leaves no half file and any file system will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbline.llm.common import map_arrow, slices, utf8
from kerbline.llm.range_coder import MOST_ID, decode, encode
from kerbline.llm.tokens import SLICE_BYTES, Tokenizer

#: Ids of a block, and of a segment: the 64 streams of each of 64 blocks move in step.
BLOCK_IDS = 1 << 16
SEGMENT_IDS = 64 * BLOCK_IDS
_HEAD = struct.Struct("<4sHxxIQI")
_MAGIC, _VERSION = b"KTOK", 3


def _numbers(values: list[int]) -> bytes:
    """Variable-length integers of 7 bits a byte; signed by zigzag."""
    out = bytearray()
    for value in values:
        value = value << 1 if value >= 0 else (-value << 1) - 1
        while value > 127:
            out.append(value & 127 | 128)
            value >>= 7
        out.append(value)
    return bytes(out)


def _read_numbers(raw: bytes, at: int, count: int) -> tuple[list[int], int]:
    found = []
    for _ in range(count):
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                break
        found.append(value >> 1 if not value & 1 else -(value + 1 >> 1))
    return found, at


def write_segment(doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    """Documents with so many ids each, whose ids follow one another."""
    if len(ids) and int(ids.max()) > MOST_ID:
        raise ValueError(f"ids above {MOST_ID} can't be coded")
    edges = np.append(np.arange(0, len(ids), BLOCK_IDS), len(ids))
    blocks = encode(ids, edges) if len(ids) else []
    raw = ids.astype("<u4", copy=False).tobytes()
    index, last = [], 0
    for doc, size in zip(doc_ids, sizes):
        index += [0 if doc is None else 1, 0 if doc is None else doc - last, size]
        last = last if doc is None else doc
    for k, block in enumerate(blocks):
        index += [zlib.crc32(raw[4 * edges[k] : 4 * edges[k + 1]]), len(block)]
    head = _HEAD.pack(_MAGIC, _VERSION, len(doc_ids), len(ids), BLOCK_IDS)
    return b"".join([head, _numbers(index), *blocks])


def read_segment(raw: bytes) -> tuple[list[int | None], list[int], np.ndarray]:
    """What `write_segment` got; a block whose checksum differs raises."""
    magic, version, documents, total, block_ids = _HEAD.unpack_from(raw)
    if magic != _MAGIC or version != _VERSION:
        raise ValueError("not a token segment of this version")
    edges = np.append(np.arange(0, total, block_ids), total)
    index, at = _read_numbers(raw, _HEAD.size, 3 * documents + 2 * (len(edges) - 1))
    doc_ids: list[int | None] = []
    last = 0
    for known, delta in zip(index[0 : 3 * documents : 3], index[1 : 3 * documents : 3]):
        last += delta
        doc_ids.append(last if known else None)
    sums, lengths = index[3 * documents :: 2], index[3 * documents + 1 :: 2]
    blocks = []
    for length in lengths:
        blocks.append(raw[at : at + length])
        at += length
    ids = decode(blocks, np.diff(edges)) if total else np.zeros(0, np.uint32)
    plain = ids.astype("<u4", copy=False).tobytes()
    for k, wanted in enumerate(sums):
        if zlib.crc32(plain[4 * edges[k] : 4 * edges[k + 1]]) != wanted:
            raise ValueError(f"block {k} is damaged")
    return doc_ids, index[2 : 3 * documents : 3], ids


def write(docs: DataFrame, tokenizer: Tokenizer, path: str, *, end_id: int = 0) -> None:
    """Write all documents' ids (doc_id, text) as a table of segments: part, segment, documents, before (ids in the part before it),
    ids and payload.

    Parts are in ascending order of doc_id (null first), as are segments within; of repeated doc_ids the order is that of
    the text. Null text counts as empty: it has the end id alone. An empty table gives a table without rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, segment, before = tokenizer.encoder(), TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        sizes: list[int] = []
        held: list[np.ndarray] = []

        def flushed() -> pa.RecordBatch:
            payload = write_segment(doc_ids, sizes, np.concatenate(held))
            values = (part, segment, len(doc_ids), before, sum(sizes), payload)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            for kept in (doc_ids, sizes, held):
                kept.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                ids, edges = encoder(*utf8(rows.column("text")))
                held.append(np.insert(ids, edges[1:], end_id))
                doc_ids += rows.column("doc_id").to_pylist()
                sizes += (np.diff(edges) + 1).tolist()
                if (count := sum(map(len, held))) >= SEGMENT_IDS:
                    yield flushed()
                    segment, before = segment + 1, before + count
        if doc_ids:
            yield flushed()

    names = ["part", "segment", "documents", "before", "ids", "payload"]
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranged = own.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = "part int, segment int, documents long, before long, ids long, payload binary"
    map_arrow(ranged, run, schema).write.parquet(path)


def read(table: DataFrame) -> DataFrame:
    """One row per document of a table of segments: doc_id, start (ids before it in all the table) and ids, as little-endian
    uint32. One number per part is summed up across the table; parts are as many as the writer's partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, payload in zip(batch.column("start").to_pylist(), batch.column("payload").to_pylist()):
                doc_ids, sizes, ids = read_segment(payload)
                raw = ids.astype("<u4", copy=False).tobytes()
                ends = np.cumsum(sizes)
                for at in range(0, len(doc_ids), 4096):
                    own = range(at, min(at + 4096, len(doc_ids)))
                    columns = [
                        pa.array([doc_ids[k] for k in own], pa.int64()),
                        pa.array([start + int(ends[k]) - sizes[k] for k in own], pa.int64()),
                        pa.array([raw[4 * (ends[k] - sizes[k]) : 4 * ends[k]] for k in own], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "ids"])

    parts = table.groupBy("part").agg(F.sum("ids").alias("all"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("first"))
    placed = table.select("part", "before", "payload").join(F.broadcast(starts), "part")
    return map_arrow(
        placed.select((F.col("first") + F.col("before")).alias("start"), "payload"), run, "doc_id long, start long, ids binary"
    )
