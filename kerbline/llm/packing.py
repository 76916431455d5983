"""Sum-of-squares online packing of tokenised documents into windows of fixed length.

A level array counts the open windows by how full they are. A document goes into the level that makes the sum of squared
counts smallest, so that no fill level piles up. Every task packs its own stream of documents: nothing is shuffled, and
memory holds the open windows only. A document longer than a window fills whole windows first; when a task's documents
end, the emptiest open windows are cut up to fill the gaps of the fullest, so that one window at most stays short.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.common import map_arrow, slices, utf8
from kerbline.llm.tokens import SLICE_BYTES, Tokenizer

SCHEMA = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long"
#: Rows of a batch that a task hands back; a full one holds 4 MB of ids.
ROWS = 512
_NEVER = np.int64(1) << 60

#: doc_id, start, ids as little-endian uint32, doc_tokens
Piece = tuple[int | None, int, bytes, int]


class Packer:
    """Windows of `capacity` tokens; `add` and `close` give the windows that are finished."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        # Change of the sum of squares if a window comes to a level, or leaves it. A full window no longer counts.
        self.comes = np.ones(capacity + 1, np.int64)
        self.comes[capacity] = 0
        self.leaves = np.full(capacity + 1, _NEVER)
        self.leaves[0] = 0
        self.open: dict[int, list[list[Piece]]] = {}

    def _count(self, level: int, by: int) -> None:
        if 0 < level < self.capacity:
            self.counts[level] += by
            n = self.counts[level]
            self.comes[level] = 2 * n + 1
            self.leaves[level] = 1 - 2 * n if n else _NEVER

    def level_for(self, size: int) -> int:
        """The level whose change makes the sum of squares least; of equals the fullest, which leaves least room."""
        change = self.comes[size:] + self.leaves[: self.capacity - size + 1]
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def add(self, piece: Piece) -> list[list[Piece]]:
        size = len(piece[2]) // 4
        level = self.level_for(size)
        window = self.open[level].pop() if level else []
        window.append(piece)
        self._count(level, -1)
        if level + size == self.capacity:
            return [window]
        self._count(level + size, 1)
        self.open.setdefault(level + size, []).append(window)
        return []

    def close(self) -> list[list[Piece]]:
        left = [(level, window) for level in sorted(self.open, reverse=True) for window in self.open[level]]
        first, last = 0, len(left) - 1
        while first < last:
            level, window = left[first]
            fill, source = left[last]
            doc, start, ids, tokens = source.pop()
            taken = min(self.capacity - level, len(ids) // 4)
            window.append((doc, start, ids[: 4 * taken], tokens))
            if 4 * taken < len(ids):
                source.append((doc, start + taken, ids[4 * taken :], tokens))
            left[first], left[last] = (level + taken, window), (fill - taken, source)
            first += level + taken == self.capacity
            last -= fill == taken
        return [window for _, window in left if window]


def pack(docs: DataFrame, tokenizer: Tokenizer, *, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, ids (little-endian uint32), doc_tokens, sequence_id and offset.

    `docs` has doc_id and text; further columns are left out. Null text counts as empty: its one piece holds the end id.
    Null and repeated doc_ids are carried along, each row is packed for itself. No rows give no pieces. A window of
    task p is numbered from p * 2^40 on; a task that runs again gives the same windows, as it reads the same rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer, number = tokenizer.encoder(), Packer(capacity), TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def out(windows: list[list[Piece]]) -> None:
            nonlocal number
            for window in windows:
                offset = 0
                for piece in window:
                    rows.append((*piece, number, offset))
                    offset += len(piece[2]) // 4
                number += 1

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*rows))
            rows.clear()
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids, edges = encode(*utf8(part.column("text")))
                end = np.array([end_id], "<u4").tobytes()
                raw = ids.astype("<u4", copy=False).tobytes()
                for doc, a, b in zip(part.column("doc_id").to_pylist(), edges[:-1].tolist(), edges[1:].tolist()):
                    own, tokens = raw[4 * a : 4 * b] + end, b - a + 1
                    for start in range(0, tokens, capacity):
                        out(packer.add((doc, start, own[4 * start : 4 * (start + capacity)], tokens)))
                    if len(rows) >= ROWS:
                        yield flushed()
        out(packer.close())
        if rows:
            yield flushed()

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, SCHEMA)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with length and checksum in place of the ids."""
    return pieces.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
