"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model file is compiled into a cascade. The normaliser writes spaces as U+2581, one more in front of the text. The piece
transducer is a trie whose final states put out a piece at its cost, with a byte fallback for characters without piece.
Composed with a text they make a lattice; the ids are its shortest path in the tropical semiring (costs add, the least
wins). Short stretches are composed in step (see `lattice`), long ones alone. A unigram model's costs are negative scores.

A merge-based (BPE) model has no costs that could be added up. But its language is local: pieces are its encoding of a text
just if each two neighbours are its encoding of what they spell. So the cascade gets one more machine that remembers the
last piece; a transition to a piece that would have merged across the border costs infinity, any other nothing. One path
of finite cost is left, which is what merging gives. Costs of transitions are worked out when first met and kept.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.llm.common import map_arrow, slices, utf8
from kerbline.llm.lattice import BATCH_CHARS, LONGEST, Lattices
from kerbline.llm.tokens import SLICE_BYTES, StretchEncoder

SPACE = "▁"
#: Fixed values of the model file: kinds of model and of pieces.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, BYTE = 1, 2, 6
NEVER = float("inf")
#: What an unknown character costs more than the worst piece in a unigram model.
UNKNOWN_PENALTY = 10.0
#: Transitions that a worker remembers.
REMEMBERED_PAIRS = 500_000


def _fields(raw: bytes) -> Iterator[tuple[int, int | float | bytes]]:
    """Number and value of each field of a protocol-buffer message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = raw[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(raw):
        key, at = number(at)
        kind = key & 7
        if kind == 0:
            value, at = number(at)
        else:
            if kind == 2:
                size, at = number(at)
            else:
                size = 4 if kind == 5 else 8
            value, at = raw[at : at + size], at + size
            if kind == 5:
                value = struct.unpack("<f", value)[0]
        yield key >> 3, value


class Model:
    """A model file compiled for encoding and decoding."""

    def __init__(self, content: bytes):
        self.kind, self.prefix, pieces = UNIGRAM, True, []
        for field, value in _fields(content):
            if field == 1:
                piece = dict(_fields(value))
                pieces.append((piece[1].decode(), piece.get(2, 0.0), piece.get(3, NORMAL)))
            elif field == 2:
                self.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif field == 3:
                rules = dict(_fields(value))
                self.prefix = bool(rules.get(3, 1))
                if rules.get(2) or rules.get(4, 1):
                    raise ValueError("the normaliser may only write spaces as U+2581; this one maps or drops characters")
        if self.kind not in (UNIGRAM, BPE) or not {kind for *_, kind in pieces} <= {NORMAL, UNKNOWN, BYTE, 3}:
            raise ValueError("unigram and BPE models with normal, byte and control pieces can be compiled")
        self.scores = {text: score for text, score, kind in pieces if kind == NORMAL}
        self.ids = {text: k for k, (text, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.unknown = next(k for k, (*_, kind) in enumerate(pieces) if kind == UNKNOWN)
        self.bytes = {int(text[3:5], 16): k for k, (text, _, kind) in enumerate(pieces) if kind == BYTE}
        self.spelled = [
            bytes([int(text[3:5], 16)]) if kind == BYTE else text.replace(SPACE, " ").encode() if kind == NORMAL else b""
            for text, _, kind in pieces
        ]
        self.spelled[self.unknown] = " ⁇ ".encode()
        self.trie: dict = {}
        for text in self.scores:
            node = self.trie
            for char in text:
                node = node.setdefault(char, {})
            node[""] = text  # the final state's piece
        self.worst = max((-score for score in self.scores.values()), default=0.0) + UNKNOWN_PENALTY
        #: No piece holds U+2581 after something else, so texts can be cut there.
        self.cuttable = not any(SPACE in text.lstrip(SPACE) for text in self.scores)
        self._kept: dict[tuple[str, str], bool] = {}
        self.pieces = list(self.scores)
        self.numbers = np.array([self.ids[text] for text in self.pieces], np.uint32)
        cost = np.array([*(-score for score in self.scores.values()), self.worst]) if self.kind == UNIGRAM else None
        self.lattices = Lattices(self.pieces, cost, self._may_follow, REMEMBERED_PAIRS)

    # -- the machine that remembers the last piece -----------------------------------------------------------------------

    def _merged(self, text: str) -> list[str]:
        """The pieces that merging makes of a short text: best score first, leftmost of equals."""
        parts = list(text)
        while True:
            best, at = -NEVER, -1
            for k in range(len(parts) - 1):
                score = self.scores.get(parts[k] + parts[k + 1], -NEVER)
                if score > best:
                    best, at = score, k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stays(self, left: str, right: str) -> bool:
        """Whether the two pieces are the encoding of what they spell; `left` is empty at the start of a text."""
        if len(self._kept) >= REMEMBERED_PAIRS:
            self._kept.clear()
        found = self._kept[left, right] = self._merged(left + right) == ([left, right] if left else [right])
        return found

    def _text(self, number: int) -> str:
        return self.pieces[number] if number < len(self.pieces) else chr(number - self.lattices.strange)

    def _may_follow(self, left: int | None, right: int) -> bool:
        """The same for numbers of pieces."""
        before, after = "" if left is None else self._text(left), self._text(right)
        return self._merged(before + after) == ([before, after] if before else [after])

    # -- composition and shortest path ------------------------------------------------------------------------------------

    def shortest(self, text: str) -> list[str]:
        """The pieces of the normalised text.

        Arcs of the lattice are walked in the trie from every position that a path of finite cost reaches: pieces, and the
        character alone if it is none. A position has one best way: all ways of a merge-based model but one are infinite,
        as a prefix has one encoding, and a unigram model has one state.
        """
        size, merging = len(text), self.kind == BPE
        cost, back, last = [0.0] + [NEVER] * size, [0] * (size + 1), [""] * (size + 1)
        trie, scores, kept = self.trie, self.scores, self._kept
        for start in range(size):
            spent, left = cost[start], last[start]
            if spent == NEVER:
                continue
            arcs, node, end = [], trie, start
            while end < size and (node := node.get(text[end])) is not None:
                end += 1
                if (piece := node.get("")) is not None:
                    arcs.append((end, piece))
            if text[start] not in scores:
                arcs.append((start + 1, text[start]))
            for end, piece in arcs:
                if merging:
                    stays = kept.get((left, piece))
                    if stays is None:
                        stays = self.stays(left, piece)
                    total = spent if stays else NEVER
                else:
                    total = spent - scores.get(piece, -self.worst)
                if total < cost[end]:
                    cost[end], back[end], last[end] = total, start, piece
        found, at = [], size
        while at:
            found.append(last[at])
            at = back[at]
        return found[::-1]

    def output(self, piece: str) -> list[int]:
        if piece in self.ids:
            return [self.ids[piece]]
        if self.bytes:
            return [self.bytes[b] for b in piece.encode()]
        return [self.unknown]

    def ids_of(self, text: str) -> list[int]:
        return [k for piece in self.shortest(text) for k in self.output(piece)]

    def _batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that are composed in step, one after another, and how many each has."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
        pieces, counts = self.lattices.paths(chars, sizes)
        ids, width = np.zeros(len(pieces), np.uint32), np.ones(len(pieces), np.int64)
        plain = pieces < len(self.pieces)
        ids[plain] = self.numbers[pieces[plain]]
        strange, which = np.unique(pieces[~plain], return_inverse=True)
        outputs = [self.output(self._text(int(number))) for number in strange]
        width[~plain] = np.fromiter(map(len, outputs), np.int64, len(outputs))[which] if outputs else 0
        begins = np.cumsum(width) - width
        out = np.repeat(ids, width)
        places = begins[~plain]
        for number, output in enumerate(outputs):
            for step, value in enumerate(output):
                out[places[which == number] + step] = value
        return out, np.add.reduceat(width, np.cumsum(counts) - counts)

    def ids_of_all(self, texts: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """An order of the texts (none empty), all their ids in it, and how many each has. Short texts are composed in
        step, the others one by one."""
        order = [k for k, text in enumerate(texts) if len(text) <= LONGEST]
        found, sizes, own, size = [], [], [], 0
        for place, k in enumerate(order):
            own.append(texts[k])
            size += len(texts[k])
            if size >= BATCH_CHARS or place + 1 == len(order):
                for into, values in zip((found, sizes), self._batch(own)):
                    into.append(values)
                own, size = [], 0
        for k, text in enumerate(texts):
            if len(text) > LONGEST:
                order.append(k)
                found.append(np.array(self.ids_of(text), np.uint32))
                sizes.append(np.array([len(found[-1])]))
        return order, np.concatenate(found), np.concatenate(sizes)

    def encode(self, text: str) -> list[int]:
        """Ids of one whole text."""
        return self.ids_of((" " * self.prefix + text).replace(" ", SPACE)) if text else []

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join(self.spelled[k] for k in ids)
        return raw[self.prefix and raw[:1] == b" " :].decode("utf-8", "replace")


class PieceEncoder(StretchEncoder):
    """Ids of many texts; each distinct stretch is composed once. Texts come with the prefix space in place."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        starts = offsets[:-1][np.diff(offsets) > 0]
        if not self.model.cuttable or len(data) < 2:
            return starts
        space = data == 0x20
        cut = np.flatnonzero(space[1:] & ~space[:-1]) + 1
        before, third = data[np.maximum(cut - 2, 0)], data[np.maximum(cut - 3, 0)]
        mark = (data[cut - 1] == 0x81) & (before == 0x96) & (third == 0xE2)  # U+2581 itself is a space to the pieces
        begins = np.zeros(len(data), bool)
        begins[cut[~mark]] = True
        begins[starts] = True
        return np.flatnonzero(begins)

    def encoded(self, new: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        order, ids, sizes = self.model.ids_of_all([s.decode().replace(" ", SPACE) for s in new])
        return [new[k] for k in order], ids, sizes

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = utf8(column)
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        if not self.model.prefix:
            return self(data, offsets)
        full = np.diff(offsets) > 0
        return self(np.insert(data, offsets[:-1][full], 0x20), offsets + np.concatenate([[0], np.cumsum(full)]))


_encoders: dict[str, PieceEncoder] = {}


@dataclass(frozen=True)
class PieceModel:
    """A model file's content, sent to every executor once."""

    content: Broadcast
    name: str

    def encoder(self) -> PieceEncoder:
        if self.name not in _encoders:
            _encoders[self.name] = PieceEncoder(Model(self.content.value))
        return _encoders[self.name]


def piece_model(spark: SparkSession, path: str) -> PieceModel:
    content = Path(path).read_bytes()
    return PieceModel(spark.sparkContext.broadcast(content), hashlib.sha256(content).hexdigest())


def encode_texts(docs: DataFrame, model: PieceModel) -> DataFrame:
    """doc_id and ids (little-endian uint32) of every row of `docs`. Null and empty text have no ids; null and repeated
    doc_ids are carried along; further columns are left out. Nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = model.encoder()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids, edges = encoder.texts(part.column("text"))
                raw = ids.astype("<u4", copy=False).tobytes()
                found = [raw[4 * a : 4 * b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.binary())], names=["doc_id", "ids"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, ids binary")


def decode_ids(encoded: DataFrame, model: PieceModel) -> DataFrame:
    """doc_id, ids and text of rows from `encode_texts`; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = model.encoder().model.decode
        for batch in batches:
            texts = [None if v is None else decode(np.frombuffer(v, "<u4").tolist()) for v in batch.column("ids").to_pylist()]
            columns = [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "text"])

    return map_arrow(encoded.select("doc_id", "ids"), run, "doc_id long, ids binary, text string")
