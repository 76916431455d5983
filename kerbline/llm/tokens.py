"""Ids of whole texts by a tokenizer file of the `tokenizers` library, at the speed of a dictionary.

The byte-level pre-tokenizer never joins a character with white space after it, nor a letter with what is none. So a text
may be cut there, each distinct stretch is encoded once by the library, and the text's ids are the stretches' ids in
order. For the same reason new stretches may be encoded as one long text; the bytes that each id stands for tell whose it
is.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import SparkSession

#: Stretches that a worker remembers, about, at some 200 bytes each.
REMEMBERED = 100_000
SLICE_BYTES = 2 << 20
#: Bytes of new stretches that the library gets as one text.
RUN_BYTES = 1 << 12
#: Such texts that it gets at once.
RUNS = 32

#: Bytes as white space, other ASCII, letters, and parts of wider characters.
_SPACE, _OTHER, _LETTER, _WIDE = range(4)
_KIND = np.full(256, _WIDE, np.uint8)
_KIND[:128] = _OTHER
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[65:91] = _KIND[97:123] = _LETTER
#: ASCII white space of the pre-tokenizer, and with the four separators, which may be such.
_BLANKS = b"\t\n\x0b\x0c\r "
_ENDS = _BLANKS + b"\x1c\x1d\x1e\x1f"


def stretches(data: np.ndarray, offsets: np.ndarray, joins: np.ndarray) -> np.ndarray:
    """Where texts and, in them, stretches begin; `data` holds just the texts, `offsets` starts at 0.

    A stretch begins where a run of letters ends: the pre-tokenizer's letters never go on, and it does not look back. And
    it begins at ASCII white space after something else, unless that may be wider white space: the lead bytes C2, E1, E2
    and E3 with the next byte of such characters, and the four separators 1C to 1F. Letters are those of ASCII and, of two
    bytes, C3 80 to C3 BF but for the signs at 97 and B7; after any other character only white space makes a cut. There is
    no cut between a letter and a byte of `joins`: special tokens have them, which are found before all else.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    kind = _KIND[data]
    cut = np.flatnonzero((kind[1:] < _LETTER) & (kind[:-1] > kind[1:])) + 1
    last = data[cut - 1]
    before = data[np.maximum(cut - 2, 0)]
    third = data[np.maximum(cut - 3, 0)]
    wide = last >= 0x80
    letter = np.where(wide, (before == 0xC3) & (last != 0x97) & (last != 0xB7), kind[cut - 1] == _LETTER)
    space = kind[cut] == _SPACE
    odd = (before == 0xC2) & ((last == 0x85) | (last == 0xA0))
    odd |= wide & (third >= 0xE1) & (third <= 0xE3) & np.isin(before, [0x9A, 0x80, 0x81, 0xA0])
    odd |= (last >= 0x1C) & (last <= 0x1F)
    starts = offsets[:-1][np.diff(offsets) > 0]
    begins = np.zeros(len(data), bool)
    begins[cut[(letter & ~joins[data[cut]]) | (space & ~odd)]] = True
    begins[starts] = True
    return np.flatnonzero(begins)


class StretchEncoder:
    """Ids of texts by way of their distinct stretches, which are remembered: new ones, and those met again, in `known`; when
    that holds half of `remembered` (REMEMBERED, if 0), it takes the place of `before`, whose stretches are forgotten unless
    met since. Subclasses say where texts are cut, and encode."""

    def __init__(self, remembered: int = 0) -> None:
        self.remembered = remembered
        self.known: dict[bytes, bytes] = {}  # a stretch's ids
        self.before: dict[bytes, bytes] = {}

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where stretches begin; every text that is not empty begins one."""
        raise NotImplementedError

    def encoded(self, new: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The stretches in any order, all their ids in that order, and how many each has."""
        raise NotImplementedError

    def _ids_of(self, distinct: list[bytes]) -> list[bytes]:
        """The ids of each, as bytes."""
        known, before = self.known, self.before
        found = list(map(known.get, distinct))
        if None in found:
            lacking = [s for s, ids in zip(distinct, found) if ids is None]
            known.update((s, before[s]) for s in lacking if s in before)
            if new := [s for s in lacking if s not in before]:
                new, ids, sizes = self.encoded(new)
                raw, ends = ids.astype(np.uint32, copy=False).tobytes(), (4 * np.cumsum(sizes)).tolist()
                known.update(zip(new, [raw[a:b] for a, b in zip([0, *ends], ends)]))
            found = [known[s] if ids is None else ids for s, ids in zip(distinct, found)]
        most = self.remembered or REMEMBERED
        if 2 * len(known) > most:
            # One call's stretches may be more than all that is to be remembered.
            self.known, self.before = {}, known if len(known) <= most else {}
        return found

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's ids begin and end."""
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        cuts = self.cuts(data, offsets)
        if not len(cuts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        edges = np.append(cuts, len(data))
        parts = pa.Array.from_buffers(
            pa.large_binary(), len(cuts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        _, places, raw = parts.dictionary.buffers()
        raw, places = raw.to_pybytes(), np.frombuffer(places, np.int64)[: len(parts.dictionary) + 1].tolist()
        found = pa.array(self._ids_of([raw[a:b] for a, b in zip(places, places[1:])]), pa.large_binary())
        _, ends, ids = found.take(parts.indices).buffers()
        ends = np.frombuffer(ends, np.int64)[: len(cuts) + 1] >> 2
        flat = np.frombuffer(ids, np.uint32, ends[-1]) if ends[-1] else np.zeros(0, np.uint32)
        return flat, ends[np.searchsorted(cuts, offsets)]


class Encoder(StretchEncoder):
    """Ids by the `tokenizers` library; one per worker and tokenizer."""

    def __init__(self, tokenizer: str, remembered: int = 0):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__(remembered)
        # Spark gives a task its share of the cores; threads of the library would take others' and 100 MB.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_str(tokenizer)
        before = self.tokenizer.pre_tokenizer
        if self.tokenizer.normalizer or not isinstance(before, ByteLevel) or before.add_prefix_space:
            raise ValueError("texts can be cut for a byte-level tokenizer without normalizer and prefix only")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes = np.zeros(self.tokenizer.get_vocab_size() + 1, np.int64)
        self.bytes[list(vocabulary.values())] = [len(token) for token in vocabulary]  # a character for each byte
        self.joins = np.zeros(256, bool)
        for number, token in self.tokenizer.get_added_tokens_decoder().items():
            content = np.frombuffer(token.content.encode(), np.uint8)
            self.bytes[number] = len(content)
            self.joins[content[1:][_KIND[content[:-1]] >= _LETTER]] = True
        self.joins[97:123] = self.joins[65:91] = False  # between letters there is no cut anyway
        if self.joins[[9, 10, 11, 12, 13, 32]].any():
            raise ValueError("special tokens with white space can't be kept whole")

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return stretches(data, offsets, self.joins)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. The library's results are many times as large as the ids, so few are held at once."""
        found = []
        for at in range(0, len(texts), RUNS):
            for one in self.tokenizer.encode_batch_fast(texts[at : at + RUNS], add_special_tokens=False):
                found.append(np.frombuffer(array("I", one.ids), np.uint32))
        return found

    def encoded(self, new: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The stretches in another order, all their ids, and how many each has."""
        # White space at an end would meet that of the next stretch.
        fits = [s[0] in _BLANKS and (s[-1] not in _ENDS if s[-1] < 0x80 else not s.decode()[-1].isspace()) for s in new]
        joined = [s for s, ok in zip(new, fits) if ok]
        single = [s for s, ok in zip(new, fits) if not ok]
        ids = self._ids([s.decode() for s in single])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        if joined:
            ends = np.cumsum(np.fromiter(map(len, joined), np.int64, len(joined)))
            cuts = [0, *np.unique(np.searchsorted(ends, np.arange(RUN_BYTES, ends[-1] + RUN_BYTES, RUN_BYTES)) + 1).tolist()]
            cuts = [c for c in cuts if c < len(joined)] + [len(joined)]
            more = self._ids([b"".join(joined[a:b]).decode() for a, b in zip(cuts, cuts[1:])])
            ids += more
            upto = np.cumsum(self.bytes[np.concatenate(more)])
            last = np.searchsorted(upto, ends)
            if not np.array_equal(upto[last], ends):
                raise ValueError("ids of joined stretches do not end where the stretches do")
            sizes = np.concatenate([sizes, np.diff(last, prepend=-1)])
        return single + joined, np.concatenate(ids), sizes


@dataclass(frozen=True)
class Tokenizer:
    """A tokenizer file's content, sent to every executor once; the file is read on the driver only."""

    content: Broadcast
    name: str
    remembered: int = 0

    def encoder(self) -> Encoder:
        if (key := (self.name, self.remembered)) not in _encoders:
            _encoders[key] = Encoder(self.content.value, self.remembered)
        return _encoders[key]


_encoders: dict[tuple[str, int], Encoder] = {}


def tokenizer(spark: SparkSession, path: str, *, remembered: int = 0) -> Tokenizer:
    """`remembered` stretches a worker keeps in mind (REMEMBERED, if 0), at about 200 bytes each."""
    content = Path(path).read_text("utf-8")
    return Tokenizer(spark.sparkContext.broadcast(content), hashlib.sha256(content.encode()).hexdigest(), remembered)
