"""Adaptive context-mixing range coder for token ids; the streams of many blocks move in step, one numpy lane each.

A block starts from scratch, is cut into streams of about `STREAM_IDS` ids that are coded side by side, and has one model
that all its streams use and teach:

    order 2, order 1   tables of the id that last followed each pair of ids and each id, with how often it was right
    order 0            how often each id came that neither predicted; one that has not come yet has a small share

First comes which order's prediction holds: order 2's, order 1's, or neither; then, for neither, the id by order 0. The
shares of the three mix two adaptive distributions: one by how sure orders 1 and 2 are and whether they agree, the other by
what held for the last two ids; a weight per stream goes to whichever said it better. The model takes in what came after 1,
2, 4, ... ids of a stream, then after as many as `STALE` each, and stays as it is between; so the coder looks up a whole
stretch of steps at once. All arithmetic is in whole numbers, so that any machine decodes what another has coded.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

MOST_ID = (1 << 18) - 2
#: Ids of a stream, about. Streams of a block differ by one id at most.
STREAM_IDS = 1024
#: Bits of a share; slots of a block's tables; what one sighting of an id weighs against an id that has not come.
PRECISION, SLOTS, SEEN = 14, 1 << 14, 32
#: The model takes in what came after 1, 2, 4, ... ids of a stream, then after as many as this each.
STALE = 64
#: Steps that the coder looks up at once, at most.
AT_ONCE = 32
_TOTAL, _LEAST = 1 << PRECISION, 16
_NEAR, _ALONE = 32, 16
#: Sightings of a distribution beyond which they are halved.
_MOST_SEEN = 4096
_U32, _U64 = np.uint32, np.uint64
_ONE, _LOW, _32, _PRE = _U64(1), _U64(0xFFFFFFFF), _U64(32), _U64(PRECISION)
_SLOT = _U32(SLOTS - 1)


class _Seen(NamedTuple):
    """Of steps and streams: slots and entries of orders 1 and 2, places in the two distributions."""

    at1: np.ndarray
    at2: np.ndarray
    entry1: np.ndarray
    entry2: np.ndarray
    near: np.ndarray


class _Model:
    """Predictions for all streams; coder and decoder go through the same states. `alphabets`: each block's
    number of ids. What is only for coding or only for decoding is not made for the other."""

    def __init__(self, streams: _Streams, alphabets: np.ndarray, *, coding: bool):
        block = streams.block
        if (alphabets + SEEN * streams.sizes > (_LEAST << 32) // _TOTAL).any():
            raise ValueError("a block is too long")
        blocks = len(alphabets)
        self.first = np.zeros(blocks * SLOTS, np.int32)  # (id + 1) * 4 + how sure
        self.second = np.zeros(blocks * SLOTS, np.int32)
        self.base = block * SLOTS
        self.near_row, self.alone_row = block * _NEAR, block * _ALONE
        # Whole numbers; their quotients, cut off, are exact as well.
        self.near, self.alone = np.ones((3, blocks * _NEAR)), np.ones((3, blocks * _ALONE))
        self.weight = np.full(len(block), 128, np.int64)
        self.gain = np.zeros(len(block), np.int64)
        #: The last two ids + 1 and symbols.
        self.one, self.two = np.zeros(len(block), _U32), np.zeros(len(block), _U32)
        self.last, self.earlier = np.full(len(block), 2, np.int64), np.full(len(block), 2, np.int64)
        edges = np.append(0, np.cumsum(alphabets))
        self.edges, self.block = edges, block
        self.from_, self.alphabet = edges[:-1][block], alphabets[block]
        self.counts = np.zeros(int(edges[-1]), np.int64)
        self.came = np.zeros(0, np.int64)  # the places that are not 0
        #: By place in `counts`: how many ids came before this one in order of place, and 32 bits higher how often it came.
        self.places = np.zeros(len(self.counts) if coding else 0, np.int64)
        self.coding = coding
        self.news: list[tuple[np.ndarray, ...]] = []
        self.settle()

    def settle(self) -> None:
        """What follows from the counts as they are now."""
        each = self.counts.take(self.came)
        self.upto = np.append(0, np.cumsum(each))
        if self.coding:
            self.places[self.came] = self.upto[:-1] + (each << 32)
        else:
            self.listed = np.append(np.repeat(np.arange(len(each), dtype=np.int32), each), np.int32(0))
        blocks = self.upto.take(np.searchsorted(self.came, self.edges))
        self.zero = blocks[:-1].take(self.block)
        self.weighed = np.diff(blocks).take(self.block) * SEEN
        self.all = (self.weighed + self.alphabet).astype(_U64)
        self.near_share, self.alone_share = _shares(self.near), _shares(self.alone)
        self.near_ends, self.alone_ends = _ends(self.near_share), _ends(self.alone_share)
        self.rest = 256 - self.weight

    def trim(self, lanes: int) -> None:
        """Go on with the first streams only."""
        for name in ("base", "near_row", "alone_row", "weight", "rest", "gain", "one", "two", "last", "earlier", "block", "from_", "alphabet", "zero", "weighed", "all"):
            setattr(self, name, getattr(self, name)[:lanes])

    def look(self, one: np.ndarray, two: np.ndarray) -> _Seen:
        """What orders 1 and 2 have after these ids + 1."""
        hashed = one * _U32(0x9E3779B1)
        pair = two * _U32(0x85EBCA6B)
        pair ^= hashed
        hashed >>= _U32(15)
        pair >>= _U32(13)
        hashed &= _SLOT
        pair &= _SLOT
        at1, at2 = hashed + self.base, pair + self.base
        entry1, entry2 = self.first.take(at1), self.second.take(at2)
        near = entry2 & 3
        near <<= 2
        near |= entry1 & 3
        near <<= 1
        near |= (entry1 ^ entry2) < 4
        return _Seen(at1, at2, entry1, entry2, near + self.near_row)

    def ends(self, near: np.ndarray, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the shares of order 1 and of neither begin, order 2's being at 0."""
        mixed = self.near_ends.take(near)
        mixed *= self.weight
        far = self.alone_ends.take(alone)
        far *= self.rest
        mixed += far
        return (mixed >> 8 & 0xFFFFFF).view(_U64), (mixed >> 40).view(_U64)

    def note(self, named: np.ndarray, symbol: np.ndarray, seen: _Seen, alone: np.ndarray) -> None:
        """Keep what came in some steps (rows): ids + 1, and which prediction held, in which place of the second
        distribution."""
        near_at, alone_at = symbol * self.near.shape[1] + seen.near, symbol * self.alone.shape[1] + alone
        better = self.near_share.reshape(-1).take(near_at) > self.alone_share.reshape(-1).take(alone_at)
        self.gain += 8 * np.count_nonzero(better, 0) - 4 * len(better)
        new = named * 4 + 1
        kept = [near_at, alone_at, (self.from_ + named)[symbol == 2], seen.at1, seen.at2]
        # A prediction that was right gets surer; a wrong one that was sure stays, less sure; else the id takes its place.
        for entry in (seen.entry1, seen.entry2):
            after = np.where(entry & 2, entry - 2, new)
            right = np.flatnonzero((entry ^ new) < 4)
            sure = entry.reshape(-1).take(right)
            after.reshape(-1)[right] = sure + ((sure & 3) < 3)
            kept.append(after)
        self.news.append(tuple(x.reshape(-1) for x in kept))
        ids = named.view(_U32)
        self.one, self.two = ids[-1], ids[-2] if len(ids) > 1 else self.one
        self.last, self.earlier = symbol[-1], symbol[-2] if len(symbol) > 1 else self.last

    def learn(self) -> None:
        """Take in what was kept. Of ids that came to one slot since the last time, the last one stays."""
        near, alone, ids, at1, at2, after1, after2 = (np.concatenate(x) if len(x) > 1 else x[0] for x in zip(*self.news))
        self.news.clear()
        self.first[at1], self.second[at2] = after1, after2
        np.clip(self.weight + self.gain, 8, 248, out=self.weight)
        self.gain[:] = 0
        for counts, at in ((self.near, near), (self.alone, alone)):
            counts += 2 * np.bincount(at, minlength=counts.size).reshape(3, -1)
            full = counts.sum(0) > _MOST_SEEN
            counts[:, full] = (counts[:, full] + 1) // 2
        ids -= 1
        new = np.unique(ids[self.counts.take(ids) == 0])
        self.came = np.insert(self.came, np.searchsorted(self.came, new), new)
        np.add.at(self.counts, ids, 1)
        self.settle()

    def shares(self, named: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order 0: where the shares of these ids + 1 begin, and how large they are. First come ids that came, by SEEN for
        each time, then all ids by 1, for those that did not."""
        place = self.places.take(self.from_ + named - 1)
        often = place >> 32
        came = often > 0
        before = np.where(came, ((place & 0xFFFFFFFF) - self.zero) * SEEN, self.weighed + named - 1)
        return before, np.where(came, often * SEEN, 1)

    def found(self, lanes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids + 1 of these lanes in whose shares the values are, where the shares begin, and how large they are."""
        zero, weighed = self.zero.take(lanes), self.weighed.take(lanes)
        came = values < weighed
        which = self.listed.take(values // SEEN + zero, mode="clip")
        start = self.upto.take(which)
        size = self.upto.take(which + 1, mode="clip") - start
        named = np.where(came, self.came.take(which, mode="clip") - self.from_.take(lanes), values - weighed) if len(self.came) else values - weighed
        return named + 1, np.where(came, (start - zero) * SEEN, values), np.where(came, size * SEEN, 1)


def _shares(counts: np.ndarray) -> np.ndarray:
    """Counts as shares; together with _LEAST each they make _TOTAL at most."""
    return (counts * (_TOTAL - 3 * _LEAST) / counts.sum(0)).astype(np.int64)


def _ends(shares: np.ndarray) -> np.ndarray:
    """Where the second and the third symbol begin, the latter 32 bits higher."""
    return shares[0] + _LEAST + (shares[0] + shares[1] + 2 * _LEAST << 32)


class _Span:
    """The current interval of every lane, 64 bits wide; below 2^32, its upper half goes out, or the code's next comes in.
    That is after each id: a symbol leaves 2^22 or more of 2^32 (_LEAST of _TOTAL), and order 0 divides by that at most."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, _U64)
        self.size = np.full(lanes, 0xFFFFFFFFFFFFFFFF, _U64)

    def trim(self, lanes: int) -> None:
        self.low, self.size = self.low[:lanes], self.size[:lanes]

    def moved(self) -> tuple[np.ndarray, np.ndarray]:
        """Lanes that moved on by 32 bits, and where they began before. An interval astride a border of the upper half is cut
        at the border; after the move it has 2^32 or more again, so one move is enough."""
        lanes = np.flatnonzero(self.size <= _LOW)
        low, size = self.low.take(lanes), self.size.take(lanes)
        size = np.where((low ^ (low + size)) > _LOW, -low & _LOW, size)
        size <<= _32
        self.low[lanes], self.size[lanes] = low << _32, size
        return lanes, low


class _Streams:
    """How blocks of so many ids are cut into streams, the longest first, so that live ones are always the first ones."""

    def __init__(self, sizes: np.ndarray):
        self.sizes = sizes = np.asarray(sizes, np.int64)
        self.counts = np.maximum(sizes // STREAM_IDS, 1)
        block = np.repeat(np.arange(len(sizes)), self.counts)
        number = np.arange(len(block)) - np.repeat(np.cumsum(self.counts) - self.counts, self.counts)
        each, more = sizes // self.counts, sizes % self.counts
        starts = np.repeat(np.cumsum(sizes) - sizes, self.counts) + number * each[block] + np.minimum(number, more[block])
        lengths = each[block] + (number < more[block])
        self.order = np.argsort(-lengths, kind="stable")
        self.block, self.starts, self.lengths = block[self.order], starts[self.order], lengths[self.order]
        self.steps = int(self.lengths[0]) if len(block) else 0

    def rounds(self) -> Iterator[tuple[int, int, int, bool]]:
        """From which step to which so many streams go on, and whether the model takes in what came."""
        learns = {1 << k for k in range(STALE.bit_length())} | set(range(STALE, self.steps + 1, STALE))
        cuts = sorted({*range(0, self.steps, AT_ONCE), *(x for x in learns if x <= self.steps), 0, *np.unique(self.lengths).tolist()})
        lanes = np.searchsorted(-self.lengths, -np.array(cuts), "left").tolist()
        for begin, end, live in zip(cuts, cuts[1:], lanes):
            yield begin, end, live, end in learns


def encode(ids: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """Each block ids[edges[k] : edges[k + 1]] coded by itself: 32-bit words with the size of its alphabet, the number of
    words of each stream, and the streams. Ids are at most MOST_ID."""
    edges = np.asarray(edges, np.int64)
    streams = _Streams(np.diff(edges))
    lanes = len(streams.order)
    alphabets = np.array([int(ids[a:b].max()) + 1 if b > a else 1 for a, b in zip(edges[:-1], edges[1:])], np.int64)
    ids = ids[edges[0] : edges[-1]]
    model, span, starts = _Model(streams, alphabets, coding=True), _Span(lanes), streams.starts
    lanes_out: list[np.ndarray] = []
    words_out: list[np.ndarray] = []
    last = np.zeros(lanes, _U64)

    def move_on() -> None:
        some, low = span.moved()
        lanes_out.append(some)
        words_out.append((low >> _32).astype(_U32))

    for begin, end, live, learns in streams.rounds():
        if live < len(starts):
            last[live : len(starts)] = span.low[live:]
            starts = starts[:live]
            model.trim(live)
            span.trim(live)
        now = ids.take(starts + np.arange(begin, end)[:, None]).astype(np.int32)
        now += 1
        known = np.concatenate([model.two[None], model.one[None], now.view(_U32)])
        seen = model.look(known[1:-1], known[:-2])
        symbol = np.where((seen.entry2 ^ now * 4) < 4, 0, np.where((seen.entry1 ^ now * 4) < 4, 1, 2))
        held = np.concatenate([model.earlier[None], model.last[None], symbol])
        alone = held[:-2] * 4 + held[1:-1] + model.alone_row
        second, third = model.ends(seen.near, alone)
        neither, of_first = symbol == 2, symbol == 0
        start = np.where(neither, third, np.where(of_first, _U64(0), second))
        share = np.where(neither, _U64(_TOTAL), np.where(of_first, second, third)) - start
        # Streams whose id is told by now take all of their interval.
        before, own = model.shares(now)
        before, own = (before * neither).astype(_U64), np.where(neither, own, 1).astype(_U64)
        every = np.where(neither, model.all, _ONE)
        for k in range(end - begin):
            unit = span.size >> _PRE
            span.low += unit * start[k]
            span.size = unit * share[k]
            unit = span.size // every[k]
            span.low += unit * before[k]
            span.size = unit * own[k]
            move_on()
        model.note(now, symbol, seen, alone)
        if learns:
            model.learn()
    last[: len(span.low)] = span.low
    every = np.arange(lanes)
    lane = streams.order[np.concatenate([*lanes_out, every, every])]
    word = np.concatenate([*words_out, (last >> _32).astype(_U32), (last & _LOW).astype(_U32)])
    # Numbers of 16 bits are sorted by counting.
    word = word[np.argsort(lane.astype(np.uint16) if lanes <= 1 << 16 else lane, kind="stable")].astype("<u4")
    counts = np.bincount(lane, minlength=lanes).astype("<u4")
    ends = np.append(0, np.cumsum(counts, dtype=np.int64))
    coded, at = [], 0
    for alphabet, own in zip(alphabets.tolist(), streams.counts.tolist()):
        head = np.array([alphabet], "<u4").tobytes() + counts[at : at + own].tobytes()
        coded.append(head + word[ends[at] : ends[at + own]].tobytes())
        at += own
    return coded


def decode(blocks: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """The ids of all blocks, one after another. Blocks whose heads do not fit their lengths raise ValueError."""
    streams = _Streams(sizes)
    alphabets, counts, words = [], [], []
    for block, own in zip(blocks, streams.counts.tolist()):
        whole = np.frombuffer(block, "<u4")
        head, body = whole[: own + 1], whole[own + 1 :]
        if len(head) <= own or not 0 < head[0] <= MOST_ID + 1 or int(head[1:].sum(dtype=np.int64)) != len(body):
            raise ValueError("a block's head is damaged")
        alphabets.append(int(head[0]))
        counts.append(head[1:])
        words.append(body)
    lanes = len(streams.order)
    out = np.zeros(int(np.sum(sizes)), np.int32)
    if not lanes:
        return out.astype(np.uint32)
    # What a damaged stream reads beyond its end is its neighbour's or zero; the checksum tells.
    word = np.concatenate([*words, np.zeros(2, "<u4")]).astype(_U64)
    ends = np.cumsum(np.concatenate(counts).astype(np.int64))
    taken = np.append(0, ends[:-1])[streams.order]
    model, span, starts = _Model(streams, np.array(alphabets, np.int64), coding=False), _Span(lanes), streams.starts
    code = word.take(taken, mode="clip") << _32 | word.take(taken + 1, mode="clip")
    taken = taken + 2

    def move_on() -> None:
        some, _ = span.moved()
        place = taken.take(some)
        code[some] = code.take(some) << _32 | word.take(place, mode="clip")
        taken[some] = place + 1

    for begin, end, live, learns in streams.rounds():
        if live < len(starts):
            starts, code, taken = starts[:live], code[:live], taken[:live]
            model.trim(live)
            span.trim(live)
        one, two, last, earlier = model.one, model.two, model.last, model.earlier
        rows = []
        for _ in range(begin, end):
            seen = model.look(one, two)
            alone = earlier * 4
            alone += last
            alone += model.alone_row
            second, third = model.ends(seen.near, alone)
            unit = span.size >> _PRE
            second *= unit
            third *= unit
            value = code - span.low
            past_first, neither = value >= second, value >= third
            start = np.where(neither, third, second * past_first)
            unit <<= _PRE
            span.size = np.where(neither, unit, np.where(past_first, third, second)) - start
            span.low += start
            now = np.where(past_first, seen.entry1, seen.entry2) >> 2
            told = np.flatnonzero(neither)
            total, low = model.all.take(told), span.low.take(told)
            unit = span.size.take(told) // total
            value = np.minimum((code.take(told) - low) // unit, total - _ONE).view(np.int64)
            now[told], before, own = model.found(told, value)
            span.low[told] = low + unit * before.view(_U64)
            span.size[told] = unit * own.view(_U64)
            move_on()
            symbol = past_first.astype(np.int64)
            symbol += neither
            rows.append((now, symbol, alone, *seen))
            two, one, earlier, last = one, now.view(_U32), last, symbol
        now, symbol, alone, *seen = (np.stack(x) for x in zip(*rows))
        out[starts + np.arange(begin, end)[:, None]] = now
        model.note(now, symbol, _Seen(*seen), alone)
        if learns:
            model.learn()
    return (out - 1).astype(np.uint32)
