"""Compositions of many short texts with a piece transducer at once: all lattices of a batch are walked in step.

The transducer's trie and the machine that remembers the last piece are hash tables of integers, looked up for a whole
batch by numpy. Arcs of all lattices come from one walk down the trie that starts at every character; then the texts' end
positions are settled in order, for all texts together, longest piece first.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Characters that a text walked in step has at most, and a batch.
LONGEST, BATCH_CHARS = 64, 1 << 18
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Table:
    """Integers by integer keys (not negative), with open addressing; grows by doubling."""

    def __init__(self, size: int = 1 << 12):
        self.used = 0
        self._empty(size)

    def _empty(self, size: int) -> None:
        self.keys, self.values, self.shift = np.full(size, -1, np.int64), np.zeros(size, np.int32), np.uint64(65 - size.bit_length())

    def clear(self) -> None:
        self.used = 0
        self.keys.fill(-1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MULTIPLIER) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, -1 where there is none."""
        at = self._home(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.values[at], -1)
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            there = self.keys[at[left]]
            hit = there == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (there >= 0)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Take in distinct keys that are not there yet."""
        if 2 * (self.used + len(keys)) > len(self.keys):
            held = self.keys >= 0
            keys, values = np.concatenate([self.keys[held], keys]), np.concatenate([self.values[held], values])
            self._empty(1 << int(4 * len(keys)).bit_length())
            self.used = 0
        self.used += len(keys)
        at, left = self._home(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[at[left]] < 0
            claim = left[free]
            self.keys[at[claim]] = keys[claim]  # of several claims on a place, the last one stays
            mine = self.keys[at[left]] == keys[left]
            self.values[at[left[mine]]] = values[left[mine]]
            left = left[~mine]
            at[left] = (at[left] + 1) & (len(self.keys) - 1)


class Lattices:
    """Best paths of texts. Pieces have the numbers of their place in `pieces`; a character that is none has the number
    `strange` and its code point. Paths go by the `cost` of pieces and, last, of strange characters, or by `stays`, which
    tells of (left, right) whether they may follow each other (left is None at a text's start)."""

    def __init__(self, pieces: list[str], cost: np.ndarray | None, stays: Callable[[int | None, int], bool], remembered: int):
        self.count, self.strange, self.longest = len(pieces), len(pieces) + 1, max(map(len, pieces), default=1)
        self.cost, self.stays, self.remembered = cost, stays, remembered
        steps: dict[int, int] = {}
        final = [-1]
        for number, piece in enumerate(pieces):
            node = 0
            for char in piece:
                key = node << 21 | ord(char)
                if key not in steps:
                    steps[key] = len(final)
                    final.append(-1)
                node = steps[key]
            final[node] = number
        self.final = np.array(final, np.int32)
        self.trie, self.pairs = Table(), Table()
        self.trie.put(np.fromiter(steps, np.int64, len(steps)), np.fromiter(steps.values(), np.int32, len(steps)))

    def _may_follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether pieces may follow each other; a pair is worked out when first met."""
        keys = left << 21 | right
        found = self.pairs.get(keys)
        if len(missing := np.flatnonzero(found < 0)):
            new, back = np.unique(keys[missing], return_inverse=True)
            lefts, rights = (new >> 21).tolist(), (new & (1 << 21) - 1).tolist()
            told = np.array([self.stays(None if a == self.count else a, b) for a, b in zip(lefts, rights)], np.int32)
            if self.pairs.used + len(new) > self.remembered:
                self.pairs.clear()
            self.pairs.put(new, told)
            found[missing] = told[back]
        return found > 0

    def paths(self, chars: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all texts one after another, and how many each has.

        `chars` are the texts' characters, none empty and none longer than LONGEST. A text of n characters has n + 1
        places, and the best way to each is kept: the characters alone make one at least.
        """
        texts, total = len(sizes), int(sizes.sum())
        text = np.repeat(np.arange(texts), sizes)
        begins = np.cumsum(sizes) - sizes
        stops = (begins + sizes)[text]
        place = np.arange(total) - begins[text]
        # Arcs: walk down from every character.
        at, node = np.arange(total), np.zeros(total, np.int64)
        starts, lengths, pieces = [], [], []
        for length in range(1, self.longest + 1):
            inside = at + length <= stops[at]
            at, node = at[inside], node[inside]
            node = self.trie.get(node << 21 | chars[at + length - 1]).astype(np.int64)
            if length == 1:
                alone = np.flatnonzero((node < 0) | (self.final[node] < 0))
                starts.append(alone)
                lengths.append(np.ones(len(alone), np.int64))
                pieces.append(self.strange + chars[alone])
            there = node >= 0
            at, node = at[there], node[there]
            if not len(at):
                break
            piece = self.final[node]
            ends = piece >= 0
            starts.append(at[ends])
            lengths.append(np.full(len(starts[-1]), length, np.int64))
            pieces.append(piece[ends])
        start, length, piece = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, lengths, pieces))
        group = (place[start] + length) * (self.longest + 1) + self.longest - length
        order = np.argsort(group.astype(np.int32), kind="stable")
        edges = np.concatenate([[0], np.cumsum(np.bincount(group))]) if len(group) else np.zeros(1, np.int64)
        start = start + text[start]  # from characters to places
        end = start + length
        start, end, piece = start[order], end[order], piece[order].astype(np.int64)
        # Ends in order, longest piece first; a group has one arc a text.
        last = np.full(total + texts, -1, np.int64)
        back = np.zeros(total + texts, np.int64)
        roots = begins + np.arange(texts)
        last[roots] = self.count
        spent = np.full(total + texts, np.inf)
        spent[roots] = 0.0
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if low == high:
                continue
            a, b, p = start[low:high], end[low:high], piece[low:high]
            if self.cost is None:
                open_ = np.flatnonzero((last[b] < 0) & (last[a] >= 0))
                chosen = open_[self._may_follow(last[a[open_]], p[open_])] if len(open_) else open_
            else:
                cost = spent[a] + self.cost[np.minimum(p, self.count)]
                chosen = np.flatnonzero(cost < spent[b])
                spent[b[chosen]] = cost[chosen]
            last[b[chosen]], back[b[chosen]] = p[chosen], a[chosen]
        # Back from every text's end.
        now, owner, walked, owners = roots + sizes, np.arange(texts), [], []
        counts = np.zeros(texts, np.int64)
        if (last[now] < 0).any():
            raise ValueError("a text has no path")
        while len(now):
            walked.append(last[now])
            owners.append(owner)
            counts[owner] += 1
            now = back[now]
            more = now != roots[owner]
            now, owner = now[more], owner[more]
        ends = np.cumsum(counts)
        out = np.empty(int(counts.sum()), np.int64)
        for step, (found, owner) in enumerate(zip(walked, owners)):
            out[ends[owner] - 1 - step] = found
        return out, counts
