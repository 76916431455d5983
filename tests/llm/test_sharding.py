"""Minimax shards against brute force over all contiguous cuts."""

from __future__ import annotations

import zlib

import pytest

from kerbline.llm import sharding


def smallest_capacity(sizes, shards):
    """Least capacity with which a greedy pass does, tried one by one."""
    for capacity in range(max(sizes), sum(sizes) + 1):
        used, count = 0, 1
        for size in sizes:
            used, count = (used + size, count) if used + size <= capacity else (size, count + 1)
        if count <= shards:
            return capacity
    return 0


CASES = {
    "varied": [(k, "é" * (k * 37 % 90)) for k in range(70)],
    "copies": [(k, "the same" if k % 3 == 0 else f"own {k}" * (k % 5)) for k in range(60)],
    "giant": [(0, "a"), (1, "x" * 5000), (2, "b"), (3, "c")],
    "nulls": [(None, "no id"), (None, None), (1, None), (2, ""), (2, ""), (3, "y" * 40)],
    "one": [(5, "only")],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("shards, probes", [(8, 63), (3, 2)])
def test_minimax(documents, monkeypatch, name, shards, probes):
    monkeypatch.setattr(sharding, "PROBES", probes)
    monkeypatch.setattr(sharding, "BLOCKS", 16)
    rows = CASES[name]
    got = sharding.shard(documents(rows), shards).collect()
    raw = lambda t: (t or "").encode()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(d), len(raw(t)) + 1, zlib.crc32(raw(t))) for d, t in rows
    )
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(-1 if d is None else d)
    sizes = [len(ds) * (len(raw(t)) + 1) for t, ds in sorted(groups.items(), key=lambda g: min(g[1])) for ds in [groups[t]]]
    loads, slots, homes = {}, {}, {}
    for r in got:
        loads[r.shard] = loads.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
        homes.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values()) and set(loads) <= set(range(shards))
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    if name != "nulls":  # null ids tie, so the order of groups is free
        assert max(loads.values()) == smallest_capacity(sizes, shards)


def test_nothing(documents):
    assert sharding.shard(documents([]).filter("false")).collect() == []
