"""Exact and near duplicates against brute force."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest

from kerbline.llm import exact_dedup, near_dedup
from kerbline.llm.components import components


def exact_expected(rows):
    groups = defaultdict(list)
    for k, (doc, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc if doc is not None else 2**63, k, doc))
    return sorted(
        (str(doc), str(min(g)[3]), len(g), k == min(g)[2]) for g in groups.values() for *_, k, doc in g
    )


def test_exact(spark, documents, prose):
    long_ = prose(1, 60_000)
    rows = [(k, prose(k % 7, 30 + k % 3)) for k in range(40)]
    rows += [(100, long_), (101, long_ + "\n"), (102, long_[:-1] + "#"), (103, None), (104, ""), (105, " \t\n")]
    rows += [(106, "é a"), (107, "é  a"), (108, "éa "), (109, "\u00a0"), (None, "alone"), (None, "é a"), (200, "twice"), (200, "twice")]
    rows += [(300 + k, "hot\u2003copy") for k in range(50)]
    got = exact_dedup.duplicates(documents(rows))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in got.collect()) == exact_expected(rows)


def test_exact_of_nothing(documents):
    assert exact_dedup.duplicates(documents([]).filter("false")).collect() == []


def test_exact_rows_that_stay(documents):
    rows = [(1, "a b"), (2, "ab"), (3, "a b"), (None, "a  b"), (4, None), (5, ""), (6, "x"), (6, "x"), (None, "y"), (None, "y")]
    got = exact_dedup.deduplicated(documents(rows)).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == [("4", None), ("6", "x"), ("None", "a  b"), ("None", "y")]
    assert got[0].kept == "x"


def shingle_set(text, size):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(zip(*(words[k:] for k in range(size)))) if len(words) >= size else frozenset([tuple(words)] if words else [])


def near_expected(rows, size, percent):
    sets = [shingle_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for k, (doc, _) in enumerate(rows):
        least[find(k)].append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in least.items()}
    out = []
    for k, (doc, _) in enumerate(rows):
        component = least[find(k)] if sets[k] else doc
        out.append((str(doc), len(sets[k]), str(component), doc is not None and doc == component))
    return sorted(out)


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near(documents, prose, edited, size, percent):
    base = prose(3, 200)
    rows = [(k, prose(1000 + k, 60)) for k in range(30)]
    rows += [(100 + k, edited(base, k // 3, f"e{k}")) for k in range(60)]  # from near to far, around one text
    rows += [(300, "Two Words"), (301, "two\twords"), (302, "one"), (303, None), (304, ""), (305, " \n"), (306, "ONE")]
    chain = prose(5, 300).split(" ")
    rows += [(400 + k, " ".join(chain[4 * k : 4 * k + 150])) for k in range(8)]  # each is near the next only
    rows += [(None, base), (500, base.upper()), (500, base), (600, prose(9, 20_000)), (601, edited(prose(9, 20_000), 300, "z"))]
    got = near_dedup.near_duplicates(documents(rows), size=size, percent=percent).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == near_expected(rows, size, percent)


def test_near_of_nothing(documents):
    empty = documents([]).filter("false")
    assert near_dedup.near_duplicates(empty).collect() == []
    assert near_dedup.deduplicated(documents([(1, None), (2, ""), (None, "a")])).count() == 3


def test_blocks_find_all_that_pivots_miss(documents, prose, edited, monkeypatch):
    """Many near copies in a few buckets, searched through in blocks much smaller than the bucket."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    base = prose(7, 120)
    rows = [(k, edited(base, 2 + k % 9, f"w{k}")) for k in range(90)]
    got = near_dedup.near_duplicates(documents(rows), size=3, percent=85).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == near_expected(rows, 3, 85)


def test_sketches_never_refute_a_link():
    rng = np.random.default_rng(1)
    minhash = near_dedup.MinHash(85)
    for n in (20, 100, 3000):
        for _ in range(20):
            own = rng.integers(0, 1 << 63, n, np.uint64)
            swapped = int(n * 0.15 / 1.85)
            other = np.concatenate([own[swapped:], rng.integers(0, 1 << 63, swapped, np.uint64)])
            whole = [np.unpackbits(near_dedup.odd_sketch(s, near_dedup.SET_BITS)) for s in (own, other)]
            assert (whole[0] ^ whole[1]).sum() <= near_dedup.most_differing(np.array(n), np.array(n), 85)
            samples = [np.unpackbits(minhash.sketch(minhash.of(s))) for s in (own, other)]
            assert (samples[0] ^ samples[1]).sum() <= minhash.most_bits()


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1200)] + [(5, 5), (3, 2)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(201)}, **{k: 1000 for k in range(1000, 1200)}}
