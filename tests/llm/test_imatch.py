"""Fingerprints against a plain reading of the method, and of the edits."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from kerbline.llm import imatch
from kerbline.llm.common import utf8
from kerbline.llm.queries import op4_imatch
from kerbline.llm.shingles import mix, words


def term(word):
    return int(words(*utf8(pa.array([word])))[0][0])


def brute(text, band):
    """Lexicon by lexicon, term by term."""
    terms = {term(w) for w in (text or "").split()}
    kept = sorted(t for t in terms if t >> (64 - imatch.SLOT_BITS) in band) or sorted(terms)
    out = []
    for power in range(1, imatch.POWERS + 1):
        for seed in imatch._SEEDS:
            spread = {t: int(mix(np.array([t], np.uint64) ^ seed)[0]) for t in kept}
            own = [t for t in kept if spread[t] >> (power * (power - 1) // 2) & ((1 << power) - 1) == 0]
            raw = np.array(own, np.uint64).tobytes()
            out.append(hashlib.blake2b(raw, digest_size=imatch.DIGITS // 2).hexdigest() if own else "." * imatch.DIGITS)
    return out


def edits(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for k, (doc, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        yield doc, text, text[: len(text) - half] + after[:half], after


@pytest.mark.parametrize("sent", [imatch.BROADCAST_TERMS, 0])
@pytest.mark.parametrize("partitions", ["1", "4"])
def test_matches_definition(spark, documents, prose, monkeypatch, partitions, sent):
    """Both where the band is sent out and where texts' terms meet it by key."""
    monkeypatch.setattr(imatch, "BROADCAST_TERMS", sent)
    rows = [(3 * k % 41, prose(k % 37, 4 + 5 * (k % 9))) for k in range(41)]
    rows += [(100, None), (101, ""), (102, "ü😀 word"), (103, " \n"), (None, "no id here"), (7, "again the same id"), (104, prose(2, 4000))]
    docs = documents(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = imatch.fingerprint_with_edits(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    count = {}
    for _, text in rows:
        for t in {term(w) >> (64 - imatch.SLOT_BITS) for w in (text or "").split()}:
            count[t] = count.get(t, 0) + 1
    band = {t for t, n in count.items() if 2 <= n <= int(imatch.MOST_SHARE * len(rows))}
    want = []
    for doc, text, edited, after in edits(rows):
        own, other, next_ = (brute(t, band) for t in (text, edited, after))
        want.append((str(doc), len(text), edited, "".join(own), "".join(other), imatch.likeness(own, other), imatch.likeness(own, next_)))
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)


@pytest.mark.parametrize("sent", [imatch.BROADCAST_TERMS, -1])
def test_few_rows(documents, monkeypatch, sent):
    monkeypatch.setattr(imatch, "BROADCAST_TERMS", sent)
    assert imatch.fingerprint_with_edits(documents([]).filter("false")).collect() == []
    (row,) = imatch.fingerprint_with_edits(documents([(5, "abcd efg")])).collect()
    assert row.edited == "abcdabcd" and row.near_next == 1.0
    assert {r.near_next for r in imatch.fingerprint_with_edits(documents([(1, "same"), (1, "same"), (1, "same")])).collect()} == {1.0}


def test_likeness_tells_edits_from_strangers(spark, sf_dir):
    got = op4_imatch(spark, sf_dir).filter("n_chars > 400").agg({"near_edited": "avg", "near_next": "avg"}).first()
    assert got["avg(near_edited)"] > 0.15 and got["avg(near_next)"] < 0.1


def sharing_words(bits):
    """Two words whose hashes begin with the same bits."""
    seen = {}
    for k in range(1 << bits):
        other = seen.setdefault(term(f"w{k}") >> (64 - bits), f"w{k}")
        if other != f"w{k}":
            return other, f"w{k}"


def test_frequencies_by_word(documents, prose, monkeypatch):
    texts = [prose(k, 200) for k in range(60)] + ["twice Twice", None, " ", "\u00fc"]
    count = Counter(w for t in texts for w in set((t or "").lower().split()))
    want = sorted((term(w), n) for w, n in count.items())
    for held in (imatch.HELD_TERMS, 150):
        monkeypatch.setattr(imatch, "HELD_TERMS", held)
        got = imatch.document_frequencies(documents(list(enumerate(texts))).coalesce(2)).collect()
        assert sorted((r.term % 2**64, r.documents) for r in got) == want


def test_a_word_found_once_is_left_out_whatever_hashes_like_it(documents, prose):
    left, right = sharing_words(22)
    base = prose(1, 100)
    rows = [(0, base), (1, f"{base} {left}"), (2, f"{right} {base}")] + [(k, prose(k, 20)) for k in range(3, 40)]
    got = {r.doc_id: r.fingerprint for r in imatch.fingerprint_with_edits(documents(rows)).collect()}
    assert got[0] == got[1] == got[2]
