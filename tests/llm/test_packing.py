"""Tokens and packing: every id in exactly one piece, windows filled, levels chosen by the sum of squares."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer as Library

from kerbline.llm import packing
from kerbline.llm.common import utf8
from kerbline.llm.tokens import Encoder, tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = list(" \t\n\r\x0b\x0c\x1c\x1d\x85\xa0 　᠎​﻿abcé’1,.!日語ßÉ😀\x00") + ["<|endoftext|>", "'s ", "'ll", "  ", "\n\n", " é"]


@pytest.fixture(scope="module")
def library():
    return Library.from_file(PATH)


def test_ids_are_the_library_s(library):
    draw = random.Random(3)
    texts = ["".join(draw.choice(PIECES) for _ in range(draw.randint(0, 30))) for _ in range(2000)] + [None, "", "a" * 5000]
    encoder = Encoder(open(PATH, encoding="utf-8").read())
    for _ in range(2):  # new, then remembered
        ids, edges = encoder(*utf8(pa.array(texts)))
        for k, text in enumerate(texts):
            assert ids[edges[k] : edges[k + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_stretches_met_once_a_call_are_encoded_once(library):
    encoder, asked = Encoder(library.to_str(), remembered=40), []
    encode = encoder.encoded
    encoder.encoded = lambda new: asked.extend(new) or encode(new)
    text = np.frombuffer(b"each of these words comes only once here", np.uint8)
    edges = np.array([0, len(text)])
    first = encoder(text, edges)[0].tolist()
    assert first == library.encode(bytes(text).decode()).ids == encoder(text, edges)[0].tolist()
    assert len(asked) == len(set(asked)) == 8
    for k in range(30):  # what is met again stays, what is not is forgotten
        for words in (b"each of these", b"other words %d and %d" % (k, 100 + k)):
            data = np.frombuffer(words, np.uint8)
            assert encoder(data, np.array([0, len(data)]))[0].tolist() == library.encode(words.decode()).ids
        assert len(encoder.known) + len(encoder.before) <= 60
    assert asked.count(b" these") == 1


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr("kerbline.llm.tokens.REMEMBERED", 10)
    encoder = Encoder(open(PATH, encoding="utf-8").read())
    for k in range(5):
        text = " ".join(f"w{k}{j}" for j in range(8))
        assert encoder(*utf8(pa.array([text])))[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_level_choice_is_the_least_sum_of_squares():
    rng = np.random.default_rng(2)
    packer = packing.Packer(24)
    for k in range(400):
        size = int(rng.integers(1, 25))
        counts = packer.counts.copy()

        def squares(level, size=size, counts=counts):
            after = counts.copy()
            after[level] -= level > 0
            if level + size < 24:
                after[level + size] += 1
            return int((after[1:24] ** 2).sum())

        options = [h for h in range(25 - size) if h == 0 or counts[h]]
        chosen = packer.level_for(size)
        assert chosen in options and squares(chosen) == min(map(squares, options))
        packer.add((k, 0, b"\0\0\0\0" * size, size))
        assert {h: len(w) for h, w in packer.open.items() if w} == {h: int(n) for h, n in enumerate(packer.counts) if n}


def check(rows, pieces, library, capacity):
    want = sorted(tuple(library.encode(t or "", add_special_tokens=False).ids + [1]) for _, t in rows)
    ids = {(p.doc_id, p.start, p.sequence_id, p.offset): np.frombuffer(p.ids, "<u4").tolist() for p in pieces}
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append((p.start, ids[p.doc_id, p.start, p.sequence_id, p.offset]))
    joined = sorted(tuple(i for _, part in sorted(parts) for i in part) for parts in by_doc.values())
    assert joined == want
    windows = defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append((p.offset, len(p.ids) // 4))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return [sum(n for _, n in parts) for parts in windows.values()]


@pytest.mark.parametrize("partitions", [1, 3])
def test_pack(spark, documents, prose, library, partitions):
    rows = [(k, prose(k, 5 + k * 7 % 180)) for k in range(60)] + [(100, None), (101, ""), (102, prose(5, 3000)), (None, "a null id")]
    rows += [(103, "x" * 10_000)]
    docs = documents(rows).repartition(partitions)
    pieces = packing.pack(docs, tokenizer(spark, PATH), capacity=256).collect()
    fills = check(rows, pieces, library, 256)
    assert sum(n < 256 for n in fills) <= partitions
    assert {p.doc_tokens for p in pieces if p.doc_id == 101} == {1}


def test_repeated_rows_and_nothing(spark, documents, library):
    docs = documents([(1, "same text"), (1, "same text")]).coalesce(1)
    pieces = packing.pack(docs, tokenizer(spark, PATH)).collect()
    assert [(p.doc_id, p.start) for p in pieces] == [(1, 0)] * 2 and len({p.offset for p in pieces}) == 2
    assert packing.pack(docs.filter("false"), tokenizer(spark, PATH)).collect() == []


def test_digests(spark, documents, library):
    import zlib

    got = packing.digests(packing.pack(documents([(1, "hello there")]), tokenizer(spark, PATH))).first()
    ids = np.array(library.encode("hello there", add_special_tokens=False).ids + [1], "<u4")
    assert (got.length, got.ids_crc32, got.doc_tokens) == (len(ids), zlib.crc32(ids.tobytes()), len(ids))
