"""The piece transducer against the library, whose merging it does not share."""

from __future__ import annotations

import random
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from kerbline.llm import wfst

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = list("  \t\n▁▁abcetheinan'1,.\xa0日本語ßÉ😀\x00") + ["the", "ing", " of", "<s>", "<0x0A>", "   ", "aaa", "\n\n", " é"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return wfst.Model(open(PATH, "rb").read())


def texts(n):
    draw = random.Random(5)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 25))) for _ in range(n)]


def test_ids_and_texts_are_the_library_s(model, library):
    some = [*texts(1500), "", "x" * 3000, " " * 100]
    ids, edges = wfst.PieceEncoder(model).texts(pa.array(some))
    for k, text in enumerate(some):
        want = library.encode(text)
        assert ids[edges[k] : edges[k + 1]].tolist() == want == model.encode(text)
        assert model.decode(want) == library.decode(want)


def message(*fields):
    """A protocol-buffer message of (number, value) fields."""
    out = b""
    for number, value in fields:
        if isinstance(value, float):
            out += bytes([number << 3 | 5]) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += bytes([number << 3, value])
        else:
            out += bytes([number << 3 | 2]) + (bytes([len(value)]) if len(value) < 128 else bytes([len(value) & 127 | 128, len(value) >> 7])) + value
    return out


def unigram(pieces):
    rows = [("<unk>", 0.0, 2), *((p, s, 1) for p, s in pieces)]
    parts = [(1, message((1, t.encode()), (2, float(s)), (3, k))) for t, s, k in rows]
    return wfst.Model(message(*parts, (2, message((3, 1))), (3, message((1, b"identity"), (3, 1), (4, 0)))))


def test_unigram_takes_the_cheapest_path():
    pieces = [("▁", -3.0), ("a", -2.0), ("b", -2.5), ("ab", -3.0), ("▁a", -4.5), ("ba", -1.0), ("abab", -6.0), ("c▁", -9.0), ("c", -4.0)]
    model = unigram(pieces)
    scores = dict(pieces)
    draw = random.Random(1)

    def best(text):
        cost = [0.0] + [float("inf")] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(end):
                piece = text[start:end]
                price = -scores[piece] if piece in scores else model.worst if end - start == 1 else float("inf")
                cost[end] = min(cost[end], cost[start] + price)
        return cost[-1]

    for _ in range(300):
        text = "".join(draw.choice("abc z") for _ in range(draw.randint(1, 12)))
        path = model.shortest(("▁" + text).replace(" ", "▁"))
        spent = sum(-scores[p] if p in scores else model.worst for p in path)
        assert "".join(path) == ("▁" + text).replace(" ", "▁") and spent == pytest.approx(best("▁" + text.replace(" ", "▁")))
    assert not model.cuttable  # "c▁" spans a cut, so texts stay whole
    assert wfst.PieceEncoder(model).cuts(np.frombuffer(b" c a", np.uint8), np.array([0, 4])).tolist() == [0]


def test_models_that_can_not_be_compiled():
    with pytest.raises(ValueError):
        wfst.Model(message((1, message((1, b"a"))), (3, message((2, b"map"), (4, 0)))))


def test_on_spark(spark, documents, library):
    rows = list(enumerate(texts(60))) + [(100, None), (101, ""), (None, "no id"), (7, "again"), (102, "a b " * 20_000)]
    model = wfst.piece_model(spark, PATH)
    got = wfst.decode_ids(wfst.encode_texts(documents(rows), model), model).collect()
    want = sorted((str(d), library.encode(t or ""), library.decode(library.encode(t or ""))) for d, t in rows)
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), r.text) for r in got) == want
    assert wfst.encode_texts(documents(rows).filter("false"), model).collect() == []
