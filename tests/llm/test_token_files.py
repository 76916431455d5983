"""Range coder and token files: exact round trips, damage found, order and starts."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from kerbline.llm import token_files
from kerbline.llm.range_coder import MOST_ID, decode, encode
from kerbline.llm.tokens import tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("most", [1, 2, 300, 50_257, MOST_ID])
@pytest.mark.parametrize("seed", range(4))
def test_round_trip(most, seed):
    rng = np.random.default_rng([most, seed])
    sizes = rng.integers(1, 300, rng.integers(1, 50))
    ids = np.minimum(rng.zipf(1.2, sizes.sum()), most).astype(np.uint32) if seed % 2 else rng.integers(0, most + 1, sizes.sum(), np.uint32)
    if seed == 3:
        ids[:] = np.resize(ids[:7], len(ids))
    blocks = encode(ids, np.cumsum([0, *sizes]))
    assert (decode(blocks, sizes) == ids).all()
    # Any block alone says the same: blocks are independent.
    k = len(sizes) // 2
    at = int(sizes[:k].sum())
    assert (decode([blocks[k]], sizes[k : k + 1]) == ids[at : at + sizes[k]]).all()


def test_repetition_is_cheap_and_noise_is_not_dear():
    period = np.resize(np.arange(100, 140, dtype=np.uint32), 1 << 15)
    noise = np.random.default_rng(0).integers(0, 50_257, 1 << 15).astype(np.uint32)
    edges = np.arange(0, (1 << 15) + 1, 1024)
    assert sum(map(len, encode(period, edges))) * 8 < 3 * len(period)
    assert sum(map(len, encode(noise, edges))) * 8 < 20 * len(noise)


def test_streams_of_a_block_share_its_model():
    """A block of many streams learns from all of them, comes nearer to its ids' entropy than its streams would alone, and
    says the same by itself as among others."""
    rng = np.random.default_rng(5)
    sizes = np.array([1 << 16, 70_001, 1, 2048, 1023])
    shares = 1 / np.arange(3, 2003)
    shares /= shares.sum()
    ids = (rng.choice(2000, sizes.sum(), p=shares) * 25).astype(np.uint32)
    edges = np.cumsum([0, *sizes])
    blocks = encode(ids, edges)
    assert (decode(blocks, sizes) == ids).all()
    assert (decode(blocks[1:2], sizes[1:2]) == ids[edges[1] : edges[2]]).all()
    entropy = -(shares * np.log2(shares)).sum()
    alone = encode(ids[: sizes[0]], np.arange(0, sizes[0] + 1, 1024))
    assert 8 * len(blocks[0]) < 1.1 * entropy * sizes[0] < 8 * sum(map(len, alone))


def test_a_block_with_a_damaged_head_is_refused():
    ids = np.arange(5000, dtype=np.uint32)
    block = encode(ids, [0, 5000])[0]
    for broken in (b"", block[:8], block[4:], block[:-4], b"\0\0\0\0" + block[4:], b"\xff\xff\xff\xff" + block[4:]):
        with pytest.raises(ValueError):
            decode([broken], np.array([5000]))


def test_a_block_too_long_for_its_shares_is_refused():
    with pytest.raises(ValueError):
        encode(np.zeros(1 << 18, np.uint32), [0, 1 << 18])
    with pytest.raises(ValueError):
        decode([np.array([1, *[1] * 256, *[0] * 256], "<u4").tobytes()], np.array([1 << 18]))


def test_order_0_is_looked_up_without_a_search(monkeypatch):
    """The model's sums are searched once for all blocks when it learns, never for the ids of a step."""
    ids = np.random.default_rng(8).integers(0, 50_257, 1 << 14).astype(np.uint32)
    blocks, wanted, search = encode(ids, [0, len(ids)]), [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda *a, **b: wanted.append(0) or search(*a, **b))
    assert (decode(blocks, np.array([len(ids)])) == ids).all()
    assert len(wanted) < 100  # the steps are 1024


def test_segment_holds_its_documents_and_finds_damage():
    ids = np.random.default_rng(1).integers(0, 5000, 5000).astype(np.uint32)
    doc_ids, sizes = [None, -5, 3, 3, 1 << 60], [1, 2000, 0, 2990, 9]
    raw = token_files.write_segment(doc_ids, sizes, ids)
    assert token_files.read_segment(raw)[:2] == (doc_ids, sizes)
    assert (token_files.read_segment(raw)[2] == ids).all()
    with pytest.raises(ValueError):
        token_files.read_segment(raw[:-40] + bytes([raw[-40] ^ 1]) + raw[-39:])
    with pytest.raises(ValueError):
        token_files.read_segment(b"NOPE" + raw[4:])
    with pytest.raises(ValueError):
        token_files.write_segment([1], [1], np.array([MOST_ID + 1], np.uint32))


def test_write_and_read(spark, documents, prose, tmp_path, monkeypatch):
    library = Library.from_file(PATH)
    rows = [(97 * k % 61, prose(k, 20 + 30 * (k % 5))) for k in range(61)]
    rows += [(1000, None), (1001, ""), (None, "without id"), (1002, "b"), (1002, "a"), (1003, prose(3, 5000))]
    token_files.write(documents(rows), tokenizer(spark, PATH), str(tmp_path / "t"))
    got = sorted(token_files.read(spark.read.parquet(str(tmp_path / "t"))).collect(), key=lambda r: r.start)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for r, (doc, text) in zip(got, want, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        assert (r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) == (doc, start, ids)
        start += len(ids)


def test_nothing(spark, documents, tmp_path):
    token_files.write(documents([]).filter("false"), tokenizer(spark, PATH), str(tmp_path / "t"))
    assert token_files.read(spark.read.parquet(str(tmp_path / "t"))).collect() == []
