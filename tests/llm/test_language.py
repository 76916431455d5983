"""Gradients, whole-text reading and held-out accuracy of the network."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from kerbline.llm import language
from kerbline.llm.common import utf8
from kerbline.llm.queries import op10_language


@pytest.fixture(scope="module")
def network():
    fresh = language.Network.fresh(["a", "b", "c"], hidden=5)
    fresh.weights = {k: v.astype(np.float64) for k, v in fresh.weights.items()}
    return fresh


def test_gradients_are_those_of_the_loss(network, monkeypatch):
    monkeypatch.setattr(language, "F32", np.float64)
    rng = np.random.default_rng(0)
    data, label = rng.integers(97, 105, (9, 4)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, found = network.gradients(data, label)
    for name, weight in network.weights.items():
        for at in [tuple(rng.integers(0, n) for n in weight.shape) for _ in range(6)] + ([(99, 3)] if name.endswith("_in") else []):
            kept, step = weight[at], 1e-5
            weight[at] = kept + step
            up = network.gradients(data, label)[0]
            weight[at] = kept - step
            down = network.gradients(data, label)[0]
            weight[at] = kept
            assert found[name][at] == pytest.approx((up - down) / (2 * step), abs=2e-7)


def plain_shares(network, raw):
    """Position by position, over the same windows and margins."""
    total = np.zeros(3)
    squash = lambda x: x / (1 + abs(x))
    for start in range(0, len(raw), language.WINDOW):
        end = min(len(raw), start + language.WINDOW)
        states = {}
        for way in "fb":
            w = network.weights
            n = len(w[f"{way}_own"])
            state = np.zeros(n)
            # The margins are read in both directions; outside the text there is nothing but the state's own pull.
            steps = range(start - language.MARGIN, end + language.MARGIN)
            for t in steps if way == "f" else reversed(steps):
                x = w[f"{way}_in"][raw[t]] + w[f"{way}_bias"] if 0 <= t < len(raw) else np.zeros(3 * n)
                own = state @ w[f"{way}_own"]
                update, reset = (0.5 + 0.5 * squash(x[k * n : k * n + n] + own[k * n : k * n + n]) for k in (0, 1))
                candidate = squash(x[2 * n :] + reset * own[2 * n :])
                state = update * state + (1 - update) * candidate
                states[way, t] = state
        for t in range(start, end):
            logits = np.concatenate([states["f", t], states["b", t]]) @ network.weights["out"] + network.weights["out_bias"]
            share = np.exp(logits - logits.max())
            total += share / share.sum()
    return total / max(1, len(raw))


def test_whole_texts_are_read(network):
    texts = ["abc", "", "héllo wörld", "x" * language.WINDOW, "hgfedcba" * 150]
    shares = language.Reader(network).shares(*utf8(pa.array(texts)))
    for text, share in zip(texts, shares):
        assert share == pytest.approx(plain_shares(network, text.encode()), abs=1e-5)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    got = op10_language(spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.97


def test_odd_rows(spark, documents):
    rows = [(k, f"the words of number {'abcdefg'[k % 7]} are here") for k in range(30)]
    rows += [(100, None), (101, ""), (102, "12 34 !?"), (None, "the words"), (1, "the words again")]
    docs = documents(rows, lang="en")
    fitted = language.fit(docs)
    got = language.predict(spark, docs.withColumn("score", docs.source), fitted).collect()
    assert fitted.languages == ["en"] and len(got) == len(rows)
    assert {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id in (100, 101, 102)} == {k: ("und", 0.0) for k in (100, 101, 102)}
    assert all(r.lang_pred == "en" and r.score == pytest.approx(1) for r in got if r.doc_id not in (100, 101, 102))
    unlabelled = documents(rows)
    assert language.fit(unlabelled) is None
    assert {r.lang_pred for r in language.predict(spark, unlabelled, None).collect()} == {"und"}
    assert language.predict(spark, docs.filter("false"), fitted).collect() == []
