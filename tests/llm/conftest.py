from __future__ import annotations

import numpy as np
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and red fox jumps over lazy dog near river bank while seven grey geese fly south again tonight".split()


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with the other columns of the table and one with a clashing name."""

    def build(rows, **more):
        full = [(i, t, more.get("lang"), "src", 0, "x", 7) for i, t in rows]
        extra = ", kept string, group long"
        return spark.createDataFrame(full, SCHEMA + extra)

    return build


@pytest.fixture
def prose():
    """`n` words drawn by a seed."""

    def text(seed: int, n: int) -> str:
        rng = np.random.default_rng(seed)
        return " ".join(f"{WORDS[a]}{b}" for a, b in zip(rng.integers(0, len(WORDS), n), rng.integers(0, 40, n)))

    return text


@pytest.fixture
def edited():
    """The text with `k` words replaced, spread out."""

    def change(text: str, k: int, tag: str) -> str:
        words = text.split(" ")
        for j in range(k):
            words[(j * 37 + len(tag) * 11 + sum(map(ord, tag))) % len(words)] = f"{tag}{j}"
        return " ".join(words)

    return change
