"""Manifest trees and proofs against a plain recursion."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from kerbline.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climbed(leaves, fanout):
    """Root, and for each leaf the (left, right) siblings of its path."""
    nodes, paths, owners = list(leaves), [[] for _ in leaves], [[k] for k in range(len(leaves))]
    while len(nodes) > 1:
        above, kept = [], []
        for at in range(0, len(nodes), fanout):
            run = nodes[at : at + fanout]
            for place in range(len(run)):
                for leaf in owners[at + place]:
                    paths[leaf].append(("".join(run[:place]), "".join(run[place + 1 :])))
            above.append(h(*run))
            kept.append([leaf for owned in owners[at : at + fanout] for leaf in owned])
        nodes, owners = above, kept
    return nodes[0], paths


def expected(rows, fanout):
    """(order, leaf) to (subroot, root, path) of (group, order, leaf) rows."""
    groups = {}
    for group, order, leaf in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2])):
        groups.setdefault(group, []).append((order, leaf))
    trees = {g: climbed([leaf for _, leaf in members], fanout) for g, members in groups.items()}
    root, tops = climbed([tree[0] for tree in trees.values()], fanout)
    return sorted(
        (str(order), leaf, trees[g][0], root, tuple(trees[g][1][k] + tops[place]))
        for place, (g, members) in enumerate(groups.items())
        for k, (order, leaf) in enumerate(members)
    )


def table(spark, rows):
    frame = spark.createDataFrame(rows, "lang string, doc_id long, leaf string")
    # Names that the operator uses itself.
    return frame.withColumns({"node": F.lit(1), "group": F.lit("x"), "number": F.lit(2), "steps": F.lit("theirs"), "block": F.lit(3)})


CASES = {
    "uneven": [("de", k, h("d", str(k))) for k in range(11)] + [("en", k, h("e", str(k))) for k in range(1)] + [(None, 5, h("n"))],
    "ties": [("en", 1, h("a")), ("en", 1, h("a")), ("en", 1, h("b")), ("en", None, h("c")), ("", 2, h("d"))],
    "one": [("en", 7, h("only"))],
    "deep": [("en", k, h(str(k))) for k in range(70)] + [(f"l{k:02}", 1, h("l", str(k))) for k in range(9)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("fanout", [2, 3])
def test_trees_and_proofs(spark, monkeypatch, name, fanout):
    monkeypatch.setattr(merkle, "BLOCK_ROWS", 8)
    rows = CASES[name]
    got = merkle.proofs(table(spark, rows), leaf="leaf", group="lang", order="doc_id", fanout=fanout)
    assert {"node", "group", "number", "block", "steps"} <= set(got.columns)
    folded = got.withColumn("folded", merkle.folded(F.col("leaf"), F.col("steps"))).collect()
    assert all(r.folded == r.root for r in folded)
    found = sorted(
        (str(r.doc_id), r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.steps)) for r in folded
    )
    assert found == expected(rows, fanout)


def test_a_changed_leaf_does_not_verify(spark):
    rows = table(spark, CASES["uneven"])
    got = merkle.proofs(rows, leaf="leaf", group="lang", order="doc_id")
    wrong = got.withColumn("folded", merkle.folded(F.lit(h("other")), F.col("steps")))
    assert wrong.where("folded = root").count() == 0


def test_fields(spark):
    row = spark.sql("SELECT CAST(NULL AS STRING) a, 'é' b, -12L c, '' d")
    found = row.select(*(merkle.field(F.col(c)).alias(c) for c in row.columns)).head()
    assert tuple(found) == ("-", "2:é", "3:-12", "0:")
    assert row.select(merkle.digest(*(merkle.field(F.col(c)) for c in row.columns)).alias("x")).head().x == h("-", "2:é", "3:-12", "0:")


def test_nothing(spark):
    empty = table(spark, CASES["one"]).where("false")
    assert merkle.proofs(empty, leaf="leaf", group="lang", order="doc_id").collect() == []


def test_very_long_text_is_one_field(spark):
    text = "ä" * 400_000
    row = spark.createDataFrame([(text,)], "text string").select(merkle.digest(merkle.field(F.col("text"))).alias("x")).head()
    assert row.x == h(f"{2 * len(text)}:", text)
