"""Quotation linking on conversations small enough to follow by eye, and against a walk through the tree."""

from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from kerbline.llm.quotes import links, parse, parsed, passage_key, reply_ordered

SCHEMA = "conv_id long, turn long, role string, text string, position string"


def run(spark, rows):
    full = [(c, t, "user", text, "x") for c, t, text in rows]
    return reply_ordered(spark.createDataFrame(full, SCHEMA)).collect()


def test_parse_levels():
    own, keys, quotes = parse("> > old  words\n>> more\n> newer\n\nMy ANSWER\r\nin two lines\n>late")
    assert own == "My ANSWER\nin two lines"
    assert set(keys) == {passage_key(p) for p in ("my answer in two lines", "My answer", "IN two\tlines")}
    levels = {key: level for level, key in quotes}
    assert levels[passage_key("old words more")] == levels[passage_key("old words")] == levels[passage_key("more")] == 2
    assert levels[passage_key("newer")] == levels[passage_key("late")] == 1 and len(levels) == 5
    assert parse("") == ("", [], []) and parse("> \n>") == ("", [], []) and parse("a > b")[2] == []


def test_reply_order(spark):
    rows = [
        (1, 0, "Opening words here"),
        (1, 1, "Second message"),
        (1, 2, "Third message\n\nwith two passages"),
        (1, 3, "> opening  WORDS here\nAbout the first"),
        (1, 4, "> with two passages\nAbout the third"),
        (1, 5, "> > Opening words here\n> About the first\nAbout the fourth"),
        (2, 0, "> About the third\nFrom elsewhere"),
        (2, 1, "> nobody said this\nnext"),
    ]
    got = {(r.conv_id, r.turn): r for r in run(spark, rows)}
    order = [t for _, t in sorted((r.position, r.turn) for r in got.values() if r.conv_id == 1)]
    assert order == [0, 1, 2, 4, 3, 5] and [got[1, t].reply_to for t in range(6)] == [None, 0, 1, 0, 2, 3]
    assert got[1, 3].text == "About the first" and (got[2, 0].source_conv, got[2, 0].source_turn) == (1, 4)
    assert got[2, 0].reply_to is None and got[2, 1].reply_to == 0 and got[2, 1].source_conv is None


def test_odd_rows(spark):
    rows = [(None, None, None), (None, 1, ""), (None, 1, ""), (3, 5, "a"), (3, None, "b"), (3, 9, "> a\nc"), (3, 9, "> a\nc")]
    got = run(spark, rows)
    assert sorted(r.position for r in got if r.conv_id is None) == [0, 1, 2]
    assert sorted(r.position for r in got if r.conv_id == 3) == [0, 1, 2, 3]
    assert {r.reply_to for r in got if r.turn == 9} == {5}
    assert reply_ordered(spark.createDataFrame([], SCHEMA)).collect() == []


def walk(parents):
    """Turns of a tree in reply order: a reply's own course first, branches off it from the latest on."""
    children = {}
    for turn, parent in enumerate(parents):
        children.setdefault(parent, []).append(turn)
    out, stack = [], [0]
    while stack:
        turn = stack.pop()
        out.append(turn)
        stack += sorted(children.get(turn, []), reverse=True)
    return out


def test_walk_through_many_trees(spark):
    draw = random.Random(4)
    rows, want = [], {}
    for conv in range(12):
        parents = [None]
        for turn in range(1, 25):
            parents.append(draw.randrange(turn) if draw.random() < 0.5 else turn - 1)
        rows.append((conv, 0, f"words {conv} 0"))
        for turn in range(1, 25):
            quote = f"> words {conv} {parents[turn]}\n" if parents[turn] != turn - 1 or draw.random() < 0.5 else ""
            rows.append((conv, turn, f"{quote}words {conv} {turn}"))
        want[conv] = walk(parents)
    got = run(spark, rows)
    for conv in want:
        assert [t for _, t in sorted((r.position, r.turn) for r in got if r.conv_id == conv)] == want[conv]


def test_a_deep_chain_of_branches(spark):
    """Each of 5,000 turns answers the one before the last, so branches nest as deep as half of them; and a star."""
    parents = [None, 0, *range(3998), *([3] * 1000)]
    rows = [(7, 0, "words 0")] + [(7, t, f"> words {parents[t]}\nwords {t}") for t in range(1, len(parents))]
    got = run(spark, rows)
    assert len(got) == 5000 and [t for _, t in sorted((r.position, r.turn) for r in got)] == walk(parents)


def test_a_passage_that_all_have(spark):
    rows = [(c, t, "hello" if t == 0 else f"> hello\nfrom {c}") for c in range(200) for t in range(2)]
    got = run(spark, rows)
    assert len(got) == 400 and all(r.reply_to == 0 and r.source_conv in (None, 0) for r in got if r.turn == 1)


def test_a_passage_that_the_least_conversation_has_too_late(spark):
    rows = [(1, 0, "> thanks\n\nthanks"), (2, 0, "thanks"), (2, 1, "> thanks"), (3, 5, "Thanks"), (4, 0, "> alone\n\nalone")]
    rows += [(1, 1, "> thanks\nlater")]
    got = {(r.conv_id, r.turn): (r.source_conv, r.source_turn) for r in run(spark, rows)}
    assert got[1, 0] == (2, 0) and got[2, 1] == (1, 0) and got[4, 0] == (None, None)
    assert got[1, 1] == (None, None)  # its own conversation had it before


def test_ranks_are_limited_before_the_shuffle(spark):
    rows = spark.createDataFrame([(1, 0, "user", "> a\n\na", "x"), (2, 0, "user", "a", "x")], SCHEMA)
    firsts = spark.range(10).selectExpr("id % 3 AS key", "id AS conv")
    rank = F.row_number().over(Window.partitionBy("key").orderBy("conv"))
    plan = firsts.withColumn("rank", rank).filter("rank <= 2")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert links(parsed(rows)).filter("source.conv = 2").count() == 1
