"""Counts and line rules against a plain reading of every text."""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kerbline.llm import line_quality as Q
from kerbline.llm.common import utf8

SPACE = r"[^\x20\x09-\x0D]+"


def plain(text):
    text = text or ""
    words = re.findall(SPACE, text)
    threes = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(threes)
    covered = {k + j for k, three in enumerate(threes) if often[three] > 1 for j in range(3)}
    found = {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": 0,
        "n_repeat_words": len(covered),
    }
    rules, lost, rest, seen = dict.fromkeys(Q.RULES, 0), 0, [], set()
    for line in text.split("\n"):
        own = re.findall(SPACE, line)
        noise = sum(line.count(c) for c in "#*$%&|<>!?")
        parts = sum(word in Q.SEPARATORS for word in own)
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), line)
        broken = {
            "punctuation": noise > len(own) and noise >= 3,
            "navigation": parts > 1 and 5 * parts >= len(own),
            "boilerplate": line in seen
            or any(p in lower for p in Q.PHRASES)
            or 2 * sum(a == b for a, b in zip(own, own[1:])) > len(own),
        }
        found["n_dup_lines"] += bool(own) and line in seen
        seen.add(line)
        if not own:
            broken = {}
        for rule, is_broken in broken.items():
            rules[rule] += is_broken
        if any(broken.values()):
            lost += len(own)
        else:
            rest.append(line)
    found["base_failed"] = len(words) < 50 or 2 * len(covered) > len(words)
    found["kept"] = not found["base_failed"] and 2 * lost <= len(words)
    found |= {f"{rule}_lines": n for rule, n in rules.items()} | {"lost_words": lost, "cleaned": "\n".join(rest)}
    return found


def check(texts):
    found = Q._judged(*utf8(pa.array(texts, pa.string())), Q.SCHEMA.names)
    for k, text in enumerate(texts):
        mine = {name: found[name][k].as_py() if name == "cleaned" else found[name][k].item() for name in Q.SCHEMA.names}
        assert mine == plain(text), repr(text)


TEXTS = [
    None,
    "",
    "\n",
    "\n\n a \n",
    "one",
    "a b c a b c",
    "x x x x x x\nplain words of a line\n",
    "Home | News | About\nA sentence that stays.\nHome | News | About",
    "Privacy Policy of this site\nkept\nPRIVACY\nPOLICY",
    "Wow!!! So!!! Much!!!\nis it? yes! no!",
    "été % & über <b> $5\r\nété\x0b\x0cété﻿",
    "same line\nsame line\n  \n  \nsame line ",
    " ".join(f"w{k}" for k in range(60)) + "\n" + "| ".join(f"m{k} " for k in range(50)),
    " ".join(["The", "same", "three"] * 30),
    "\n".join(f"line {k} has its own five words" for k in range(20)),
]


def test_texts_together_and_alone():
    check(TEXTS)
    for text in TEXTS:
        check([text])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab|!%é\n \t·")), max_size=60), max_size=6))
def test_any_texts(texts):
    check(texts)


def test_verdicts(spark, documents):
    clean = "\n".join(f"paragraph {k} tells of river{k} and stone{k}, as it should." for k in range(12))
    shout = " ".join(f"WORD{k}!!" for k in range(80))
    menu = " | ".join(f"entry{k}" for k in range(60))
    rows = [(1, clean), (2, shout), (3, menu), (4, clean + "\n" + shout[:200]), (5, "short"), (6, None), (None, clean)]
    got = {r.doc_id: r for r in Q.judged(documents(rows)).collect()}
    assert {d: r.kept for d, r in got.items()} == {1: True, 2: False, 3: False, 4: True, 5: False, 6: False, None: True}
    assert got[4].cleaned == clean and got[4].text.endswith(shout[:200]) and got[1].cleaned == clean
    assert got[1].group == 7 and got[3].navigation_lines == 1 and got[2].punctuation_lines == 1


def test_columns_that_clash(documents):
    rows = documents([(1, "a b")])
    found = Q.judged(rows, results=["kept", "n_words"])
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "group", "kept", "n_words"]
    assert found.head().kept is False


def test_long_texts_and_none(documents):
    words = [f"w{k % 5003}é" for k in range(300_000)]
    text = " ".join(words[:150_000]) + "\n" + " ".join(words[150_000:])
    row = Q.judged(documents([(1, text), (2, text)]), results=["n_words", "word_chars", "n_repeat_words"]).collect()
    assert {(r.n_words, r.word_chars) for r in row} == {(300_000, sum(map(len, words)))}
    assert row[0].n_repeat_words == 300_000
    assert Q.judged(documents([(1, "x")]).where("false")).collect() == []


@pytest.mark.parametrize("copies", [1, 3])
def test_repeated_rows(documents, copies):
    rows = Q.judged(documents([(1, "a b c")] * copies)).collect()
    assert len(rows) == copies and len(set(rows)) == 1
