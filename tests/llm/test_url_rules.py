"""URL rules against the reading of their definition, URL by URL."""

from __future__ import annotations

import re

import pytest

from kerbline.llm.queries import SITE_RULES, op1_url_filter
from kerbline.llm.url_rules import Automaton, Rule, judge, site_rule

URLS = [
    None,
    "",
    "no scheme.com/en/",
    "http://example.com/en/x?y=/z",
    "http://EXAMPLE.com/EN/x",
    "https://www.example.com/en/1#f",
    "https://a.www.example.com/en/1",
    "https://notexample.com/en/1",
    "https://example.com",
    "https://example.com/?u=://other.net/es/",
    "ftp://a.b.net/es/",
    "ftp://a.b.net/es",
    "x://net/fr/",
    "x://net:80/fr/",
    "x://evil.org/x.com/en/",
    "http://ü.example.com/en/é",
    "http://\n.com/a\nb",
    "://com/",
    "http:///en/",
    "a://b://c.com/x",
    "http://example.com/" + "long/" * 3000,
]


def expected(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for own, start, verdict in SITE_RULES:
        if (host == own or host.endswith("." + own)) and path.startswith(start):
            if best is None or len(own + start) > len(best[0]):
                best = (own + start, verdict)
    return host, path, best and best[0], best[1] if best else "allow"


def test_matches_definition(spark):
    rows = [(k, u, "mine") for k, u in enumerate(URLS * 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    got = judge(df, [site_rule(*r) for r in SITE_RULES]).collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [expected(r.url) for r in got]
    assert len(got) == 2 * len(URLS)


def test_no_rules_and_no_rows(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [(r.rule, r.verdict) for r in judge(df, [], default="block").collect()] == [(None, "block")]
    assert judge(df.filter("false"), [site_rule("com", "/", "allow")]).collect() == []


@pytest.mark.parametrize("words", [1, 3])
def test_globs_of_many_words(words):
    """Patterns that span several 64-bit words, with every wildcard."""
    import numpy as np

    globs = ["*.a?c/**/end", "**" + "x" * 70 * words, "*" * 2 + "é?*z", "plain", "?", "**"]
    texts = [".abc/q/w/end", "y" * 5 + "x" * 70 * words, "éaz", "plain", "p", "/", "", ".a/c/x/end", ".abc/end"]

    def pattern(glob):
        found = re.escape(glob.encode()).replace(rb"\*\*", b"(?s:.)*").replace(rb"\*", b"[^/]*").replace(rb"\?", b"[^/]")
        return re.compile(found)

    automaton = Automaton([Rule(str(k), g, "x") for k, g in enumerate(globs)])
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    got = automaton.fits(np.frombuffer(b"".join(raw), np.uint8), offsets)
    names = [automaton.rules[k].name if k >= 0 else None for k in got]
    want = [next((str(k) for k, g in enumerate(globs) if pattern(g).fullmatch(t)), None) for t in raw]
    assert names == want


def test_query(spark, sf_dir):
    got = op1_url_filter(spark, sf_dir)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"] and got.count() == got.select("page_id").distinct().count()
