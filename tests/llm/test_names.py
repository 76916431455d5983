"""Tables whose columns have the names that operators use themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from kerbline.llm import exact_dedup, language
from kerbline.llm.common import free_name
from kerbline.llm.url_rules import judge, site_rule

ROWS = [(1, "the words of one"), (1, "the words of one"), (2, "the words  of one"), (3, "other words"), (4, None)]


def clashing(docs, *names):
    """The documents with text columns of these names, each with its own value."""
    return docs.withColumns({name: F.concat(F.lit(f"{name}:"), F.col("doc_id").cast("string")) for name in names})


def as_they_were(rows, *names):
    return all(row[name] == f"{name}:{row['doc_id']}" for row in rows for name in names)


def test_free_names(spark):
    frame = spark.sql("SELECT 1 AS _x, 2 AS _X_")
    assert free_name(frame, "_x") == "_x__" and free_name(frame, "y") == "y"


def test_urls(spark):
    urls = spark.createDataFrame([(1, "http://a.com/b", "mine"), (2, None, "mine")], "doc_id long, url string, _canonical string")
    found = judge(clashing(urls, "_Canonical_"), [site_rule("com", "/b", "block")]).collect()
    assert [(r.doc_id, r.verdict, r["_canonical"]) for r in found] == [(1, "block", "mine"), (2, "allow", "mine")]
    assert as_they_were(found, "_Canonical_")


def test_exact_duplicates(documents):
    names = ("_digest", "_nth", "_doc_id", "_text_sha256", "members", "size", "digit", "row")
    found = exact_dedup.deduplicated(clashing(documents(ROWS), *names)).collect()
    assert sorted(r.doc_id for r in found) == [2, 3, 4] and as_they_were(found, *names)
    again = exact_dedup.deduplicated(clashing(documents(ROWS[:2] + ROWS[3:]), *names)).collect()
    assert sorted(r.doc_id for r in again) == [1, 3, 4] and as_they_were(again, *names)


def test_languages(spark, documents):
    docs = clashing(documents(ROWS, lang="en"), "_letters", "_LETTERS_", "score_")
    network = language.fit(docs)
    found = language.predict(spark, docs, network).collect()
    assert as_they_were(found, "_letters", "_LETTERS_", "score_") and {r.lang_pred for r in found if r.doc_id < 4} == {"en"}


def test_language_stage_hands_on_what_it_got(spark, documents):
    docs = clashing(documents(ROWS, lang="en"), "_letters", "score", "lang_pred")
    found = corpus_pipeline.language_id(spark, docs, "").collect()
    assert sorted(r.doc_id for r in found) == [1, 1, 2, 3] and as_they_were(found, "_letters", "score", "lang_pred")
