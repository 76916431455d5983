"""The pipeline against a brute-force version, stage by stage, and on odd tables."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Library

import corpus_pipeline
from kerbline.llm import language, near_dedup
from tests.llm.test_dedup import near_expected
from tests.llm.test_language import plain_shares


def test_stages_and_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "packing"]


@pytest.fixture
def table(spark, documents, prose, edited, tmp_path):
    base = prose(1, 150)
    rows = [(k, prose(10 + k, 40)) for k in range(30)] + [(40, base), (41, base + " "), (42, edited(base, 2, "q")), (43, None)]
    rows += [(44, "12 34"), (45, ""), (46, prose(2, 4000)), (46, prose(2, 4000)), (None, prose(77, 40))]
    documents(rows, lang="en").drop("kept", "group").write.parquet(str(tmp_path / "documents.parquet"))
    return rows, str(tmp_path)


def test_run_matches_brute_force(spark, table):
    rows, folder = table
    kept = [(d, t) for d, t in rows if t and re.search(r"[^\W\d_]", t)]
    best = {}
    for k, (d, t) in enumerate(kept):
        key = re.sub(r"\s", "", t)
        best[key] = min(best.get(key, (0, 2**63, 0)), (-len(t), 2**63 if d is None else d, k))
    kept = [kept[k] for *_, k in sorted(best.values(), key=lambda b: b[2])]
    gone = {d for d, _, _, stays in near_expected(kept, 5, 80) if not stays and d != "None"}
    kept = [(d, t) for d, t in kept if str(d) not in gone]
    library = Library.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((str(d), library.encode(t, add_special_tokens=False).ids + [1]) for d, t in kept)
    parts = defaultdict(list)
    for p in corpus_pipeline.run(spark, folder).collect():
        parts[str(p.doc_id)].append((p.start, np.frombuffer(p.ids, "<u4").tolist()))
    assert sorted((d, [i for _, ids in sorted(own) for i in ids]) for d, own in parts.items()) == want


def test_columns_stay(spark, table):
    _, folder = table
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def test_empty_table(spark, documents, tmp_path):
    documents([]).filter("false").drop("kept", "group").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_near_stage_keeps_one_of_each_group(documents, prose, edited):
    base = prose(4, 120)
    docs = documents([(9, base), (3, edited(base, 1, "a")), (5, edited(base, 1, "b")), (1, prose(5, 50)), (None, None)])
    assert sorted(str(r.doc_id) for r in near_dedup.deduplicated(docs).collect()) == ["1", "3", "None"]


@pytest.mark.parametrize("held_out", [False, True])
def test_nothing_to_learn_from(spark, documents, prose, tmp_path, held_out):
    """No label at all, or labels in the held-out fold only."""
    ids = [k for k in range(400) if zlib.crc32(str(k).encode()) % 4 == 2][:20] if held_out else list(range(20))
    rows = [(k, prose(k, 40)) for k in ids] + [(1000, None), (1001, "12 34")]
    docs = documents(rows).drop("kept", "group")
    if held_out:
        docs = docs.withColumn("lang", F.when(F.col("doc_id") < 1000, "en"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    kept = corpus_pipeline.language_id(spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.lang) for r in kept) == [(k, "en" if held_out else None) for k in ids]
    assert {p.doc_id for p in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(ids)


def test_a_language_of_the_name_of_undetermined_text(spark, documents, prose):
    docs = documents([(k, prose(k, 40)) for k in range(20)], lang="und").drop("kept", "group")
    assert corpus_pipeline.language_id(spark, docs, "").count() == 20


def test_language_stage_rejects_by_score(spark, documents, monkeypatch):
    """Three languages of six letters each. Texts in equal parts of all three go, labelled or not, under a threshold of two
    thirds; the network's shares, position by position, say the same."""
    monkeypatch.setattr(corpus_pipeline, "CLEAR_MARGIN", 0.5)
    rng = np.random.default_rng(3)

    def words(letters, count):
        return " ".join("".join(rng.choice(list(letters), 4)) for _ in range(count))

    alphabets = {"aa": "abcdef", "bb": "ghijkl", "cc": "mnopqr"}
    rows = [(k, words(alphabets[lang], 30), lang) for k, lang in enumerate(sorted(alphabets) * 20)]
    rows += [(100 + k, words(alphabets[lang], 30), None) for k, lang in enumerate(sorted(alphabets))]
    held_out = [k for k in range(200, 300) if zlib.crc32(str(k).encode()) % 4 == 2][:2]
    rows += [(k, " ".join(words(a, 20) for a in alphabets.values()), lang) for k, lang in zip(held_out, (None, "aa"))]
    docs = documents([r[:2] for r in rows]).drop("kept", "group", "lang")
    docs = docs.join(spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, lang string"), "doc_id")
    kept = {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    network = language.fit(docs)
    least = corpus_pipeline.least_score(3)
    scores = {k: plain_shares(network, text.encode()).max() for k, text, _ in rows}
    assert all(abs(score - least) > 0.005 for score in scores.values()), sorted(scores.values())[:4]
    assert set(kept) == {k for k, score in scores.items() if score >= least}
    assert set(scores) - set(kept) == set(held_out), [scores[k] for k in held_out]
    assert [kept[100 + k] for k in range(3)] == sorted(alphabets)


def test_least_score():
    assert corpus_pipeline.least_score(1) == 1
    assert corpus_pipeline.least_score(4) == 0.34375
