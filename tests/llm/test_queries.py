"""The registered queries: SQL counterparts, names, and results that cover their whole tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import oracle_sql, queries
from kerbline.llm import queries as corpus
from tests.compare import differences, open_tables


def test_all_are_registered():
    assert set(corpus.QUERIES) | {"pipeline"} <= set(queries())
    assert [int(name[2:].split("_")[0]) for name in corpus.QUERIES] == list(range(1, 14))
    assert set(corpus.ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(corpus.ORACLE))
def test_matches_sql(spark, sf_dir, name):
    _, found = differences(spark, open_tables(sf_dir), corpus.QUERIES[name], corpus.ORACLE[name], sf_dir)
    assert not found


@pytest.mark.parametrize("name", ["op3_packing", "op6_quotes", "op7_token_files", "op8_sharding", "op9_wfst"])
def test_covers_its_table(spark, sf_dir, name):
    key = ["conv_id", "turn"] if name == "op6_quotes" else ["doc_id"]
    table = "conversations" if name == "op6_quotes" else "documents"
    got = corpus.QUERIES[name](spark, sf_dir).select(*key).distinct()
    assert got.count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*key).distinct().count()
