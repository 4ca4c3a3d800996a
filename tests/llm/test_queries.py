"""Registered corpus queries against their SQL, and that each covers its whole table."""

import pytest

from checks import compare
from tallyport.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}
    assert set(ORACLE) < set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, monkeypatch, name):
    monkeypatch.setattr(compare, "QUERIES", QUERIES)
    monkeypatch.setattr(compare, "ORACLE", ORACLE)
    assert compare.differences(spark, compare.connect(SF_DIR), SF_DIR, name) is None


@pytest.mark.parametrize("name", ["op1_licenses", "op4_mixing", "op5_secrets", "op6_toxicity"])
def test_query_covers_all_documents(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(r.doc_id for r in found.select("doc_id").collect()) == sorted(
        r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect())
