"""The registered queries for training data: SQL where there is one, and the
test that stands for it where there is none."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

from conftest import SF_SMALL
from test_oracle import assert_matches_sql, duck_tables
from trendflow.llm import catalog, secret_scan

#: Queries that SQL does not express, and where they are compared instead.
WITHOUT_SQL = {
    "op1_embedding_dedup": "test_embedding_dedup.py (all pairs)",
    "op2_packing": "test_llm_cases.py (round trip)",
    "op3_secret_scan": "test_llm_cases.py (labelled cases)",
    "op4_chat_format": "test_llm_cases.py (round trip)",
    "op5_url_filter": "test_llm_cases.py (rules and planted branches)",
    "op6_ngram_join": "test_llm_cases.py (all pairs)",
    "op7_quality_rules": "test_llm_cases.py (plain counts, planted accuracies)",
    "op8_mixing": "test_llm_cases.py (targets)",
    "op10_html_text": "test_llm_cases.py (pages and their text)",
}


def test_every_query_is_compared():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL) | set(WITHOUT_SQL)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    assert_matches_sql(spark, duck_tables(), name)


def test_scan_in_a_session_that_observed(spark):
    """An observation leaves something in the session that tasks cannot take."""
    seen = Observation("any")
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 5
    docs = spark.createDataFrame([(1, 'password = "x8Kq2Lm9Zr4Tv7Wy"', "src"), (2, "plain words only", "src")], "doc_id long, text string, source string")
    assert secret_scan.findings(docs).count() >= 1
    assert "x8Kq2Lm9Zr4Tv7Wy" not in secret_scan.redact(docs).where("doc_id = 1").first().text
