"""Registered queries against their SQL on the smallest tables.

A representative part runs by default; set THREADLOOM_ALL=1 for every query.
"""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
QUICK = [
    "clean_text", "adversarial", "brand_posts", "thread_summaries", "thread_pages", "rule_escalation_word", "three_phase",
    "weak_labels", "per_class_prf", "system_comparison", "judge_by_difficulty", "cohen_kappa", "stratified_sample", "cv_folds",
    "dense_topk_exclude_self", "tfidf_weights", "tfidf_top1", "silhouette_fixed_labels", "grounding_context", "classify_prompts",
    "response_parse", "judge_answers", "model_calls", "triage_rows", "csv_roundtrip", "taxonomy_explode", "materialize_once",
]
NAMES = sorted(contract.oracle_sql()) if os.environ.get("THREADLOOM_ALL") else QUICK
needs_data = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


@needs_data
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    names = sorted(frame.columns)
    cursor = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == names
    expected = [tuple(plain(row[columns.index(n)]) for n in names) for row in cursor.fetchall()]
    got = [tuple(plain(row[n]) for n in names) for row in frame.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


@needs_data
def test_entry(spark):
    assert contract.entry(spark).columns == ["decision", "trigger", "n"]


def test_every_check_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
