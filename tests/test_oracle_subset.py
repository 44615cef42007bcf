"""A subset of the driver contract at sf0.001: Spark query vs its DuckDB twin."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import TABLES, digest  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = ["benchmark_word_ratio", "phrase_spans", "props_parse", "word_scores", "classification_report",
         "tune_rule", "group_split", "early_stop", "softmax_pool_token", "rationale_ce"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rel = con.sql(entry.oracle_sql()[name])
    s_cols, d_cols = df.columns, rel.columns
    assert sorted(s_cols) == sorted(d_cols)
    s_rows, d_rows = [tuple(r) for r in df.collect()], rel.fetchall()
    assert len(s_rows) == len(d_rows)
    assert digest(s_cols, s_rows)[0] == digest(d_cols, d_rows)[0]
