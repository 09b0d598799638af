"""The checked queries on given tables where one user and one conversation hold a third of the rows."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tests.compare import TABLES, connect, difference

SF = "/root/testdata/sf0.01"

SKEWED = {
    "conversations": "SELECT CASE WHEN hash(conv_id, turn) % 3 = 0 THEN 7 ELSE conv_id END AS conv_id, * EXCLUDE (conv_id)",
    "events": "SELECT CASE WHEN hash(event_id) % 3 = 0 THEN 8 ELSE user_id END AS user_id, * EXCLUDE (user_id)",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for name in TABLES:
        columns = SKEWED.get(name, "SELECT *")
        duckdb.sql(f"COPY ({columns} FROM '{SF}/{name}.parquet') TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", [
    "user_rollup", "user_rollup_latest_feedback", "run_totals", "feedback_asof", "asof_simple", "last_exchange", "last_exchange_cell",
    "feedback_table", "match_stats", "typed_user_table", "user_questions", "question_count", "question_coverage", "turn_count_text", "tokens_by_role", "feedback_answers",
])
def test_skewed(spark, skewed, name):
    result = queries()[name](spark, skewed)
    assert difference(result, connect(skewed), oracle_sql()[name]) is None
    if name == "user_rollup":
        assert result.where("parte > 0").count() > 0
