"""Every registered query against its SQL on the whole tables."""

import pytest
from compare import differences
from conftest import CHECK, SMOKE

import __spark_entry__ as entry_points
from aeropanel.catalog import oracle, queries

QUERIES, SQL = queries.all_queries(), oracle.all_sql()


def test_every_sql_text_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries()) and set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, CHECK), duck, SQL[name]) == []


def test_entry_gives_rows(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["City", "avg_aqi", "avg_pm25", "days"]
    assert df.count() == 25


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {
    "linear_regression", "decision_tree", "random_forest", "gradient_boosted_trees", "model_comparison",
    "feature_importances", "actual_vs_predicted", "scored_rows", "model_summary", "report_outputs"}))
def test_queries_without_sql_give_rows(spark, name):
    assert QUERIES[name](spark, SMOKE).count() > 0
