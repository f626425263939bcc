"""Shapes of the plans that matter at scale."""

import pytest
from conftest import SMOKE
from pyspark.sql import functions as F

from aeropanel.catalog import queries as registered
from aeropanel.operators import clean as cleaning
from aeropanel.operators import trends

EAGER = {"report_outputs", "linear_regression", "decision_tree", "random_forest", "gradient_boosted_trees",
         "model_comparison", "feature_importances", "actual_vs_predicted", "scored_rows", "model_summary",
         "tree_nodes", "tree_scores_by_nodes", "forest_scores_by_nodes", "boosted_scores_by_nodes"}
QUERIES = registered.all_queries()
LAZY = sorted(set(QUERIES) - EAGER)
#: Arrow batches reduced to one row per pair and task.
ARROW = {"corr_matrix"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SMOKE))
    for bad in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
    assert plan.count("MapInArrow") == (name in ARROW)


#: Scans of the fact table, removals of copies and exchanges in the plan; what was written before is not in it.
SHAPES = {
    "city_ranking": (1, 1), "clean_panel": (1, 1), "cleaning_funnel": (2, 1), "day_snapshot": (1, 0), "month_grid": (2, 1),
    "day_summary": (2, 2), "city_year_stats": (1, 1), "city_extremes": (1, 1), "city_profiles": (0, 0),
    "overview_document": (1, 0), "dashboard_document": (1, 0), "yearly_fixed": (1, 1), "null_profile": (1, 0)}


@pytest.mark.parametrize("name", sorted(SHAPES))
def test_scans_and_removals_of_copies(spark, name):
    plan = plan_of(QUERIES[name](spark, SMOKE))
    scans = sum("FileScan parquet [o_" in line for line in plan.splitlines())
    removals = plan.count("row_number(), 1, Final")
    assert (scans, removals) == SHAPES[name]


PANEL = ["city_extremes", "city_year_stats", "city_extreme_months", "extreme_months", "fullest_year", "city_base", "city_rank",
         "city_ranking", "monthly", "yearly", "seasonal", "diagnose", "period_comparison", "month_grid", "dominant_share"]


@pytest.mark.parametrize("name", PANEL)
def test_groups_are_hashed_not_sorted(spark, name):
    assert "SortAggregate(key=[" not in plan_of(QUERIES[name](spark, SMOKE))


def test_equal_values_are_ranked_in_many_tasks(spark):
    from aeropanel.operators.ranking import with_rank
    n = 40_000
    rows = spark.range(n).selectExpr("CASE WHEN id % 50 = 0 THEN CAST(id AS DOUBLE) ELSE 7.0D END AS v", "concat('c', id) AS name")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = with_rank(rows, "v", ["name"])
        per_task = [r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    want = rows.selectExpr("*", "CAST(row_number() OVER (ORDER BY v DESC, name) AS INT) AS rank")
    assert ranked.select(*want.columns).exceptAll(want).isEmpty() and ranked.count() == n
    assert max(per_task) <= 4 * n / 8


def test_copies_are_limited_before_the_shuffle(spark):
    plan = plan_of(registered.clean_panel(spark, SMOKE))
    before, after = plan.index("Exchange hashpartitioning(City"), plan.index("row_number(), 1, Partial")
    assert "row_number(), 1, Final" in plan and before < after


def test_only_needed_columns_are_shuffled(spark):
    plan = plan_of(trends.monthly(registered.clean_panel(spark, SMOKE)))
    assert "Xylene" not in plan and "NO2" not in plan


def test_a_period_reads_only_its_days(spark, clean, tmp_path):
    path = str(tmp_path / "clean")
    clean.write.parquet(path)
    df = trends.period_comparison(spark.read.parquet(path), ("1999-03-25", "1999-05-31"), ("2000-03-25", "2000-05-31"))
    scan = [line for line in plan_of(df).splitlines() if "FileScan" in line][0]
    assert "GreaterThanOrEqual(Date,1999-03-25)" in scan
    assert "ReadSchema: struct<City:string,Date:date,PM25:double,NO2:double,AQI:double>" in scan


def test_the_panel_is_shuffled_once_for_a_fixed_city_trend(spark):
    plan = plan_of(trends.yearly_fixed(registered.clean_panel(spark, SMOKE), 7))
    by_city = [line for line in plan.splitlines() if "Exchange hashpartitioning(City#" in line]
    assert sum("Date#" in line for line in by_city) == 1 and plan.count("FileScan parquet [o_orderkey") == 1


def test_rolling_windows_share_one_shuffle(spark):
    from aeropanel.operators import hourly
    from aeropanel.sources import driver_tables as given
    hours = given.hourly(spark, SMOKE)
    plan = plan_of(hourly.rolling_index(hours))
    by_block = [line for line in plan.splitlines() if "Exchange" in line and "block#" in line]
    assert len(by_block) == 1


def test_survivor_filter_on_city_reaches_below_the_dedup(spark, clean, tmp_path):
    path = str(tmp_path / "raw")
    clean.write.parquet(path)
    one = cleaning.dedup_city_day(spark.read.parquet(path), ["k"]).filter("City = 'NATION_1'")
    assert "EqualTo(City,NATION_1)" in plan_of(one)


def test_models_read_the_raw_rows_once(spark):
    """What scores the test rows reads the panel that was written, not the orders again."""
    plan = QUERIES["linear_regression"](spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    assert "o_orderkey" not in plan and "Join" not in plan
