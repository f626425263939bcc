"""Models: split, imputation without leakage, quality, and summaries."""

import duckdb
import numpy as np
import pytest
from conftest import SMOKE
from hypothesis import given as given_any
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aeropanel.operators import clean as cleaning
from aeropanel.operators import least_squares, ml, selection, tree_tables
from aeropanel.schema import POLLUTANTS
from aeropanel.sources import driver_tables as given
from aeropanel.sources import tables


@pytest.fixture(scope="module")
def small(spark):
    panel = cleaning.clean(given.city_day(spark, SMOKE), ["k"]).persist()
    yield panel
    panel.unpersist()


@pytest.fixture(scope="module")
def fitted(small):
    return ml.study(small)


def test_split_is_disjoint_complete_and_stable(clean):
    frame = ml.ml_frame(clean)
    train, test = ml.split(frame)
    other, _ = ml.split(frame.repartition(11, "AQI"))
    assert train.count() + test.count() == frame.count()
    assert train.join(test, ["City", "Date"], "left_semi").isEmpty()
    assert train.exceptAll(other).isEmpty()
    assert 0.77 < train.count() / frame.count() < 0.83


def test_medians_are_exact_and_come_from_the_training_rows(clean):
    train, _ = ml.split(ml.ml_frame(clean))
    exact = train.agg(*(F.percentile(p, F.lit(0.5)).alias(p) for p in POLLUTANTS)).first()
    assert selection.medians(train, POLLUTANTS) == exact.asDict()
    assert selection.medians(train, POLLUTANTS, steps=2) == exact.asDict()


numbers = st.one_of(st.none(), st.just(float("nan")), st.floats(-1e308, 1e308), st.sampled_from([0.0, 1.0, 1.0, 2.5, -7.0, 5e-324, 1e-300]))


@settings(max_examples=15, deadline=None)
@given_any(st.lists(st.tuples(numbers, numbers), max_size=40))
def test_medians_of_any_numbers(spark, rows):
    found = selection.medians(spark.createDataFrame(rows, "a double, b double"), ["a", "b"], steps=7)
    for i, c in enumerate("ab"):
        kept = sorted(r[i] for r in rows if r[i] is not None and r[i] == r[i])
        assert found[c] == (kept[(len(kept) - 1) // 2] / 2 + kept[len(kept) // 2] / 2 if kept else None)


def test_ranked_values(spark):
    df = spark.range(0, 1000).selectExpr("CAST(id * 37 % 1000 AS double) AS x", "CAST(NULL AS double) AS y")
    assert selection.ranked_values(df, {"x": [0, 0.1, 0.5, 1], "y": [0.5]}) == {"x": [0, 99, 499, 999], "y": [None]}


def test_a_column_without_readings_is_imputed_with_0(spark):
    rows = tables.ad_hoc_rows(spark, [(None,) * 12, (None, *range(1, 12))]).withColumn("AQI", F.lit(1.0))
    out = ml.prepare(rows).transform(rows).select("PM25_imp", "PM10_imp").collect()
    assert [tuple(r) for r in out] == [(0.0, 1.0), (0.0, 1.0)]


def test_samples_have_the_exact_size_and_do_not_depend_on_partitions(clean):
    frame = ml.ml_frame(clean)
    n = frame.count()
    for fraction in (0.0, 0.1, 0.37, 1.0):
        sample = selection.sample_exactly(frame, ["City", "Date"], fraction, 3)
        assert sample.count() == int(n * fraction + 0.5)
        assert sample.exceptAll(selection.sample_exactly(frame.repartition(7), ["City", "Date"], fraction, 3)).isEmpty()
    other = selection.sample_exactly(frame, ["City", "Date"], 0.1, 4)
    assert not other.exceptAll(selection.sample_exactly(frame, ["City", "Date"], 0.1, 3)).isEmpty()
    assert selection.sample_exactly(frame.limit(0), ["City", "Date"], 0.5, 1).isEmpty()


def test_the_gram_fit_is_the_least_squares_fit(clean):
    train, _ = ml.split(ml.ml_frame(clean))
    rows = ml.prepare(train).transform(train)
    found = least_squares.fit(rows, ml.IMPUTED, "AQI")
    theirs = ml.regressor("linear").fit(rows.select("features", "AQI"))
    assert np.allclose(found.coefficients, theirs.coefficients.toArray(), rtol=1e-6, atol=1e-9)
    assert abs(found.intercept - theirs.intercept) < 1e-6 * abs(theirs.intercept)
    told = least_squares.certificate(rows, found, "AQI").collect()
    assert [r.feature for r in told] == [*ml.IMPUTED, "1"] and all(r.cosine == 0 for r in told)
    wrong = found._replace(intercept=found.intercept + 1)
    assert any(r.cosine != 0 for r in least_squares.certificate(rows, wrong, "AQI").collect())


def test_columns_that_repeat_do_not_break_the_fit(spark):
    rows = spark.range(50).selectExpr("CAST(id AS double) AS a", "CAST(2 * id AS double) AS b", "CAST(3 * id + 1 AS double) AS y")
    found = least_squares.fit(rows, ["a", "b"], "y")
    error = rows.agg(F.max(F.abs(F.col("y") - found.prediction()))).first()[0]
    assert error < 1e-6


def walk_sql(nodes: str, rows: str) -> str:
    """Predictions by a recursive walk over the written nodes."""
    return f"""WITH RECURSIVE walk AS (
      SELECT City, Date, x, tree, 0 AS node FROM '{rows}/*.parquet', (SELECT DISTINCT tree FROM '{nodes}/*.parquet')
      UNION ALL
      SELECT City, Date, x, w.tree, CASE WHEN x[feature + 1] <= threshold THEN "left" ELSE "right" END
      FROM walk w JOIN '{nodes}/*.parquet' n ON w.tree = n.tree AND w.node = n.node WHERE n."left" IS NOT NULL)
    SELECT City, Date, sum(weight * value) AS prediction
    FROM walk w JOIN '{nodes}/*.parquet' n ON w.tree = n.tree AND w.node = n.node WHERE n."left" IS NULL GROUP BY ALL"""


@pytest.mark.parametrize("kind", ["tree", "forest", "gbt"])
def test_scores_by_nodes_equal_the_library_and_a_recursive_walk(spark, fitted, tmp_path, kind):
    model = fitted.models[kind]
    rows = model.transform(fitted.test).select("City", "Date", "prediction", *ml.IMPUTED).persist()
    nodes = tree_tables.node_table(model.stages[-1])
    found = tree_tables.predictions(rows, nodes, ml.IMPUTED, ["City", "Date"]).withColumnRenamed("prediction", "ours")
    both = rows.join(found, ["City", "Date"])
    assert both.count() == rows.count() and both.filter("abs(prediction - ours) > 1e-9 * abs(prediction)").isEmpty()
    nodes.write.parquet(f"{tmp_path}/nodes")
    rows.select("City", "Date", F.array(*ml.IMPUTED).alias("x")).write.parquet(f"{tmp_path}/rows")
    walked = {(c, d): p for c, d, p in duckdb.sql(walk_sql(f"{tmp_path}/nodes", f"{tmp_path}/rows")).fetchall()}
    assert len(walked) == rows.count()
    assert all(abs(walked[r.City, r.Date] - r.ours) <= 1e-9 * abs(r.ours) for r in found.collect())
    names = [str(i) for i in range(12)]
    ours = {r.feature: r.importance for r in tree_tables.importances(nodes, names, per_tree=kind != "gbt").collect()}
    theirs = model.stages[-1].featureImportances.toArray()
    assert all(abs(ours[n] - theirs[i]) < 1e-6 for i, n in enumerate(names))
    rows.unpersist()


def test_imputed_values_replace_only_missing_ones(clean):
    train, _ = ml.split(ml.ml_frame(clean))
    out = ml.prepare(train).transform(train)
    assert out.filter(F.col("PM25").isNotNull() & (F.col("PM25") != F.col("PM25_imp"))).isEmpty()
    assert out.filter(F.col("PM25_imp").isNull()).isEmpty()


def test_models_beat_the_mean(fitted):
    rows = fitted.metrics.collect()
    assert {r.kind for r in rows} == set(ml.MODEL_NAMES)
    spread = fitted.test.agg(F.stddev_pop("AQI")).first()[0]
    assert all(r.RMSE < spread and r.R2 > 0 for r in rows)


def test_one_pass_metrics_equal_the_evaluator(fitted):
    from pyspark.ml.evaluation import RegressionEvaluator
    scored = fitted.models["tree"].transform(fitted.test)
    ours = ml.evaluate(scored).first()
    for name, mine in (("rmse", ours.RMSE), ("mae", ours.MAE), ("r2", ours.R2)):
        theirs = RegressionEvaluator(labelCol="AQI", metricName=name).evaluate(scored)
        assert abs(theirs - mine) <= 0.00051
    assert fitted.metrics.filter("kind = 'tree'").first().RMSE == ours.RMSE


def test_best_model_has_the_smallest_error(fitted):
    ranked = ml.compare(fitted.metrics).collect()
    assert [r.RMSE for r in ranked] == sorted(r.RMSE for r in ranked)
    assert [r.best for r in ranked] == [True, False, False, False]
    assert ranked[0].kind == fitted.best


def test_importances_sum_to_one(spark, fitted):
    rows = ml.importances(fitted.models["forest"]).collect()
    assert len(rows) == 12 and abs(sum(r.importance for r in rows) - 1) < 0.001
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)


def test_scoring_needs_no_label(spark, fitted):
    rows = tables.ad_hoc_rows(spark, [tables.EXAMPLE_ROW, (None,) * 12])
    scored = ml.score(fitted.models[fitted.best], rows)
    assert scored.filter("prediction > 0").count() == 2
    assert scored.columns == [*POLLUTANTS, "prediction"]


def test_summary_and_sample(spark, fitted):
    row = ml.model_summary(fitted, tables.ad_hoc_rows(spark, [tables.EXAMPLE_ROW])).first()
    assert len(row.metrics) == 4 and row.best == ml.MODEL_NAMES[fitted.best]
    assert len(row.importance) == 12 and row.example[0].PM25 == 180.0
    scored = ml.score(fitted.models["tree"], fitted.test)
    assert 0 < ml.actual_vs_predicted(scored, 0.5, 1).count() < scored.count()


def test_boosting_writes_checkpoints(spark, small):
    rows, _ = ml.split(ml.ml_frame(small))
    folder = spark.sparkContext.getCheckpointDir()
    ml.train(rows.limit(300), "gbt")
    folder = folder or spark.sparkContext.getCheckpointDir()
    assert folder
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert files.exists(path)


def test_split_does_not_depend_on_the_type_of_partitioning(clean):
    train, _ = ml.split(ml.ml_frame(clean))
    again, _ = ml.split(ml.ml_frame(clean).coalesce(1))
    assert train.exceptAll(again).isEmpty()
