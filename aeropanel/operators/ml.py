"""Prediction of the index with four regressors.

Features are imputed and assembled once for all models; all metrics of all models come from one pass over
the test rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeropanel.operators import selection, tree_tables
from aeropanel.operators.selection import sample_exactly
from aeropanel.schema import POLLUTANTS, display_name
from aeropanel.session import ensure_checkpoint_folder
from aeropanel.sources.readers import persisted
from aeropanel.sources.tables import literal_rows

# Model names and settings.
MODEL_NAMES = {
    "linear": "Linear Regression",
    "tree": "Decision Tree",
    "forest": "Random Forest",
    "gbt": "Gradient Boosted Trees",
}
TREE_DEPTH = 8
FOREST_TREES, FOREST_DEPTH = 100, 10
GBT_ITERATIONS, GBT_DEPTH = 60, 6
SEED = 42
TRAIN_PERCENT = 80
# End of fixed values.

KEYS = ["City", "Date"]
IMPUTED = [f"{p}_imp" for p in POLLUTANTS]


def ml_frame(clean: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Features and label; the keys come along because the split is made on them."""
    return clean.select(*keys, *POLLUTANTS, "AQI")


def split(df: DataFrame, key_cols: Sequence[str] = KEYS, train_percent: int = TRAIN_PERCENT) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: the same rows however the data is partitioned, on any engine."""
    key = F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in key_cols)).cast("binary"))
    slot = F.conv(F.substring(key, 1, 8), 16, 10).cast("long") % 100
    return df.filter(slot < train_percent), df.filter(slot >= train_percent)


def imputer(medians: Mapping[str, float | None]) -> SQLTransformer:
    """Missing readings become the median of the training rows; a pollutant never read there becomes 0."""
    filled = ", ".join(f"coalesce(nanvl({p}, NULL), {(medians[p] or 0.0)!r}D) AS {p}_imp" for p in POLLUTANTS)
    return SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=IMPUTED, outputCol="features")


def regressor(kind: str) -> Estimator:
    common = {"featuresCol": "features", "labelCol": "AQI"}
    if kind == "linear":
        return LinearRegression(**common)
    if kind == "tree":
        return DecisionTreeRegressor(**common, maxDepth=TREE_DEPTH, seed=SEED)
    if kind == "forest":
        return RandomForestRegressor(**common, numTrees=FOREST_TREES, maxDepth=FOREST_DEPTH, seed=SEED)
    if kind == "gbt":
        return GBTRegressor(**common, maxIter=GBT_ITERATIONS, maxDepth=GBT_DEPTH, seed=SEED)
    raise ValueError(f"unknown model {kind}, expected one of {list(MODEL_NAMES)}")


def prepare(train: DataFrame) -> PipelineModel:
    """Imputer and assembler, with the exact medians of the training rows only."""
    return PipelineModel(stages=[imputer(selection.medians(train, POLLUTANTS)), assembler()])


def train(rows: DataFrame, kind: str, prepared: PipelineModel | None = None) -> PipelineModel:
    """One fitted model, from readings to prediction."""
    prepared = prepared or prepare(rows)
    ensure_checkpoint_folder(rows.sparkSession)
    with persisted(prepared.transform(rows).select("features", "AQI")) as features:
        fitted = regressor(kind).fit(features)
    return PipelineModel(stages=[*prepared.stages, fitted])


def fit_all(
    rows: DataFrame, kinds: Sequence[str] = tuple(MODEL_NAMES), at_once: int = len(MODEL_NAMES),
) -> dict[str, PipelineModel]:
    """All models on the same prepared features, which are computed once; `at_once` fits run side by side."""
    prepared = prepare(rows)
    ensure_checkpoint_folder(rows.sparkSession)
    with persisted(prepared.transform(rows).select("features", "AQI")) as features, ThreadPoolExecutor(at_once) as pool:
        fitted = pool.map(lambda kind: regressor(kind).fit(features), kinds)
        return {k: PipelineModel(stages=[*prepared.stages, m]) for k, m in zip(kinds, fitted, strict=True)}


def predict_all(models: Mapping[str, PipelineModel], rows: DataFrame) -> DataFrame:
    """One prediction column per model: `prediction_<kind>`."""
    first = next(iter(models.values()))
    with_features = PipelineModel(stages=first.stages[:-1]).transform(rows)
    for kind, model in models.items():
        final: Transformer = model.stages[-1].copy()
        with_features = final.setPredictionCol(f"prediction_{kind}").transform(with_features)
    return with_features


def _metrics(prediction: str, label: str = "AQI") -> dict[str, Column]:
    error = F.col(prediction) - F.col(label)
    squared = F.sum(error * error)
    spread = F.var_pop(label) * F.count(label)
    return {
        "RMSE": F.round(F.sqrt(squared / F.count(label)), 3),
        "MAE": F.round(F.avg(F.abs(error)), 3),
        "R2": F.round(1 - squared / F.nullif(spread, F.lit(0.0)), 3),
    }


def evaluate(predictions: DataFrame, prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE and R2 in one pass -> one row."""
    return predictions.agg(*(m.alias(n) for n, m in _metrics(prediction).items()))


def evaluate_all(models: Mapping[str, PipelineModel], test: DataFrame) -> DataFrame:
    """Metrics of all models in one pass over the test rows -> kind, Model, RMSE, MAE, R2."""
    scored = predict_all(models, test)
    row = scored.agg(*(m.alias(f"{k}_{n}") for k in models for n, m in _metrics(f"prediction_{k}").items()))
    return row.select(F.inline(F.array(*(
        F.struct(F.lit(k).alias("kind"), F.lit(MODEL_NAMES[k]).alias("Model"),
                 *(F.col(f"{k}_{n}").alias(n) for n in ("RMSE", "MAE", "R2"))) for k in models))))


def compare(metrics: DataFrame) -> DataFrame:
    """Models by their error, the best one marked."""
    best = metrics.agg(F.min(F.struct("RMSE", "Model")).alias("b")).select("b.Model").scalar()
    return metrics.withColumn("best", F.col("Model") == best).orderBy("RMSE", "Model")


def importances(model: PipelineModel) -> DataFrame:
    """Importance of every pollutant in a fitted tree model, largest first; one row per feature, from the table of its nodes."""
    table = tree_tables.importances(tree_tables.node_table(model.stages[-1]), [display_name(p) for p in POLLUTANTS])
    return table.select(F.col("feature").alias("pollutant"), F.round("importance", 4).alias("importance")) \
        .orderBy(F.desc("importance"), "pollutant")


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Predictions for any rows that hold the twelve readings; no label is needed."""
    return model.transform(rows).drop("features", *IMPUTED)


def actual_vs_predicted(predictions: DataFrame, fraction: float = 0.5, seed: int = 1, keys: Sequence[str] = KEYS) -> DataFrame:
    """A sample of exactly that part of the rows, chosen by their keys."""
    return sample_exactly(predictions, keys, fraction, seed).select("AQI", "prediction")


@dataclass
class Study:
    """Models fitted on the training rows, and their metrics on the others (a few literal rows)."""

    models: dict[str, PipelineModel]
    metrics: DataFrame
    best: str
    test: DataFrame


def study(clean: DataFrame, kinds: Sequence[str] = tuple(MODEL_NAMES)) -> Study:
    """Splits, fits and compares; the only data on the driver are one row of metrics per model.

    Only the features are kept in memory; `clean` is read for the medians, the features and the test rows.
    """
    rows, test = split(ml_frame(clean))
    models = fit_all(rows, kinds)
    table = [tuple(r) for r in evaluate_all(models, test).collect()]
    metrics = literal_rows(clean.sparkSession, table, "kind string, Model string, RMSE double, MAE double, R2 double")
    best = min(table, key=lambda r: (r[2], r[1]))[0]
    return Study(models, metrics, best, test)


def model_summary(fitted: Study, example: DataFrame) -> DataFrame:
    """One row: metrics of all models, the best, importances of the forest, and the scored example rows."""
    spark = fitted.test.sparkSession
    metrics = F.sort_array(F.collect_list(F.struct("RMSE", "MAE", "R2", "Model")))
    weights = importances(fitted.models["forest"])
    by_weight = F.sort_array(F.collect_list(F.struct("importance", "pollutant")), asc=False)
    scored = score(fitted.models[fitted.best], example)
    shown = F.collect_list(F.struct(*POLLUTANTS, F.round("prediction", 1).alias("prediction")))
    return spark.range(1).select(
        fitted.metrics.agg(metrics).scalar().alias("metrics"),
        F.lit(MODEL_NAMES[fitted.best]).alias("best"),
        weights.agg(by_weight).scalar().alias("importance"),
        scored.agg(shown).scalar().alias("example"))
