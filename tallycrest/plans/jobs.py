"""The batch jobs an external scheduler runs: build data, train, score, predict quota.

Each job reads tables, writes tables, and returns nothing that grows with the data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tallycrest.operators.binning import one_hot_name
from tallycrest.operators.quota_rules import quota_totals
from tallycrest.plans import models, retention
from tallycrest.plans import quota as quota_plan
from tallycrest.sources.sinks import append_run_log, write_csv, write_table

STATS = "quantity-stats"
FEATURES = "customer-features"
TRAINING = "training-data"
TO_PREDICT = "to-be-predicted"
RESULTS = "prediction-results"
RUN_LOG = "model-information"
REPORT = "classification-report"


def create_retention_data(features: DataFrame, folder: str, types: Sequence[str]) -> None:
    """Write the customer features, the scaler's statistics, the training and the inference table."""
    spark = features.sparkSession
    write_table(features, f"{folder}/{FEATURES}")
    stored = spark.read.parquet(f"{folder}/{FEATURES}")
    write_table(retention.quantity_stats(stored), f"{folder}/{STATS}")
    write_table(retention.training_table(stored, types), f"{folder}/{TRAINING}")
    write_table(retention.inference_table(stored, types), f"{folder}/{TO_PREDICT}")


def train_retention(
    spark: SparkSession,
    folder: str,
    model_path: str,
    types: Sequence[str],
    when: dt.datetime,
    grid: models.Grid | None = None,
    folds: int = 5,
    layers: Sequence[Sequence[int]] = tuple(map(tuple, models.MLP_LAYERS)),
    **network,
) -> None:
    """Boosted trees and neural network: search, cross-validated report, saved model and run log.

    The trees go to ``model_path``, the network with the best layers to ``{model_path}-network``.
    """
    table = spark.read.parquet(f"{folder}/{TRAINING}")
    features = retention.model_features(types)
    settings = models.combinations(grid or models.GBT_GRID)
    search, _ = models.churn_search(table, features, models.gbt_classifier(), settings, folds)
    search.bestModel.write().overwrite().save(model_path)
    best = settings[max(range(len(settings)), key=lambda i: search.avgMetrics[i])]
    report = models.churn_report(table, features, models.gbt_classifier(**best), folds)
    write_table(report, f"{folder}/{REPORT}")
    shapes = [{"layers": [len(features), *hidden, 2]} for hidden in layers]
    hidden = layers[0]
    if len(shapes) > 1:
        found, _ = models.churn_search(table, features, models.mlp_classifier(len(features), **network), shapes, folds)
        hidden = layers[max(range(len(shapes)), key=lambda i: found.avgMetrics[i])]
    summary = models.churn_mlp_run(table, features, folds, hidden, f"{model_path}-network", **network)
    append_run_log(spark, f"{folder}/{RUN_LOG}", models.run_log_entry(summary, hidden, folds, when))


def predict_retention(spark: SparkSession, folder: str, model_path: str, types: Sequence[str]) -> None:
    """Score the inference table with the saved model and replace the results."""
    table = spark.read.parquet(f"{folder}/{TO_PREDICT}")
    stats = spark.read.parquet(f"{folder}/{STATS}")
    scored = models.score(PipelineModel.load(model_path), table)
    write_table(retention.scored_output(scored, types, stats), f"{folder}/{RESULTS}")


def train_quota(
    quota: DataFrame,
    sales: DataFrame,
    opportunities: DataFrame,
    model_folder: str,
    sectors: Sequence[str],
    settings: Sequence[dict[str, object]] = models.QUOTA_SETTINGS,
    folds: int = 3,
) -> None:
    """Fit both quota models on past months (several settings are searched) and save them."""
    train = models.fitting_frame(quota_plan.train_features(quota, sales, opportunities, sectors), "quota-train")
    rows = models.with_folds(train, folds) if len(settings) > 1 else train
    pair = models.fit_pair(rows, [one_hot_name(s) for s in sectors], (), settings, folds)
    models.save_pair(pair, model_folder)


def predict_quota(
    quota: DataFrame,
    sales: DataFrame,
    opportunities: DataFrame,
    future_backlog: DataFrame,
    folder: str,
    model_folder: str,
    sectors: Sequence[str],
    min_year: int,
    seed: int = models.SEED,
) -> dict[str, float]:
    """Write next year's quota by the saved models as table and CSV, and return the totals."""
    infer = quota_plan.infer_features(quota, sales, opportunities, future_backlog, sectors, min_year)
    result = models.quota_predictions(
        models.load_pair(model_folder), models.fitting_frame(infer, "quota-infer"), seed
    )
    write_table(result, f"{folder}/quota-predictions")
    stored = quota.sparkSession.read.parquet(f"{folder}/quota-predictions")
    write_csv(stored, f"{folder}/quota-predictions-csv")
    named = stored.withColumnsRenamed({"current_year_revenue": "eur", "current_year_quota": "amount"})
    return quota_totals(named).first().asDict()
