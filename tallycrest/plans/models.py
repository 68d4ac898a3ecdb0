"""Model training and scoring on MLlib: churn classifiers, customer value, quota."""

from __future__ import annotations

import datetime as dt
import random
from collections.abc import Callable, Sequence
from functools import partial
from itertools import product
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, MultilayerPerceptronClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycrest.functions.columns import absolute_percentage_error
from tallycrest.operators import quota_rules as rules
from tallycrest.operators.evaluate import classification_report, forecast_bands, log_loss, regression_metrics
from tallycrest.operators.folds import add_folds, backtest_splits, split_by_hash
from tallycrest.operators.ranking import attach_row
from tallycrest.operators.scaling import column_stats
from tallycrest.plans import boosting
from tallycrest.plans.networks import fit_networks
from tallycrest.session import materialize, scratch_dir

SEED = 42
#: Independent fits of a report that share the cluster; one fit leaves cores idle between its many short jobs.
FITS_AT_ONCE = 4
# The full search grids.
GBT_GRID = {
    "maxIter": [100, 200, 300],
    "stepSize": [0.01, 0.1, 0.2],
    "maxDepth": [3, 4, 5],
    "subsamplingRate": [0.8, 0.9],
    "featureSubsetStrategy": ["0.7", "0.8", "0.9"],
}
MLP_LAYERS = [[64, 32], [64, 64, 32], [128, 64], [128, 64, 32]]
QUOTA_GRID = {
    "maxIter": [50, 100],
    "maxDepth": [3, 4, 5],
    "stepSize": [0.05, 0.1, 0.2],
    "subsamplingRate": [0.7, 0.9],
}
QUOTA_FEATURES = [
    "lagged_eur_std", "lagged_quota_std", "lagged_monetary_std", "lagged_frequency_std", "month",
]
KEYS = ["sales_id", "year_id", "month"]

Grid = dict[str, Sequence[object]]


def fitting_frame(df: DataFrame, name: str) -> DataFrame:
    """Write the rows once for the many passes of model fitting."""
    spark = df.sparkSession
    spark.sparkContext.setCheckpointDir(scratch_dir(spark))
    return materialize(df, name)


def pipeline(features: Sequence[str], stage) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), stage])


def side_by_side[T](spark: SparkSession, fits: Sequence[Callable[[], T]]) -> list[T]:
    """The results of independent fits, in the order given."""
    with ThreadPool(max(1, min(FITS_AT_ONCE, len(fits)))) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda fit: fit()), fits, chunksize=1)


def combinations(grid: Grid) -> list[dict[str, object]]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def sampled(grid: Grid, draws: int, seed: int = SEED) -> list[dict[str, object]]:
    every = combinations(grid)
    return random.Random(seed).sample(every, min(draws, len(every)))


#: What the random search tries: 5 draws from the full grid, each over 3 folds.
QUOTA_SETTINGS = tuple(sampled(QUOTA_GRID, 5))


def param_map(stage, values: dict[str, object]) -> dict[Param, object]:
    return {stage.getParam(name): value for name, value in values.items()}


class Search(NamedTuple):
    """What a search found: the mean metric of each setting, and the best setting's model of all rows."""

    avgMetrics: list[float]
    bestModel: PipelineModel


def first_trees(model: GBTClassificationModel | GBTRegressionModel, count: int):
    """The boosted model of the first ``count`` trees.

    Boosting adds trees one by one and seeds each by its number, so this is the model that a fit with
    ``maxIter=count`` and otherwise the same settings gives.
    """
    whole = model._java_obj
    spark = SparkSession.active()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, count)
    weights = gateway.new_array(jvm.double, count)
    for i, (tree, weight) in enumerate(zip(list(whole.trees())[:count], list(whole.treeWeights())[:count])):
        trees[i], weights[i] = tree, weight
    if isinstance(model, GBTClassificationModel):
        cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(whole.uid(), trees, weights)
        return GBTClassificationModel(cut)
    return GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(whole.uid(), trees, weights))


def boosted_search(
    df: DataFrame, columns: Sequence[Sequence[str]], stage, settings: Sequence[dict[str, object]], evaluator,
    folds: int, parallelism: int | None = None,
) -> list[Search]:
    """Cross-validated searches of boosted trees, one for each list of columns, with one fit for all sizes (``maxIter``)
    of a setting.

    Settings that differ in their number of trees only are fitted once, with the most trees; the others are
    scored as that model's first trees. Each fit is one task's if its rows fit there (``boosting``); else, or with
    settings that only MLlib knows, all are MLlib's jobs. Ties go to the first setting.
    """
    sizes: dict[tuple, list[int]] = {}
    default = stage.getMaxIter()
    for i, setting in enumerate(settings):
        sizes.setdefault(tuple(sorted((k, v) for k, v in setting.items() if k != "maxIter")), []).append(i)
    jobs = [(own, fold, search) for search in range(len(columns)) for own in sizes for fold in range(folds)]
    fits = [
        boosting.known_fit(stage.copy(param_map(stage, dict(own))), search, fold,
                           [int(settings[i].get("maxIter", default)) for i in sizes[own]], len(columns[search]))
        for own, fold, search in jobs
    ]
    counts = {row["fold"]: row["count"] for row in df.groupBy("fold").count().collect()}
    few = boosting.fits_a_task(sum(counts.values()), max(map(len, columns)))
    if not few or None in fits or not boosting.known_metric(evaluator, stage):
        return boosted_search_by_jobs(df, columns, stage, settings, evaluator, folds, sizes, jobs, parallelism)
    totals = [[0.0] * len(settings) for _ in columns]
    label = stage.getLabelCol()
    for (own, _, search), fitted in zip(jobs, boosting.fit_trees(df, columns, label, fits, counts)):
        for i in sizes[own]:
            sums = fitted.sums[int(settings[i].get("maxIter", default))]
            totals[search][i] += boosting.metric(evaluator, stage, df, sums) / folds
    best = best_settings(totals, evaluator)
    stages = [stage.copy(param_map(stage, settings[i])) for i in best]
    fits = [boosting.known_fit(s, k, None, [s.getMaxIter()], len(own)) for k, (s, own) in enumerate(zip(stages, columns))]
    trees = boosting.fit_trees(df, columns, label, fits, counts)
    models = side_by_side(df.sparkSession, [partial(boosting.as_model, df, s, found) for s, found in zip(stages, trees)])
    assemblers = [VectorAssembler(inputCols=list(features), outputCol="features") for features in columns]
    return [Search(*found) for found in zip(totals, [PipelineModel(stages=list(both)) for both in zip(assemblers, models)])]


def best_settings(totals: Sequence[Sequence[float]], evaluator) -> list[int]:
    """The place of the best mean of each search; ties go to the first."""
    better = max if evaluator.isLargerBetter() else min
    return [better(range(len(means)), key=lambda i: means[i]) for means in totals]


def boosted_search_by_jobs(
    df: DataFrame, columns: Sequence[Sequence[str]], stage, settings: Sequence[dict[str, object]], evaluator,
    folds: int, sizes: dict[tuple, list[int]], jobs: list[tuple], parallelism: int | None = None,
) -> list[Search]:
    """``boosted_search`` with MLlib's own fits, whose rows are spread over the cluster.

    Vectors are assembled once, each fold's rows are cached once, and independent fits, those of all searches, share
    the cluster.
    """
    default = stage.getMaxIter()
    assemblers = [VectorAssembler(inputCols=list(features), outputCol="features") for features in columns]
    every = [assembler.transform(df).select("features", stage.getLabelCol(), "fold") for assembler in assemblers]
    parts = [[(rows.filter(F.col("fold") != f).persist(), rows.filter(F.col("fold") == f).persist()) for f in range(folds)]
             for rows in every]
    jobs = sorted(jobs, key=lambda job: -int(dict(job[0]).get("maxDepth", 5)))  # the longest fits first

    def fit_and_score(job) -> list[tuple[int, int, float]]:
        own, fold, search = job
        train, test = parts[search][fold]
        trees = {i: int(settings[i].get("maxIter", default)) for i in sizes[own]}
        model = stage.copy(param_map(stage, dict(own) | {"maxIter": max(trees.values())})).fit(train)
        return [(search, i, evaluator.evaluate(first_trees(model, n).transform(test))) for i, n in trees.items()]

    totals = [[0.0] * len(settings) for _ in columns]
    cores = parallelism or min(16, df.sparkSession.sparkContext.defaultParallelism)
    with ThreadPool(max(1, min(cores, len(jobs)))) as pool:
        for scored in pool.imap_unordered(inheritable_thread_target(df.sparkSession)(fit_and_score), jobs):
            for search, i, metric in scored:
                totals[search][i] += metric / folds
    for train, test in (part for of_search in parts for part in of_search):
        train.unpersist()
        test.unpersist()
    best = best_settings(totals, evaluator)
    fits = [partial(stage.copy(param_map(stage, settings[i])).fit, rows) for i, rows in zip(best, every)]
    models = side_by_side(df.sparkSession, fits)
    return [Search(*found) for found in zip(totals, [PipelineModel(stages=list(both)) for both in zip(assemblers, models)])]


def network_search(
    df: DataFrame, features: Sequence[str], stage: MultilayerPerceptronClassifier,
    settings: Sequence[dict[str, object]], evaluator, folds: int,
) -> Search:
    """Cross-validated search of networks; those of all settings and folds are fitted together. Ties go to the first."""
    stages = [stage.copy(param_map(stage, s)) for s in settings]
    jobs = [(i, fold) for i in range(len(stages)) for fold in range(folds)]
    fitted = fit_networks(df, features, [(stages[i], fold) for i, fold in jobs])

    def metric(fold: int, model: PipelineModel) -> float:
        test = df.filter(F.col("fold") == fold)
        if test.isEmpty():
            raise ValueError(f"fold {fold} has no rows to score")
        return evaluator.evaluate(model.transform(test))

    scores = side_by_side(df.sparkSession, [partial(metric, fold, m) for (_, fold), m in zip(jobs, fitted)])
    means = [sum(scores[i * folds : (i + 1) * folds]) / folds for i in range(len(stages))]
    best = (max if evaluator.isLargerBetter() else min)(range(len(stages)), key=lambda i: means[i])
    return Search(means, fit_networks(df, features, [(stages[best], None)])[0])


def grid_search(
    df: DataFrame, features: Sequence[str] | Sequence[Sequence[str]], stage, settings: Sequence[dict[str, object]],
    evaluator, folds: int, parallelism: int = 4,
) -> CrossValidatorModel | Search | list[CrossValidatorModel | Search]:
    """Cross-validated search; ``df`` carries the fold column. Boosted trees go by ``boosted_search``, networks (by
    L-BFGS, as by default) by ``network_search``. Several lists of features are searched each, and those of boosted
    trees side by side."""
    several = not isinstance(features[0], str)
    if isinstance(stage, (GBTClassifier, GBTRegressor)):
        found = boosted_search(df, features if several else [features], stage, settings, evaluator, folds)
        return found if several else found[0]
    if several:
        return [grid_search(df, own, stage, settings, evaluator, folds, parallelism) for own in features]
    if isinstance(stage, MultilayerPerceptronClassifier) and stage.getSolver() == "l-bfgs":
        return network_search(df, features, stage, settings, evaluator, folds)
    search = CrossValidator(
        estimator=pipeline(features, stage), estimatorParamMaps=[param_map(stage, s) for s in settings],
        evaluator=evaluator, numFolds=folds, foldCol="fold", parallelism=parallelism, seed=SEED,
    )
    return search.fit(df)


def search_table(df: DataFrame, model: CrossValidatorModel | Search, settings: Sequence[dict[str, object]],
                 metric: str) -> DataFrame:
    """One row per setting with its mean metric."""
    rows = [(", ".join(f"{k}={v}" for k, v in s.items()), float(m)) for s, m in zip(settings, model.avgMetrics)]
    return df.sparkSession.createDataFrame(rows, f"setting string, {metric} double")


def f1_evaluator(label: str = "target_encoded") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol="prediction", metricName="fMeasureByLabel", metricLabel=1.0
    )


def gbt_classifier(**params) -> GBTClassifier:
    return GBTClassifier(labelCol="target_encoded", featuresCol="features", seed=SEED, **params)


def mlp_classifier(inputs: int, hidden: Sequence[int] = (64, 32), **params) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(
        labelCol="target_encoded", featuresCol="features", layers=[inputs, *hidden, 2], seed=SEED, **params
    )


def with_classes(scored: DataFrame) -> DataFrame:
    """``predictions``, the probability of class 1 and that of the predicted class."""
    p = vector_to_array("probability")
    return (
        scored.withColumns({"predictions": F.col("prediction").cast("int"), "probability_class_0": p[0],
                            "probability_class_1": p[1]})
        .withColumn("probability", F.when(F.col("predictions") == 1, F.col("probability_class_1"))
                    .otherwise(F.col("probability_class_0")))
        .drop("features", "rawPrediction", "prediction")
    )


def out_of_fold(df: DataFrame, estimator: Pipeline, folds: int) -> tuple[DataFrame, PipelineModel]:
    """Predictions of each fold by the model of the others, and the last model."""
    fits = [partial(estimator.fit, df.filter(F.col("fold") != fold)) for fold in range(folds)]
    fitted = side_by_side(df.sparkSession, fits)
    parts = [model.transform(df.filter(F.col("fold") == fold)) for fold, model in enumerate(fitted)]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every, fitted[-1]


def churn_folds(table: DataFrame, folds: int) -> DataFrame:
    return fitting_frame(add_folds(table, "customer_id", folds, "target_encoded"), "churn-folds")


def churn_search(table: DataFrame, features: Sequence[str], stage, settings: Sequence[dict[str, object]],
                 folds: int = 5) -> tuple[CrossValidatorModel | Search, DataFrame]:
    """Search by F1 of class 1 over stratified folds: the fitted search and its table."""
    rows = churn_folds(table, folds)
    model = grid_search(rows, features, stage, settings, f1_evaluator(), folds)
    return model, search_table(rows, model, settings, "f1")


def churn_report(table: DataFrame, features: Sequence[str], stage, folds: int = 5,
                 model_path: str | None = None) -> DataFrame:
    """Out-of-fold classification report; saves the last fold's model if a path is given."""
    predicted, model = out_of_fold(churn_folds(table, folds), pipeline(features, stage), folds)
    if model_path:
        model.write().overwrite().save(model_path)
    return classification_report(with_classes(predicted), "fold")


def churn_mlp_run(table: DataFrame, features: Sequence[str], folds: int = 5, hidden: Sequence[int] = (64, 32),
                  model_path: str | None = None, **params) -> DataFrame:
    """Accuracy, loss and F1 of the neural network: mean and population deviation over folds.

    Saves the last fold's network if a path is given.
    """
    stage = mlp_classifier(len(features), hidden, **params)
    predicted, model = out_of_fold(churn_folds(table, folds), pipeline(features, stage), folds)
    if model_path:
        model.write().overwrite().save(model_path)
    rows = with_classes(predicted)
    right = F.col("predictions") == F.col("target_encoded")
    hit = F.count_if((F.col("predictions") == 1) & (F.col("target_encoded") == 1))
    said, was = F.count_if(F.col("predictions") == 1), F.count_if(F.col("target_encoded") == 1)
    per_fold = rows.groupBy("fold").agg(
        F.avg(F.when(right, 1.0).otherwise(0.0)).alias("accuracy"),
        log_loss("target_encoded", "probability_class_1").alias("loss"),
        F.coalesce(F.try_divide(hit * 2.0, (said + was) * 1.0), F.lit(0.0)).alias("f1_score"),
    )
    metrics = ("accuracy", "loss", "f1_score")
    return per_fold.agg(*[F.avg(m).alias(m) for m in metrics], *[F.stddev_pop(m).alias(f"{m}_std") for m in metrics])


def run_log_entry(summary: DataFrame, hidden: Sequence[int], folds: int, when: dt.datetime) -> dict[str, object]:
    """The run-log row of a finished training (one summary row is read)."""
    row = summary.first()
    return {
        "training_date": when.strftime("%Y-%m-%d %H:%M:%S"), "optimizer": "l-bfgs",
        "loss_function": "cross_entropy", "hidden_layers": "-".join(map(str, hidden)) + " units",
        "cross_validation": f"Stratified {folds} Fold", "accuracy": row["accuracy"], "loss": row["loss"],
        "f1_score": row["f1_score"],
    }


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, table: DataFrame) -> DataFrame:
    return with_classes(model.transform(table))


def customer_value(table: DataFrame, revenue: DataFrame) -> DataFrame:
    """Training rows with the customer's revenue, where it is positive."""
    return table.join(revenue, "customer_id").filter(F.col("eur") > 0)


def customer_value_metrics(rows: DataFrame, features: Sequence[str], folds: int = 5, trees: int = 100) -> DataFrame:
    """Regression metrics of a random forest, averaged over shuffled folds."""
    stage = RandomForestRegressor(labelCol="eur", featuresCol="features", numTrees=trees, seed=SEED)
    data = fitting_frame(add_folds(rows, "customer_id", folds), "value-folds")
    predicted, _ = out_of_fold(data, pipeline(features, stage), folds)
    named = predicted.select("fold", F.col("eur").alias("y_true"), F.col("prediction").alias("y_pred"))
    return regression_metrics(named, ["fold"]).agg(
        F.sum("n").alias("n"), *[F.avg(m).alias(m) for m in ("mse", "r2", "mae", "mean_ape")]
    )


def quota_regressor(**params) -> GBTRegressor:
    return GBTRegressor(labelCol="amount", featuresCol="features", seed=SEED, **params)


def quota_features(sectors: Sequence[str], backlog: bool, extra: Sequence[str] = ()) -> list[str]:
    return [*QUOTA_FEATURES, *extra, *(["backlog_std"] if backlog else []), *sectors]


def quota_backtest(train: DataFrame, years: Sequence[int], sectors: Sequence[str], **params) -> DataFrame:
    """Predictions for each year by a model of the years before it, with their errors."""
    features = quota_features(sectors, backlog=False, extra=["lagged_partial_win_rate", "spread_std"])
    rows = fitting_frame(
        backtest_splits(train, years, ["lagged_quota_std", "lagged_eur_std"]), "backtest"
    )
    estimator = pipeline(features, quota_regressor(**params))
    parts = [rows.filter(F.col("test_year") == year) for year in years[1:]]
    fits = [partial(estimator.fit, part.filter(F.col("role") == "train")) for part in parts]
    results = None
    for part, model in zip(parts, side_by_side(rows.sparkSession, fits)):
        tested = model.transform(part.filter(F.col("role") == "test")).select(
            "test_year", *KEYS, F.col("amount").alias("y_true"), F.col("prediction").alias("y_pred"),
            "historical_mean", "lagged_quota", "lagged_eur", "spread", "lagged_quota_std", "backlog_std",
        )
        results = tested if results is None else results.unionByName(tested)
    return results.withColumn("percentage_error", absolute_percentage_error("y_true", "y_pred"))


#: The models of the ensemble, and whether they see the backlog.
PAIR = {"with_backlog": True, "without_backlog": False}


def fit_pair(train: DataFrame, sectors: Sequence[str], extra: Sequence[str] = (),
             settings: Sequence[dict[str, object]] = ({},), folds: int = 3) -> dict[str, PipelineModel]:
    """The models with and without backlog; several settings are searched by cross-validation."""
    columns = [quota_features(sectors, backlog, extra) for backlog in PAIR.values()]
    if len(settings) == 1:
        fits = [partial(pipeline(features, quota_regressor(**settings[0])).fit, train) for features in columns]
        return dict(zip(PAIR, side_by_side(train.sparkSession, fits)))
    evaluator = RegressionEvaluator(labelCol="amount", metricName="rmse")
    found = grid_search(train, columns, quota_regressor(), settings, evaluator, folds)
    return {name: search.bestModel for name, search in zip(PAIR, found)}


def predict_pair(models: dict[str, PipelineModel], df: DataFrame) -> DataFrame:
    """Add one column per model."""
    for name, model in models.items():
        df = model.transform(df).withColumnRenamed("prediction", name).drop("features")
    return df


ENSEMBLE_EXTRA = ["lagged_opportunity_amount"]


def with_folds(train: DataFrame, folds: int) -> DataFrame:
    return add_folds(train.withColumn("_row", F.xxhash64(*KEYS)), "_row", folds)


def quota_ensemble(train: DataFrame, sectors: Sequence[str],
                   settings: Sequence[dict[str, object]] = QUOTA_SETTINGS, folds: int = 3) -> DataFrame:
    """Held-out predictions of the two-model ensemble; several settings are searched."""
    rows = with_folds(train, folds) if len(settings) > 1 else train
    fit, held_out = split_by_hash(fitting_frame(rows, "ensemble"), KEYS)
    models = fit_pair(fit, sectors, ENSEMBLE_EXTRA, settings, folds)
    return predict_pair(models, held_out).select(
        *KEYS, F.col("amount").alias("y_true"), rules.ensemble_mean(list(models)).alias("y_pred")
    )


def ensemble_report(predicted: DataFrame) -> DataFrame:
    """Metrics of the ensemble next to its error bands."""
    bands = forecast_bands(predicted).drop("mean_error_below_70")
    return attach_row(bands, regression_metrics(predicted), "_all").select("band", "n_rows", "n_reps", "_all.*")


def save_pair(models: dict[str, PipelineModel], folder: str) -> None:
    for name, model in models.items():
        model.write().overwrite().save(f"{folder}/{name}")


def load_pair(folder: str) -> dict[str, PipelineModel]:
    return {name: PipelineModel.load(f"{folder}/{name}") for name in PAIR}


def quota_predictions(models: dict[str, PipelineModel], infer: DataFrame, seed: int = SEED) -> DataFrame:
    """Next year's quota per rep and month with flags and weights, by a fitted pair of models."""
    ready = rules.quota_flags(predict_pair(models, infer))
    final = ready.withColumn("predicted_quota", rules.capped_quota(list(models), rules.growth_draws(seed)))
    return final.select(
        "sales_id", "sales_name", F.col("eur").alias("current_year_revenue"), "cagr",
        F.col("amount").alias("current_year_quota"), "predicted_quota", "inactive_or_no_quota", "master_sector",
        "fact_entity", "growth_potential", "month", "year_id", "growth_adjustment_weight",
    )


def principal_components(df: DataFrame, key: str, columns: Sequence[str], count: int = 2) -> DataFrame:
    """The first principal components of mean-centred columns; each one's largest loading is positive."""
    known = attach_row(df, column_stats(df, columns), "_s")
    centred = known.withColumns({c: F.col(c) - F.col("_s")[c]["mean"] for c in columns}).drop("_s")
    rows = VectorAssembler(inputCols=list(columns), outputCol="features").transform(centred)
    fitted = PCA(k=count, inputCol="features", outputCol="pc").fit(rows)
    loadings = fitted.pc.toArray()  # one row per listed column
    sides = [1.0 if max(column, key=abs) >= 0 else -1.0 for column in loadings.T.tolist()]
    parts = vector_to_array("pc")
    return fitted.transform(rows).select(key, *[(parts[i] * sides[i]).alias(f"pc{i + 1}") for i in range(count)])
