"""Models: schema, ranges and repeatability; sinks; connectors; scratch folder."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallycrest.plans import jobs, models, retention
from tallycrest.plans import queries as q
from tallycrest.session import materialize, scratch_dir
from tallycrest.sources import sinks, tables


def test_full_grids_have_the_published_sizes():
    assert len(models.combinations(models.GBT_GRID)) == 162
    assert len(models.sampled(models.QUOTA_GRID, 5)) == 5
    assert models.sampled(models.QUOTA_GRID, 5) == models.sampled(models.QUOTA_GRID, 5)


def test_searches_take_the_full_grids(spark, views, monkeypatch):
    tried = []

    class Found(Exception):
        pass

    def search(df, features, stage, settings, evaluator, folds, parallelism=4):
        tried.append((settings, folds))
        raise Found

    monkeypatch.setattr(models, "grid_search", search)
    past = (q._stored_quota(views), q._stored_sales(views), views.opportunity())
    for run in (lambda: q.churn_gbt_cv(views), lambda: q.quota_random_search(views),
                lambda: jobs.train_quota(*past, "unused", q.MASTER_SECTORS)):
        with pytest.raises(Found):
            run()
    draws = models.sampled(models.QUOTA_GRID, 5)
    assert [(list(s), n) for s, n in tried] == [(models.combinations(models.GBT_GRID), 5), (draws, 3), (draws, 3)]


def test_scored_customers(spark, views):
    rows = q.score_customers(views)
    once = rows.select("customer_id", "predictions", "probability", "customer_type", "qty").toPandas()
    assert once["customer_id"].is_unique
    assert set(once["predictions"]) <= {0, 1} and once["probability"].between(0.5, 1).all()
    assert set(once["customer_type"]) <= {"customer_aol", "customer_cp", "customer_ka"}
    real = q._stored_features(views).select("customer_id", "qty").toPandas()
    joined = once.merge(real, on="customer_id")
    assert abs(joined["qty_x"] - joined["qty_y"]).max() < 1e-2
    again = q.score_customers(views).select("customer_id", "probability").toPandas()
    merged = once.merge(again, on="customer_id")
    assert (merged["probability_x"] - merged["probability_y"]).abs().max() < 1e-9


def test_model_path_round_trip(spark, views, tmp_path):
    from pyspark.ml import PipelineModel

    table = q.training_table(views)
    path = str(tmp_path / "model")
    report = models.churn_report(table, q.FEATURES, models.gbt_classifier(maxIter=2, maxDepth=2), folds=2, model_path=path)
    assert {r["class"] for r in report.collect()} == {0, 1}
    scored = models.score(PipelineModel.load(path), retention.inference_table(q._stored_features(views), q.CUSTOMER_TYPES))
    assert scored.filter((F.col("probability_class_1") < 0) | (F.col("probability_class_1") > 1)).count() == 0


def test_mlp_summary_goes_to_the_run_log(spark, views, tmp_path):
    summary = models.churn_mlp_run(q.training_table(views), q.FEATURES, folds=2, maxIter=3)
    entry = models.run_log_entry(summary, (64, 32), 2, dt.datetime(2024, 5, 6))
    sinks.append_run_log(spark, str(tmp_path / "log"), entry)
    sinks.append_run_log(spark, str(tmp_path / "log"), entry | {"training_date": "2023-01-01 00:00:00"})
    log = sinks.read_run_log(spark, str(tmp_path / "log")).collect()
    assert [r["training_date"].year for r in log] == [2023, 2024]
    assert 0 <= log[0]["accuracy"] <= 1 and log[0]["hidden_layers"] == "64-32 units"


def test_quota_predictions(spark, views):
    rows = q.quota_predictions(views)
    assert rows.columns == [
        "sales_id", "sales_name", "current_year_revenue", "cagr", "current_year_quota", "predicted_quota",
        "inactive_or_no_quota", "master_sector", "fact_entity", "growth_potential", "month", "year_id",
        "growth_adjustment_weight"]
    found = rows.toPandas()
    assert len(found) and found["predicted_quota"].notna().all()
    assert not found.duplicated(["sales_id", "year_id", "month"]).any()
    weak = found[3 * found["current_year_revenue"] < found["current_year_quota"]]
    low, high = weak["current_year_revenue"] * 1.03, weak["current_year_revenue"] * 1.08
    assert ((weak["predicted_quota"] >= low - 1e-6) & (weak["predicted_quota"] <= high + 1e-6)).all()


def test_table_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    sinks.write_table(df, path)
    sinks.write_table(df, path)
    assert spark.read.parquet(path).count() == 2
    sinks.write_table(df, path, overwrite=False)
    assert spark.read.parquet(path).count() == 4
    sinks.clear_table(spark, path)
    cleared = spark.read.parquet(path)
    assert cleared.count() == 0 and cleared.columns == ["id", "s"]


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([("Backlog", dt.datetime(2020, 1, 2), 1.5, 7)], tables.FUTURE_BACKLOG_SCHEMA)
    sinks.write_csv(df, path)
    assert tables.read_csv(spark, path, tables.FUTURE_BACKLOG_SCHEMA).collect() == df.collect()


def test_jdbc_options_split_the_scan():
    options = tables.jdbc_options("jdbc:x", "t", "id", (0, 100), partitions=4, user="u")
    assert options == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "10000", "user": "u", "partitionColumn": "id",
                       "lowerBound": "0", "upperBound": "100", "numPartitions": "4"}
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "t", "id")


def test_scratch_folder_is_the_configured_one(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = materialize(spark.range(10).withColumn("x", F.col("id") * 2), "test")
    assert df.count() == 10 and df.inputFiles()[0].startswith(f"file://{scratch_dir(spark)}")


@pytest.mark.parametrize("kind", ["classifier", "regressor"])
def test_staged_search_equals_direct_fits(spark, views, kind):
    """First trees of a longer model are the shorter model, and the search's metrics are those of CrossValidator."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator

    rows = models.churn_folds(q.training_table(views), 2)
    if kind == "classifier":
        stage, evaluator = models.gbt_classifier(), models.f1_evaluator()
    else:
        rows = rows.withColumn("amount", F.col("qty") * 3 + F.col("target_encoded"))
        stage, evaluator = models.quota_regressor(), RegressionEvaluator(labelCol="amount", metricName="rmse")
    grid = {"maxIter": [2, 5], "stepSize": [0.1, 0.3], "subsamplingRate": [0.8], "featureSubsetStrategy": ["0.7"],
            "maxDepth": [2]}
    settings = models.combinations(grid)
    found = models.grid_search(rows, q.FEATURES, stage, settings, evaluator, 2)
    assembled = models.VectorAssembler(inputCols=list(q.FEATURES), outputCol="features").transform(rows)
    direct = CrossValidator(
        estimator=stage, estimatorParamMaps=[models.param_map(stage, s) for s in settings], evaluator=evaluator,
        numFolds=2, foldCol="fold", seed=models.SEED,
    ).fit(assembled)
    assert found.avgMetrics == pytest.approx(direct.avgMetrics, abs=1e-12)
    whole = stage.copy(models.param_map(stage, settings[-1])).fit(assembled)
    short = stage.copy(models.param_map(stage, settings[-1] | {"maxIter": 2})).fit(assembled)
    cut = models.first_trees(whole, 2)
    without_name = [[t.toDebugString.split("\n", 1)[1] for t in m.trees] for m in (cut, short)]
    assert without_name[0] == without_name[1]
    assert cut.treeWeights == short.treeWeights
    same = cut.transform(assembled).select("prediction").collect() == short.transform(assembled).select("prediction").collect()
    assert same
    scored = found.bestModel.transform(rows).select("prediction").collect()
    assert scored == direct.bestModel.transform(assembled).select("prediction").collect()


def test_independent_fits_share_the_cluster(spark):
    """The models of a report are fitted side by side, and keep their order."""
    from threading import Barrier

    met = Barrier(2, timeout=60)

    class Model:
        def __init__(self, fold):
            self.fold = fold

        def transform(self, df):
            return df.withColumn("by", F.lit(self.fold))

    class Estimator:
        def fit(self, df):
            met.wait()
            return Model(({0, 1} - {r["fold"] for r in df.collect()}).pop())

    rows = spark.createDataFrame([(i, i % 2) for i in range(6)], "id int, fold int")
    predicted, last = models.out_of_fold(rows, Estimator(), 2)
    assert {(r["id"], r["by"]) for r in predicted.collect()} == {(i, i % 2) for i in range(6)}
    assert last.fold == 1


def test_searches_of_the_pair_share_the_cluster(spark, monkeypatch):
    """The models with and without backlog are searched side by side, with the results of single searches."""
    from threading import Barrier, Lock

    from pyspark.ml.evaluation import RegressionEvaluator

    rows = spark.range(60, numPartitions=2).select(
        (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 11).cast("double").alias("b"),
        (F.col("id") % 13 + F.col("id") % 7).cast("double").alias("amount"), (F.col("id") % 2).cast("int").alias("fold"))
    columns, settings = [["a", "b"], ["a"]], [{"maxIter": 1, "maxDepth": 2}, {"maxIter": 3, "maxDepth": 2}]
    evaluator = RegressionEvaluator(labelCol="amount", metricName="rmse")
    single = [models.grid_search(rows, own, models.quota_regressor(), settings, evaluator, 2) for own in columns]
    met, seen, lock, fit = Barrier(2, timeout=60), set(), Lock(), models.GBTRegressor.fit

    def fit_together(stage, df, *params):
        size = df.first()["features"].size
        with lock:
            new = size not in seen
            seen.add(size)
        if new:
            met.wait()
        return fit(stage, df, *params)

    monkeypatch.setattr(models.GBTRegressor, "fit", fit_together)
    found = models.grid_search(rows, columns, models.quota_regressor(), settings, evaluator, 2)
    assert seen == {1, 2}
    for one, alone in zip(found, single):
        assert one.avgMetrics == pytest.approx(alone.avgMetrics, abs=1e-12)
        scored, wanted = (m.bestModel.transform(rows).select("prediction").collect() for m in (one, alone))
        assert scored == wanted
