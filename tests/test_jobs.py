"""The batch jobs end to end on the smallest tables."""

import datetime as dt

from tallycrest.plans import jobs, models
from tallycrest.plans import queries as q
from tallycrest.sources import sinks


def test_retention_jobs(spark, views, tmp_path):
    folder, model = str(tmp_path / "data"), str(tmp_path / "model")
    jobs.create_retention_data(q._stored_features(views), folder, q.CUSTOMER_TYPES)
    grid = {"maxIter": [2], "maxDepth": [2, 3]}
    jobs.train_retention(
        spark, folder, model, q.CUSTOMER_TYPES, dt.datetime(2024, 1, 2), grid, 2, [(4,), (3, 2)], maxIter=3
    )
    assert spark.read.parquet(f"{folder}/{jobs.REPORT}").count() == 2
    network = models.load(f"{model}-network")
    table = spark.read.parquet(f"{folder}/{jobs.TO_PREDICT}")
    scored = models.score(network, table).select("probability_class_0", "probability_class_1").collect()
    assert scored and all(abs(a + b - 1) < 1e-9 for a, b in scored)
    jobs.predict_retention(spark, folder, model, q.CUSTOMER_TYPES)
    jobs.predict_retention(spark, folder, model, q.CUSTOMER_TYPES)
    results = spark.read.parquet(f"{folder}/{jobs.RESULTS}")
    assert results.count() == spark.read.parquet(f"{folder}/{jobs.TO_PREDICT}").count()
    assert {"customer_type", "predictions", "probability", "qty"} <= set(results.columns)
    assert sinks.read_run_log(spark, f"{folder}/{jobs.RUN_LOG}").count() == 1


def test_quota_job(spark, views, tmp_path):
    past = (q._stored_quota(views), q._stored_sales(views), views.opportunity())
    saved = str(tmp_path / "models")
    jobs.train_quota(*past, saved, q.MASTER_SECTORS, [{"maxIter": 2, "maxDepth": 2}])
    totals, again = (
        jobs.predict_quota(*past, views.future_backlog(), str(tmp_path), saved, q.MASTER_SECTORS, q.MIN_YEAR)
        for _ in range(2)
    )
    assert totals == again
    table = spark.read.parquet(str(tmp_path / "quota-predictions"))
    csv = spark.read.option("header", True).csv(str(tmp_path / "quota-predictions-csv"))
    assert table.count() == csv.count() > 0 and table.columns == csv.columns
    assert totals["predicted_quota"] > 0 and totals["quota"] > 0
